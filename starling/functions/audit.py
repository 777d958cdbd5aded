"""Audit and constant columns.

``run_ts`` replaces ``current_timestamp()``/``current_date()`` so a run (and a
replay of it) is repeatable; without it the query's start time is used, taken
once per query by Catalyst.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from starling.schemas import OPEN_END


def run_timestamp(run_ts: str | None) -> Column:
    return F.lit(run_ts).cast("timestamp") if run_ts else F.current_timestamp()


def run_date(run_ts: str | None) -> Column:
    return F.to_date(F.lit(run_ts).cast("timestamp")) if run_ts else F.current_date()


def open_end() -> Column:
    return F.lit(OPEN_END).cast("timestamp")


def version_columns(run_ts: str | None) -> dict[str, Column]:
    """record_start_ts, record_end_ts and active_flag of a fresh version."""
    return {
        "record_start_ts": run_timestamp(run_ts),
        "record_end_ts": open_end(),
        "active_flag": F.lit(1),
    }
