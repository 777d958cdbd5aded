"""Ordering of silver orders (O1).

The source job sorts all orders by date, newest first, before a write
partitioned by year. As a query that is a global ``orderBy`` (range shuffle
on sampled bounds, so a hot year is split across tasks). Before a
partitioned write only the order inside each file matters: ``layout_for_write``
rebalances on the partition key (AQE splits a hot key, e.g. one order year
holding most rows, into several tasks) and sorts within each task, partition
key first so the file writer needs no sort of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sort_for_query(df: DataFrame, order_col: str, tiebreak: str | None = None) -> DataFrame:
    """Global newest-first order. A range partitioner cannot split equal sort
    keys, so a ``tiebreak`` column lets the range bounds cut through one hot
    date instead of sending it to a single task."""
    keys = [F.col(order_col).desc_nulls_last()] + ([F.col(tiebreak)] if tiebreak else [])
    return df.orderBy(*keys)


def layout_for_write(df: DataFrame, partition_col: str, order_col: str | None = None) -> DataFrame:
    out = df.hint("rebalance", partition_col)
    keys = [F.col(partition_col)] + ([F.col(order_col).desc_nulls_last()] if order_col else [])
    return out.sortWithinPartitions(*keys)


def orders_between(df: DataFrame, start: str, end: str, date_col: str = "order_date",
                   partition_col: str = "order_year_pk") -> DataFrame:
    """Date-range filter on silver orders that also bounds the partition
    column: a predicate on the date alone cannot prune year partitions."""
    return df.where(
        F.col(partition_col).between(F.year(F.lit(start).cast("date")), F.year(F.lit(end).cast("date")))
        & F.col(date_col).between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    )
