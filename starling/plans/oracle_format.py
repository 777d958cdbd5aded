"""Rendering of time values at the oracle boundary.

Pandas cannot hold the open end 9999-12-31 as a timestamp and represents
DATE differently per engine, so queries compared against SQL hand dates and
timestamps out as fixed-format text. The library itself keeps typed columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType

DATE_FMT = "yyyy-MM-dd"
TS_FMT = "yyyy-MM-dd HH:mm:ss"


def time_as_text(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, DateType):
            cols.append(F.date_format(F.col(f.name), DATE_FMT).alias(f.name))
        elif isinstance(f.dataType, (TimestampType, TimestampNTZType)):
            cols.append(F.date_format(F.col(f.name), TS_FMT).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)
