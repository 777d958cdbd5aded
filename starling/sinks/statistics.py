"""Mergeable column statistics (K8): sketches kept per load.

``ANALYZE ... FOR ALL COLUMNS`` reads the whole table, so an appended fact
would be read again in full after every load. Here a load is summarised once,
by one aggregation over its own rows, into one small row per column; the
statistics of the table are the merge of its loads' rows. A load that is
replaced or dropped takes its row along, since nothing is ever added up in place.

One row per column: rows, nulls, smallest and largest value (exact), a
HyperLogLog sketch of the distinct values and a KLL sketch of the quantiles.
Values have one of three forms: whole numbers (integers, dates as days, times
as microseconds, booleans), fractions (as double) and text; text has no
quantiles. Types without an order (maps, variants) have row and null counts only.

Stated errors, whatever the number of loads merged: the distinct count has a
relative standard error of 1.04 / sqrt(2 ** LG_CONFIG), see ``DISTINCT_ERROR``;
a quantile's true rank is off by at most ``RANK_ERROR`` with 99 % confidence.

Defined cases: a column that holds nulls only has distinct count 0 and null
bounds and quantiles; NaN counts as a value, but bounds and quantiles leave it out;
an empty load is a row of zeros; no loads at all give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starling.session import delete_path, list_dir_names

#: Registers of the distinct sketch (2 ** LG_CONFIG) and size of the quantile sketch.
LG_CONFIG = 12
KLL_K = 200
#: Relative standard error of a distinct count; rank error of a quantile (KLL of 200).
DISTINCT_ERROR = 1.04 / math.sqrt(2**LG_CONFIG)
RANK_ERROR = 0.0133

SKETCH_SCHEMA = (
    "column_name string, data_type string, rows long, nulls long, min_long long, max_long long, min_double double, "
    "max_double double, min_text string, max_text string, distinct_sketch binary, long_sketch binary, double_sketch binary")


@dataclass(frozen=True)
class _Form:
    """A column's value in each form; the others are NULL."""

    long: Column
    double: Column
    text: Column
    distinct: Column


def _form(name: str, kind: T.DataType) -> _Form:
    value = F.col("`" + name.replace("`", "``") + "`")
    long, double, text = (F.lit(None).cast(t) for t in ("bigint", "double", "string"))
    distinct: Column = text
    if isinstance(kind, (T.IntegralType, T.BooleanType)):
        distinct = long = value.cast("bigint")
    elif isinstance(kind, T.DateType):
        distinct = long = F.unix_date(value).cast("bigint")
    elif isinstance(kind, T.TimestampType):
        distinct = long = F.unix_micros(value)
    elif isinstance(kind, T.TimestampNTZType):
        distinct = long = F.unix_micros(F.convert_timezone(F.lit("UTC"), F.lit("UTC"), value).cast("timestamp"))
    elif isinstance(kind, (T.FloatType, T.DoubleType, T.DecimalType)):
        as_double = value.cast("double")
        double = F.when(~F.isnan(as_double), as_double)
        distinct = value.cast("string")  # a decimal's digits beyond a double's count, too
    elif isinstance(kind, (T.StringType, T.CharType, T.VarcharType)):
        distinct = text = value.cast("string")
    elif isinstance(kind, T.BinaryType):
        distinct = text = F.hex(value)
    return _Form(long, double, text, distinct)


def sketch(df: DataFrame) -> DataFrame:
    """One row per column of ``df`` (SKETCH_SCHEMA): one aggregation with
    partial sketches in every task, one exchange of a few kilobytes a column and task."""
    aggs, rows = [], []
    for i, f in enumerate(df.schema.fields):
        v = _form(f.name, f.dataType)
        col = F.col("`" + f.name.replace("`", "``") + "`")
        aggs += [
            F.count_if(col.isNull()).alias(f"n{i}"),
            F.min(v.long).alias(f"a{i}"), F.max(v.long).alias(f"b{i}"),
            F.min(v.double).alias(f"c{i}"), F.max(v.double).alias(f"d{i}"),
            F.min(v.text).alias(f"e{i}"), F.max(v.text).alias(f"g{i}"),
            F.hll_sketch_agg(v.distinct, F.lit(LG_CONFIG)).alias(f"h{i}"),
            F.kll_sketch_agg_bigint(v.long, KLL_K).alias(f"k{i}"),
            F.kll_sketch_agg_double(v.double, KLL_K).alias(f"q{i}"),
        ]
        fields = [F.lit(f.name), F.lit(f.dataType.simpleString()), F.col("rows"),
                  *[F.col(f"{c}{i}") for c in "nabcdeghkq"]]
        rows.append(F.struct(*[x.alias(n.split()[0]) for x, n in zip(fields, SKETCH_SCHEMA.split(", "), strict=True)]))
    if not rows:
        return df.sparkSession.createDataFrame([], SKETCH_SCHEMA)
    return df.agg(F.count(F.lit(1)).alias("rows"), *aggs).select(F.inline(F.array(*rows)))


def merge(sketches: DataFrame) -> DataFrame:
    """Rows of any number of loads as one row per column (SKETCH_SCHEMA). A
    column whose type changed between loads has one row per type."""
    return sketches.groupBy("column_name", "data_type").agg(
        F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"),
        *[g(c).alias(c) for kind in ("long", "double", "text") for g, c in ((F.min, f"min_{kind}"), (F.max, f"max_{kind}"))],
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
        F.kll_merge_agg_bigint("long_sketch").alias("long_sketch"),
        F.kll_merge_agg_double("double_sketch").alias("double_sketch"))


def _long_as_text(value: Column) -> Column:
    """A whole number in the text of its column's type."""
    kind = F.col("data_type")
    return (F.when(kind == "date", F.date_from_unix_date(value.cast("int")).cast("string"))
            .when(kind.isin("timestamp", "timestamp_ntz"), F.timestamp_micros(value).cast("string"))
            .when(kind == "boolean", (value != 0).cast("string"))
            .otherwise(value.cast("string")))


def describe(sketches: DataFrame, probabilities: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Readable statistics of ``sketches`` (merged here): column_name,
    data_type, rows, nulls, min_value, max_value (text), distinct_count,
    quantiles (text, one per probability; NULL without an order by number)."""
    if not all(0 <= p <= 1 for p in probabilities):
        raise ValueError(f"probabilities must lie between 0 and 1: {probabilities}")
    m = merge(sketches)
    longs, doubles = F.col("min_long").isNotNull(), F.col("min_double").isNotNull()
    # an empty sketch has no quantile to ask for, so ask only where a value was seen
    quantiles = F.when(longs, F.array(*[
        _long_as_text(F.kll_sketch_get_quantile_bigint("long_sketch", F.lit(float(p)))) for p in probabilities])).when(
        doubles, F.array(*[
            F.kll_sketch_get_quantile_double("double_sketch", F.lit(float(p))).cast("string") for p in probabilities]))
    return m.select(
        "column_name", "data_type", "rows", "nulls",
        *[F.coalesce(_long_as_text(F.col(f"{b}_long")), F.col(f"{b}_double").cast("string"), F.col(f"{b}_text"))
          .alias(f"{b}_value") for b in ("min", "max")],
        F.hll_sketch_estimate("distinct_sketch").alias("distinct_count"), quantiles.alias("quantiles"))


class SketchStore:
    """The sketches of a table's loads, one folder of one small file a load."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def write(self, load_id: int, rows: DataFrame) -> None:
        """Summarise ``rows`` as load ``load_id``; a replay replaces it."""
        sketch(rows).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/load_id={int(load_id)}")

    def loads(self) -> list[int]:
        names = list_dir_names(self.spark, self.path, require="_SUCCESS")
        return sorted(int(n.split("=", 1)[1]) for n in names if n.startswith("load_id="))

    def drop(self, load_id: int | None = None) -> None:
        """Forget one load, or all."""
        delete_path(self.spark, self.path if load_id is None else f"{self.path}/load_id={int(load_id)}")

    def read(self) -> DataFrame:
        """The rows of every load, with ``load_id``."""
        if not self.loads():
            return self.spark.createDataFrame([], SKETCH_SCHEMA + ", load_id long")
        return self.spark.read.schema(SKETCH_SCHEMA + ", load_id long").parquet(self.path)
