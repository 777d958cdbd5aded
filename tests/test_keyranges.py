"""Sampled key ranges on a DataFrame that stands in for the source table."""

import datetime as dt
import random
import re
import uuid

import pytest
from pyspark.sql import functions as F

from starling.sinks import jdbc
from starling.sources.keyranges import (
    UnsplittableKeyError,
    balanced_predicates,
    check_splittable,
    literal,
    range_predicates,
    split_points,
)


def parts(df, predicates):
    """Rows per range; every row must meet exactly one condition."""
    met = df.select(*[F.expr(p).cast("int").alias(f"p{k}") for k, p in enumerate(predicates)])
    ones = sum(F.coalesce(F.col(c), F.lit(0)) for c in met.columns)
    assert met.where(ones != 1).count() == 0
    return [int(v or 0) for v in met.agg(*[F.sum(c) for c in met.columns]).first()]


def even(df, columns, n=8, most=2.0):
    sizes = parts(df, balanced_predicates(df, columns, n))
    assert len(sizes) == n and max(sizes) <= most * sum(sizes) / n
    assert sum(sizes) == df.count()


def test_uuid_keys(spark):
    rnd = random.Random(1)
    even(spark.createDataFrame([(str(uuid.UUID(int=rnd.getrandbits(128))),) for _ in range(20_000)], "k string"), ["k"])


def test_prefixed_text_keys(spark):
    """Keys that all begin alike, for which evenly spaced prefixes are one range."""
    df = spark.range(30_000).select(F.format_string("ORD-2024-%08d", F.pow("id", 1.3).cast("long")).alias("k"))
    even(df, ["k"])
    spaced = [F.expr(p) for p in jdbc.text_key_predicates("k", 8)]
    assert max(df.where(p).count() for p in spaced) == df.count()


def test_skewed_numbers(spark):
    even(spark.range(40_000).select(F.exp(F.col("id") / 1000).cast("double").alias("k")), ["k"])
    even(spark.range(40_000).select((F.col("id") * F.col("id") * F.col("id")).alias("k")), ["k"])
    even(spark.range(40_000).select((F.col("id") * F.col("id") / 7).cast("decimal(20,3)").alias("k")), ["k"])


def test_dates_and_times(spark):
    day = F.date_add(F.lit("2000-01-01").cast("date"), F.sqrt("id").cast("int"))
    even(spark.range(40_000).select(day.alias("k")), ["k"])
    even(spark.range(40_000).select(F.timestamp_seconds(F.pow("id", 1.5)).alias("k")), ["k"])


def test_hot_key(spark):
    """A third of the rows share one key: a range by itself, or cut by a second column."""
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.sha2(F.col("id").cast("string"), 256)).alias("k"),
                                    F.col("id").alias("line"))
    sizes = parts(df, balanced_predicates(df, ["k"], 8))
    assert sum(sizes) == 30_000 and max(sizes) <= 1.1 * 10_000 and sorted(sizes)[-2] <= 2 * 30_000 / 8
    even(df, ["k", "line"])


def test_nulls_few_rows_and_no_rows(spark):
    df = spark.createDataFrame([(None, 1), ("a", None), ("b", 2), (None, None), ("c'd", 3)], "k string, l int")
    for columns in (["k"], ["k", "l"], ["l"]):
        assert sum(parts(df, balanced_predicates(df, columns, 3))) == 5
    assert balanced_predicates(df.limit(0), ["k"], 8) == ["1 = 1"]
    assert balanced_predicates(df, ["k"], 1) == ["1 = 1"]
    assert parts(df.where("k IS NULL"), balanced_predicates(df, ["k"], 3))[0] == 2


def test_exactly_one_range_under_another_order(spark):
    """A database that compares without regard to case still gives each row to one range."""
    rnd = random.Random(2)
    words = ["".join(rnd.choice("aAbBcCdD") for _ in range(4)) for _ in range(3000)]
    predicates = range_predicates(["k"], split_points([(w,) for w in words], 8))
    df = spark.createDataFrame([(w,) for w in words], "k string")
    folded = [F.expr(_lower_literals(p.replace("k >=", "lower(k) >=").replace("k <", "lower(k) <"))) for p in predicates]
    met = df.select(sum(c.cast("int") for c in folded).alias("n"))
    assert met.where("n <> 1").count() == 0


def _lower_literals(predicate):
    return re.sub(r"'([^']*)'", lambda m: f"'{m.group(1).lower()}'", predicate)


def test_types_that_cannot_be_cut(spark):
    df = spark.createDataFrame([(True, bytearray(b"x"), "a")], "b boolean, y binary, k string")
    for c in ("b", "y", "none"):
        with pytest.raises(UnsplittableKeyError):
            check_splittable(df.schema, [c])
    assert literal("o'clock") == "'o''clock'" and literal(dt.date(2024, 1, 2)) == "DATE '2024-01-02'"


class Source:
    """Stands in for a database behind ``spark.read.jdbc``: records each read."""

    def __init__(self, df):
        self.df, self.reads = df, []

    def __call__(self, table, columns=None, predicates=None):
        self.reads.append((table, columns, predicates))
        rows = self.df.select(*columns) if columns else self.df
        if not predicates:
            return rows
        out = rows.where(predicates[0])
        for p in predicates[1:]:
            out = out.unionAll(rows.where(p))
        return out


def test_snapshot_read_by_sampled_ranges(spark):
    df = spark.range(20_000).select((F.col("id") * F.col("id")).alias("id"), F.lit("x").alias("v"))
    source = Source(df)
    got = jdbc.read_by_ranges(source, "t", ["id"], num_partitions=8)
    assert got.count() == 20_000 and got.select("id").distinct().count() == 20_000
    tables, columns, predicates = zip(*source.reads)
    assert set(tables) == {"t"} and columns[-1] is None and len(predicates[-1]) == 8
    sizes = [df.where(p).count() for p in predicates[-1]]
    assert max(sizes) <= 2 * 20_000 / 8


def test_numeric_key_without_bounds_is_not_cut_as_text(spark):
    """Text ranges of a number depend on the database's casts: never used."""
    source = Source(spark.range(1000).select(F.col("id")))
    jdbc.read_by_ranges(source, "t", ["id"], num_partitions=4)
    assert not any("'" in p for _, _, ps in source.reads for p in ps or [])
    with pytest.raises(UnsplittableKeyError):
        jdbc.read_by_ranges(Source(spark.range(3).select((F.col("id") > 1).alias("f"))), "t", ["f"], 4)
