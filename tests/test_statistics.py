"""Mergeable column statistics: exact parts against plain aggregates, sketches within their errors."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starling.plans.jobs import FACT_JOBS
from starling.schemas import FACT_ORDER_DETAILS
from starling.sinks.statistics import DISTINCT_ERROR, RANK_ERROR, describe, merge, sketch
from starling.sinks.warehouse import Warehouse

DETAILS = FACT_JOBS["orderdetails"][0]


def by_name(df):
    return {r.column_name: r for r in df.collect()}


def details(spark, lo, hi):
    return spark.range(lo, hi).select(
        F.col("id").cast("string").alias("order_details_id"), (F.col("id") % 7).cast("string").alias("order_id"),
        F.lit(None).cast("string").alias("product_id"), (F.col("id") % 1000).cast("int").alias("product_quantity"),
        F.date_from_unix_date((F.col("id") % 30).cast("int")).alias("ingestion_date"))


@pytest.fixture()
def wh(spark, tmp_root):
    name = "stats_" + tmp_root.rsplit("/", 1)[-1]
    yield Warehouse(spark, name, tmp_root + "/wh")
    spark.sql(f"DROP DATABASE `{name}` CASCADE")


def test_merged_sketches_are_within_their_errors(spark):
    parts = [spark.range(a, a + 40_000).select(F.col("id").alias("n"), (F.col("id") / 4).alias("x"),
                                               F.sha2(F.col("id").cast("string"), 256).alias("t"))
             for a in (0, 20_000, 90_000)]
    all_sketches = sketch(parts[0]).unionByName(sketch(parts[1])).unionByName(sketch(parts[2]))
    got = by_name(describe(all_sketches, (0.1, 0.5, 0.9)))
    values = sorted([*range(0, 40_000), *range(20_000, 60_000), *range(90_000, 130_000)])
    for name in ("n", "x", "t"):
        assert got[name].rows == 120_000 and got[name].nulls == 0
        assert abs(got[name].distinct_count / 100_000 - 1) < 4 * DISTINCT_ERROR
    for name, unit in (("n", 1), ("x", 0.25)):
        for p, q in zip((0.1, 0.5, 0.9), got[name].quantiles, strict=True):
            rank = sum(v * unit <= float(q) for v in values) / len(values)
            assert abs(rank - p) < 2 * RANK_ERROR
    assert (got["n"].min_value, got["n"].max_value) == ("0", "129999") and got["t"].quantiles is None


def test_merging_is_associative_in_its_exact_parts(spark):
    parts = [sketch(details(spark, a, a + 500)) for a in (0, 500, 1000)]
    left = merge(merge(parts[0].unionByName(parts[1])).unionByName(parts[2]))
    once = merge(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    cols = ["column_name", "rows", "nulls", "min_value", "max_value"]
    rows = lambda m: sorted(tuple(map(str, r)) for r in describe(m).select(*cols).collect())
    assert rows(left) == rows(once) == rows(sketch(details(spark, 0, 1500)))


def test_types_nulls_and_odd_names(spark):
    rows = [(1, 2.5, Decimal("1.10"), dt.date(2024, 1, 2), dt.datetime(2024, 1, 2, 3, 4, 5), True, "é", b"\x01", None, {"k": 1}),
            (None, float("nan"), None, None, None, None, "", None, None, None)]
    df = spark.createDataFrame(rows, "`a.b` int, x double, dec decimal(10,2), d date, ts timestamp, yes boolean, `t``` string, "
                                     "raw binary, none string, m map<string,int>")
    got = by_name(describe(sketch(df), (0.5,)))
    assert [got[c].nulls for c in ("a.b", "x", "dec", "none", "m")] == [1, 0, 1, 2, 1]
    assert (got["a.b"].min_value, got["a.b"].quantiles) == ("1", ["1"])
    assert (got["x"].min_value, got["x"].max_value, got["x"].distinct_count) == ("2.5", "2.5", 2)
    assert got["dec"].max_value == "1.1" and got["d"].quantiles == ["2024-01-02"]
    assert got["ts"].min_value == "2024-01-02 03:04:05" and got["yes"].max_value == "true"
    assert (got["t`"].min_value, got["t`"].max_value, got["raw"].min_value) == ("", "é", "01")
    for c in ("none", "m"):
        assert (got[c].min_value, got[c].distinct_count, got[c].quantiles) == (None, 0, None)


def test_empty_inputs(spark):
    got = by_name(describe(sketch(details(spark, 0, 0))))
    assert len(got) == 5 and all(r.rows == 0 and r.distinct_count == 0 and r.quantiles is None for r in got.values())
    both = by_name(describe(sketch(details(spark, 0, 0)).unionByName(sketch(details(spark, 5, 6)))))
    assert both["product_quantity"].quantiles == ["5", "5", "5"]
    assert describe(sketch(details(spark, 0, 0)).where("false")).count() == 0
    with pytest.raises(ValueError, match="between 0 and 1"):
        describe(sketch(details(spark, 0, 1)), (1.5,))


def test_statistics_follow_appends_replays_and_drops(spark, wh):
    def load(lo, hi, load_id, analyze="sketches"):
        wh.load(details(spark, lo, hi), DETAILS, FACT_ORDER_DETAILS, mode="append", load_id=load_id, analyze=analyze)

    def bounds():
        r = by_name(wh.column_statistics(DETAILS))["product_quantity"]
        return r.rows, r.min_value, r.max_value

    load(10, 20, 0)
    load(100, 130, 1)
    assert bounds() == (40, "10", "129")
    load(200, 205, 1)  # a replay with other rows
    assert bounds() == (15, "10", "204")
    wh.drop_load(DETAILS, 0)
    assert bounds() == (5, "200", "204")
    load(0, 3, 2, analyze="table")
    with pytest.raises(ValueError, match=r"loads \[2\] have no sketches"):
        wh.column_statistics(DETAILS)
    wh.load(details(spark, 1, 4), DETAILS, FACT_ORDER_DETAILS, mode="truncate_load", analyze="sketches")
    assert bounds() == (3, "1", "3")
    with pytest.raises(ValueError, match="need a load_id"):
        wh.load(details(spark, 0, 1), "plain", FACT_ORDER_DETAILS, mode="append", analyze="sketches")


def test_reading_statistics_scans_no_row_of_the_table(spark, wh):
    wh.load(details(spark, 0, 9), DETAILS, FACT_ORDER_DETAILS, mode="append", load_id=0, analyze="sketches")
    plan = wh.column_statistics(DETAILS)._jdf.queryExecution().executedPlan().toString()
    assert "_statistics" in plan and "order_details_id" not in plan
