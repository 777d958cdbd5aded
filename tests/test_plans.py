
import re

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from starling.operators.scd2 import CUSTOMER_DIM, empty_dimension, empty_tombstones, scd2_merge
from starling.plans import queries as Q
from starling.sinks.dimension_store import DimensionStore


def _children(node):
    c = node.children()
    return [c.apply(i) for i in range(c.size())]


def _walk(node):
    yield node
    kids = _children(node)
    if node.nodeName().endswith("QueryStage"):  # adaptive stages hold their plan aside
        kids = [node.plan()]
    for k in kids:
        yield from _walk(k)


@pytest.fixture()
def no_aqe(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v)


def test_merge_shuffles_the_batch_once(spark):
    s = Q.silver(spark, SF_SMALL, "customer")
    r = scd2_merge(empty_dimension(spark, CUSTOMER_DIM), empty_tombstones(spark, CUSTOMER_DIM), s, CUSTOMER_DIM)
    out = r.rows
    out.collect()
    final = out._jdf.queryExecution().executedPlan().executedPlan()  # adaptive plan after execution
    # one exchange of the batch by key (the constant chunk of a batch without
    # hot keys is folded away); every other branch reuses it
    own = [n for n in _walk(final)
           if n.nodeName() == "Exchange" and re.search(r"hashpartitioning\(customer_id#\d+", n.toString())]
    assert len(own) == 1, final.toString()
    text = final.toString()
    assert "PythonUDF" not in text and "ArrowEvalPython" not in text


def test_second_batch_reads_active_set_bucketed(no_aqe, tmp_root):
    spark = no_aqe
    s = Q.silver(spark, SF_SMALL, "customer")
    day = F.to_date("dms_timestamp")
    store = DimensionStore(spark, tmp_root, CUSTOMER_DIM)
    store.apply(s.where(day == F.lit("2024-01-01").cast("date")), 0)
    active, tombs = store.state(0)
    r = scd2_merge(active, tombs, s.where(day == F.lit("2024-01-02").cast("date")), CUSTOMER_DIM,
                   out_partitions=store.buckets)
    plan = r.rows._jdf.queryExecution().executedPlan()
    checked = 0
    for node in _walk(plan):
        if not node.nodeName().endswith("Join"):
            continue
        for side in _children(node):
            names = [n.nodeName() for n in _walk(side)]
            scans = [n for n in _walk(side) if n.nodeName().startswith("Scan") and "_b0" in n.toString()]
            if scans:
                assert "Bucketed: true" in scans[0].toString()
                assert "Exchange" not in names, "the stored active set must not be shuffled"
                checked += 1
    assert checked >= 1
