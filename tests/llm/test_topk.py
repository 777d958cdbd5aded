"""Threshold algorithm against all products."""

import math

import numpy as np
from pyspark.sql import functions as F

from starling.llm import topk


def brute(rows, queries, k):
    ok = {i: np.floor(256 * np.array(v, float)).astype(int) for i, v in rows
          if i is not None and v and all(x is not None and math.isfinite(x) for x in v)}
    out = {}
    for q in sorted(ok):
        if q in queries:
            best = sorted((-int(ok[q] @ v), i) for i, v in ok.items() if i != q and len(v) == len(ok[q]))[:k]
            out[q] = [(i, -s) for s, i in best]
    return out


def collect(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        assert r["rank"] == len(out.setdefault(r["query_id"], [])) + 1
        out[r["query_id"]].append((r["vec_id"], r["score"]))
    return out


def test_equals_all_products(spark):
    rng = np.random.default_rng(3)
    rows = [(int(i), [float(x) for x in rng.normal(size=12).round(2)]) for i in range(500)]
    rows += [(1000 + i, [0.25] * 12) for i in range(60)]  # ties
    rows += [(2000, [0.0] * 12), (2050, None), (2100, [float("nan")] * 12), (2150, [1.0, None] * 6),
             (2200, [float("inf")] * 12), (2250, []), (None, [1.0] * 12), (2300, [1.0, -1.0]), (2301, [0.5, 2.0])]
    df = spark.createDataFrame([(i, v, 7, 1.0) for i, v in rows], "vec_id long, embedding array<float>, id int, score double")
    got = collect(topk.top_k(df, F.col("id") % 50 == 0))
    want = brute([(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows],
                 {i for i, _ in rows if i is not None and i % 50 == 0}, 5)
    assert got == {q: b for q, b in want.items() if b}


def test_stops_before_reading_all():
    rng = np.random.default_rng(1)
    rows = (rng.normal(size=(4000, 2)) ** 3 * 100).astype(np.int64)
    lists = topk.SortedLists(np.arange(4000), rows)
    ids, scores, scored = lists.top(np.array([5, 3]), -1, 5)
    order = np.lexsort((np.arange(4000), -(rows @ [5, 3])))[:5]
    assert ids.tolist() == order.tolist() and scored < 400


def test_stops_when_all_are_met():
    """Nothing is read of the lists behind the place where the last vector is met."""
    rng = np.random.default_rng(2)
    rows = np.floor(rng.normal(size=(2000, 64)) * 256).astype(np.int64)
    lists = topk.SortedLists(np.arange(2000), rows)
    places = np.zeros((2000, 64), bool)

    class Watched(np.ndarray):
        def __getitem__(self, at):
            places[at] = True
            return np.asarray(self)[at]

    lists.lists = lists.lists.view(Watched)
    ids, scores, scored = lists.top(rows[50], 50, 5)
    all_scores = rows @ rows[50]
    all_scores[50] = -(2**62)  # the query's own row takes no part
    order = np.lexsort((np.arange(2000), -all_scores))[:5]
    assert ids.tolist() == order.tolist() and scores.tolist() == all_scores[order].tolist()
    assert scored <= 1999 and places.mean() < 0.4


def test_scores_beyond_exact_floats():
    rows = np.array([[2**40 + 1, 1], [2**40, 2**20], [3, -(2**30)], [2**40 + 1, 2]], np.int64)
    lists = topk.SortedLists(np.arange(4), rows)
    ids, scores, _ = lists.top(np.array([2**20 + 1, 1]), -1, 4)
    want = rows @ np.array([2**20 + 1, 1])
    order = np.lexsort((np.arange(4), -want))
    assert ids.tolist() == order.tolist() and scores.tolist() == want[order].tolist()


def test_empty_few_and_repeated_rows(spark):
    schema = "vec_id long, embedding array<float>"
    assert topk.top_k(spark.createDataFrame([], schema), F.col("id") % 50 == 0).collect() == []
    df = spark.createDataFrame([(0, [1.0]), (0, [1.0]), (3, [2.0]), (3, [2.0])], schema)
    assert collect(topk.top_k(df, F.col("id") % 50 == 0)) == {0: [(3, 256 * 512)]}
