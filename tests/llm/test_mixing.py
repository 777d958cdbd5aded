"""Mixing: exponent, quotas and draws against plain Python."""

import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from starling.llm import mixing

SIZES = {"big": 900, "mid": 120, "small": 30, None: 45}


def corpus(spark):
    rows, i = [], 0
    for s, n in SIZES.items():
        for k in range(n):
            rows.append((i, " ".join(["w"] * (1 + (i * 7) % 13)), s, i % 3))
            i += 1
    rows += [(i, None, "small", 0), (i + 1, "", "none", 0)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, n long")


def plan(draws):
    rows = draws.select("doc_id", "source", "draw.*").collect()
    tokens, weight = Counter(), {}
    for r in rows:
        tokens[r["source"]] += r["n_tokens"]
        weight[r["source"]] = r["weight"]
    return rows, tokens, weight


def totals(spark):
    t = Counter()
    for r in corpus(spark).collect():
        t[r["source"]] += len((r["text"] or "").split())
    return t


def test_repeat_limit_keeps_every_document(spark):
    rows, drawn, weight = plan(mixing.mix(corpus(spark), max_repeats=2.0))
    t = totals(spark)
    times = Counter(r["doc_id"] for r in rows)
    assert len(times) == sum(SIZES.values()) + 2 and min(times.values()) == 1 and max(times.values()) <= 2
    a = rows[0]["exponent"]
    biggest, least = max(t.values()), min(v for v in t.values() if v)
    assert math.isclose((biggest / least) ** (1 - a), 2.0, rel_tol=1e-6)
    z = sum(v ** a for v in t.values() if v)
    for s, v in t.items():
        assert math.isclose(weight[s], v ** a / z if v else 0.0, rel_tol=1e-9)
        quota = v * (biggest / v) ** (1 - a) if v else 0
        assert quota <= drawn[s] + 1e-6 and drawn[s] < quota + 13 + 1e-6
    assert len({(r["repeat"], r["doc_id"]) for r in rows}) == len(rows)


def test_target_entropy_and_budget(spark):
    rows, drawn, weight = plan(mixing.mix(corpus(spark), target_entropy=1.2, budget=3000))
    assert abs(-sum(w * math.log(w) for w in weight.values() if w) - 1.2) < 1e-6
    for s, w in weight.items():
        assert w * 3000 <= drawn[s] + 1e-6 < w * 3000 + 13 + 1e-6
    _, _, capped = plan(mixing.mix(corpus(spark), max_repeats=2.0, budget=3000))
    t = totals(spark)
    assert abs(max(3000 * w / t[s] for s, w in capped.items() if t[s]) - 2.0) < 1e-3


def test_draws_are_block_permutations(spark):
    rows, _, _ = plan(mixing.mix(corpus(spark), max_repeats=3.0))
    order = defaultdict(lambda: defaultdict(list))
    for r in sorted(rows, key=lambda r: (r["repeat"], r["block_order"], r["doc_order"])):
        order[r["source"]][r["repeat"]].append(r["doc_id"])
    assert set(order["mid"][1]) <= set(order["mid"][0])
    first = [d for d in order["small"][0] if d in set(order["small"][1])]
    assert sorted(first) == sorted(order["small"][1]) and first != order["small"][1]


def test_empty_table_repeated_rows_and_arguments(spark):
    schema = "doc_id long, text string, source string"
    assert mixing.mix(spark.createDataFrame([], schema), max_repeats=2.0).collect() == []
    same = spark.createDataFrame([(1, "a b", "s")] * 3 + [(None, None, None)], schema)
    out = mixing.mix(same, max_repeats=2.0)
    assert out.columns == ["doc_id", "text", "source", "draw"] and out.count() == 4
    with pytest.raises(ValueError):
        mixing.bisect_exponent(same.select(F.lit(1).alias("t")))


def test_targets_beyond_exponent_one(spark):
    rows, _, weight = plan(mixing.mix(corpus(spark), target_entropy=0.2, budget=3000))
    assert rows[0]["exponent"] > 1
    assert abs(-sum(w * math.log(w) for w in weight.values() if w) - 0.2) < 1e-6
    with pytest.raises(ValueError):
        mixing.mix(corpus(spark), max_repeats=1.0, budget=10 * sum(totals(spark).values()))
    even = spark.createDataFrame([("a", 5), ("b", 5)], "source string, t long")
    for target in (0.1, 0.8):  # two equal sources have ln 2
        with pytest.raises(ValueError):
            mixing.bisect_exponent(even, target_entropy=target)
