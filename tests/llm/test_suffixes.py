"""Repeated-substring removal against a direct pass over all windows."""

import hashlib
import random

from pyspark.sql import functions as F

from starling.llm import suffixes

L = suffixes.LENGTH


def brute(rows):
    """rows in document order: {doc_id: (n_bytes, n_removed, n_spans, sha)}."""
    seen, out = set(), {}
    for i, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - L + 1):
            w = data[p : p + L]
            if w in seen:
                gone[p : p + L] = b"\1" * L
            seen.add(w)
        spans = sum(1 for k in range(len(gone)) if gone[k] and (k == 0 or not gone[k - 1]))
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out[i] = (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def corpus(seed):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdeéñ ") for _ in range(rnd.randint(1, 8)))
    passage = [" ".join(word() for _ in range(rnd.choice([18, 25, 40, 120]))) for _ in range(6)]
    rows = []
    for i in range(120):
        parts = []
        for _ in range(rnd.randint(0, 5)):
            kind = rnd.random()
            if kind < 0.5:
                parts.append(" ".join(word() for _ in range(rnd.choice([3, 30, 100]))))
            elif kind < 0.8:
                p = rnd.choice(passage)
                a = rnd.randrange(len(p))
                parts.append(p[a : a + rnd.choice([60, 99, 100, 101, 140, 400])])
            elif rows:
                parts.append(rnd.choice(rows)[1] or "")
            else:
                parts.append("x" * 300)
        rows.append((i * 7 % 997, " ".join(parts)))
    rows += [(2000, None), (2001, ""), (2002, "ab" * 200), (2003, "z" * 99), (2004, "z" * 100), (2005, "z" * 101)]
    return sorted(rows)


def check(spark, rows):
    docs = spark.createDataFrame([(t, i, "y", i) for i, t in rows], "text string, doc_id long, kept string, doc long")
    got = suffixes.digest(suffixes.remove_repeats(docs.select("doc_id", "text", "doc")))
    assert {r[0]: tuple(r)[1:] for r in got.collect()} == brute(rows)


def test_equals_all_windows(spark):
    for seed in (1, 2):
        check(spark, corpus(seed))


def test_periodic_texts(spark):
    check(spark, [(1, "ab" * 300), (2, "ab" * 120 + "c" + "ba" * 120), (3, "a" * 1000), (4, "a" * 150 + "b" * 150)])


def test_one_passage_in_every_document(spark):
    rnd = random.Random(4)
    passage = "".join(rnd.choice("abcdefgh ") for _ in range(260))
    check(spark, [(i, "".join(rnd.choice("ijklmnop ") for _ in range(150)) + passage + str(i) * 60) for i in range(60)])


def test_long_text_spans_buffers(spark, monkeypatch):
    rnd = random.Random(9)
    long = "".join(rnd.choice("abcd ") for _ in range(400_000))
    rows = [(1, long[100_000:100_500]), (2, long + long[5_000:6_000]), (3, "q" + long[399_000:])]
    check(spark, rows)


def test_empty_table_null_ids_and_repeated_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert suffixes.remove_repeats(empty).collect() == []
    text = "".join(random.Random(3).choices("abcdef ", k=300))
    docs = spark.createDataFrame([(None, text), (1, text), (1, text), (2, text + "!"), (None, "other")],
                                 "doc_id long, text string")
    got = sorted((r["doc_id"] or 0, r["n_bytes"], r["n_removed"]) for r in suffixes.remove_repeats(docs).collect())
    assert got == [(0, 5, 0), (0, 300, 0), (1, 300, 300), (1, 300, 300), (2, 301, 300)]


def test_other_columns_stay(spark):
    docs = spark.createDataFrame([(1, "a", "text", "en")], "doc_id long, row string, text string, lang string")
    out = suffixes.remove_repeats(docs)
    assert out.columns == ["doc_id", "row", "text", "lang", "kept", "n_bytes", "n_removed", "n_spans"]
    assert out.select("doc_id", "row", "text", "lang", F.decode("kept", "utf-8")).first()[:] == (1, "a", "text", "en", "text")


def test_one_python_worker_a_task(spark):
    """No two Python operators follow each other without a shuffle: an executor
    would hold twice as many workers, and keep them."""
    docs = spark.createDataFrame([(1, "a" * 150 + "b" * 120), (2, "a" * 150), (3, "c" * 20)], "doc_id long, text string")
    plan = suffixes.remove_repeats(docs)._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    depth_of = lambda line: len(line) - len(line.lstrip(" :|+-*"))
    above: list[tuple[int, str]] = []
    for line in plan.splitlines():
        while above and above[-1][0] >= depth_of(line):
            above.pop()
        node = line.lstrip(" :|+-*").split(" ")[0]
        if node in ("MapInArrow", "ArrowEvalPython"):
            between = [n for _, n in above]
            last = max((i for i, n in enumerate(between) if n in ("MapInArrow", "ArrowEvalPython")), default=None)
            assert last is None or "Exchange" in between[last:], plan
        above.append((depth_of(line), node))


def test_freed_memory_goes_back_after_each_batch(monkeypatch):
    import pyarrow as pa

    from starling.llm import common

    calls, batch = [], pa.RecordBatch.from_arrays([pa.array(range(10))], names=["x"])
    monkeypatch.setattr(common, "give_back", lambda: calls.append(1))
    assert [b.num_rows for b in common.slices(iter([batch, batch]), 4)] == [4, 4, 2] * 2
    assert len(calls) == 2
    monkeypatch.undo()
    common.give_back()
