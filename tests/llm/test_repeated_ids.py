"""One doc_id with two texts, one vec_id with two vectors, equal rows thrice."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from starling.llm import langid, minhash, suffixes, topk
from starling.llm.common import row_keys

A = " ".join(f"alpha{i}" for i in range(60))
B = " ".join(f"beta{i}" for i in range(60))
C = " ".join(f"gamma{i}" for i in range(60))
DOCS = [(5, A), (5, B), (7, A + " more"), (9, B), (8, C), (8, C), (8, C), (None, A), (3, None), (3, ""), (11, B + " tail")]


def docs(spark):
    return spark.createDataFrame([(*d, "x", 1) for d in DOCS], "doc_id long, text string, `a.b` string, n_bytes int")


def test_row_keys(spark):
    keys = {(r.doc_id, r.text or ""): r.row_key for r in row_keys(docs(spark)).collect()}
    named = sorted((k for k in keys if k[0] is not None), key=lambda k: keys[k])
    assert len({keys[k] for k in named}) == len(named) and [k[0] for k in named] == sorted(k[0] for k in named)
    assert keys[None, A] is None
    alone = docs(spark).where("doc_id IN (7, 8, 9)")
    assert all(r.row_key == r.doc_id for r in row_keys(alone).collect())


def test_links_of_both_texts(spark):
    got = sorted((r.doc_id is not None, r.doc_id or 0, r.n_shingles, r.component_id, r.kept)
                 for r in minhash.near_duplicates(docs(spark), shingle=2, percent=80).collect())
    want = [(False, 0, 59, None, True), (True, 3, 0, 3, True), (True, 3, 0, 3, True), (True, 5, 59, 5, True), (True, 5, 59, 5, True),
            (True, 7, 60, 5, False), (True, 8, 59, 8, True), (True, 8, 59, 8, True), (True, 8, 59, 8, True),
            (True, 9, 59, 5, False), (True, 11, 60, 5, False)]
    assert got == want


def test_passages_of_both_texts(spark):
    rows = suffixes.remove_repeats(docs(spark).where("doc_id IS NOT NULL")).collect()
    got = sorted((r.doc_id, r.text or "", r.n_bytes, r.n_removed) for r in rows)
    assert len(got) == 10
    left = {(d, t): (n, removed) for d, t, n, removed in got}
    assert left[5, A] == (len(A), 0) and left[5, B] == (len(B), 0) and left[8, C] == (len(C), 0)
    assert left[9, B] == (len(B), len(B)) and left[7, A + " more"] == (len(A) + 5, len(A)) and left[3, ""] == (0, 0)
    assert {r["a.b"] for r in rows} == {"x"}


def test_near_dedup_stage_drops_no_other_text(spark):
    rows = docs(spark).select("doc_id", "text", F.lit("en").alias("lang"), "`a.b`")
    got = corpus_pipeline.remove_near_copies(spark, rows, "")
    assert got.columns == rows.columns
    assert sorted((r.doc_id or 0, r.text or "") for r in got.collect()) == sorted(
        [(0, A), (3, ""), (5, A), (5, B), (8, C)])


def test_vectors_of_one_id_and_large_components(spark):
    rows = [(50, [1.0, 0.0, 0.0, 0.0]), (50, [0.0, 1.0, 0.0, 0.0]), (1, [3.0, 0.0, 0.0, 0.0]), (1, [9.0, 2.0, 0.0, 0.0]),
            (2, [1e6, 0.0, 1.0, 1.0]), (3, [-1e6, 5.0, 0.0, 0.0])]
    schema = "vec_id long, embedding array<float>"
    got = [tuple(r) for r in topk.top_k(spark.createDataFrame(rows, schema), F.col("id") % 50 == 0).collect()]
    v = [(i, np.floor(256 * np.array(x)).astype(int)) for i, x in rows]
    pairs = sorted((-int(q @ c), i) for j, q in v if j == 50 for i, c in v if i != 50)[:5]
    assert sorted(got) == sorted((50, k + 1, i, -s) for k, (s, i) in enumerate(pairs))
    big = spark.createDataFrame([(50, [1.0] * 4), (1, [1e8] * 4)], schema)
    with pytest.raises(Exception, match="too large for exact scores, id 1"):
        topk.top_k(big, F.col("id") % 50 == 0).collect()


def test_digits_that_are_no_letters(spark):
    model = langid.Classifier({"en": b"the of and " * 50, "de": b"der die und " * 50})
    for text in ("½ ²", "①", "12 _ .", "", None, "٣"):
        assert model.classify(text)[0] == "und"
    assert model.classify("the ½ of")[0] == "en"
