"""Fingerprints against a version in plain Python (Spark's xxhash64)."""

import hashlib
import random
import re

import xxhash

from pyspark.sql import functions as F

from starling.llm import fingerprints as fp


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def xx(data, seed=42):
    data = data if isinstance(data, bytes) else data.to_bytes(8, "little", signed=True)
    return signed(xxhash.xxh64_intdigest(data, seed=seed & ((1 << 64) - 1)))


def chain(values):
    seed = 42
    for v in values:
        seed = xx(v, seed)
    return seed


def xx_int(v, seed):  # an int is hashed by its four bytes
    return signed(xxhash.xxh64_intdigest(v.to_bytes(4, "little", signed=True), seed=seed & ((1 << 64) - 1)))


def brute(text):
    w = [xx(x.encode()) for x in re.split(r"[\x20\x09-\x0D]+", (text or "").lower()) if x]
    if not w:
        return []
    h = [chain(w[i : i + 5]) for i in range(len(w) - 4)] if len(w) >= 5 else [chain(w)]
    low = {}
    for x in h:
        low[x >> 57] = min(low.get(x >> 57, x), x)
    out = []
    for k in range(-64, 64):
        v = low[k] if k in low else min((xx(j, xx_int(k, 42)), x) for j, x in low.items())[1]
        out.append((v & 255) - 128)
    return out


def test_equals_plain_python(spark):
    rnd = random.Random(1)
    texts = [None, "", " \n\t", "One two", "a b c d e", "ä ö ü ß É x y z " * 3]
    texts += [" ".join(f"w{rnd.randrange(90)}" for _ in range(rnd.choice([6, 20, 300, 2500]))) for _ in range(12)]
    rows = [(i * 5, t, "t") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, key string")
    got = {r["doc_id"]: r for r in fp.edited_fingerprints(df).collect()}
    plain = [t or "" for t in texts]
    for k, t in enumerate(plain):
        nxt = plain[(k + 1) % len(plain)]
        half = len(t) // 2
        edited = t[: len(t) - half] + nxt[:half]
        r, a, b, c = got[k * 5], brute(t), brute(edited), brute(nxt)
        text = lambda f: "".join(f"{x + 128:02X}" for x in f)
        near = lambda x, y: 1.0 if not x and not y else 0.0 if not x or not y else max(
            0.0, (sum(p == q for p, q in zip(x, y)) / 128 - 1 / 256) / (1 - 1 / 256))
        assert (r["n_chars"], r["edited_sha256"]) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert (r["fingerprint"], r["edited_fingerprint"]) == (text(a), text(b)), k
        assert abs(r["near_edited"] - near(a, b)) < 1e-12 and abs(r["near_next"] - near(a, c)) < 1e-12


def test_likeness_estimates_similarity(spark):
    rnd = random.Random(2)
    word = lambda: f"w{rnd.randrange(10 ** 6)}"
    rows = []
    for _ in range(60):
        common, a, b = ([word() for _ in range(n)] for n in (600, 200, 200))
        rows.append((" ".join(common + a), " ".join(common + b)))
    df = spark.createDataFrame(rows, "a string, b string")
    got = df.select(fp.likeness(fp.fingerprint(F.col("a")), fp.fingerprint(F.col("b"))).alias("x")).agg(F.avg("x")).first()[0]
    assert abs(got - 0.6) < 0.04


def test_next_over_many_ranges_nulls_and_ties(spark, monkeypatch):
    monkeypatch.setattr(fp, "MIN_RANGES", 40)
    rows = [(i * i * 3, f"t{i}") for i in range(300)] + [(None, "n2"), (None, "n1"), (75, "t5"), (75, "u")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    keyed = df.withColumn("key", F.coalesce("doc_id", F.lit(-(2**63))))
    got = sorted((r["key"], r["text"], r["next_text"]) for r in fp.with_next(keyed, "key", "text", ["text"]).collect())
    order = sorted((-(2**63) if i is None else i, t) for i, t in rows)
    assert got == [(*order[k], order[(k + 1) % len(order)][1]) for k in range(len(order))]


def test_empty_and_single(spark):
    schema = "doc_id long, text string"
    assert fp.edited_fingerprints(spark.createDataFrame([], schema)).collect() == []
    row = fp.edited_fingerprints(spark.createDataFrame([(7, "abcd")], schema)).first()
    assert row["edited_sha256"] == hashlib.sha256(b"abab").hexdigest() and row["near_next"] == 1.0
