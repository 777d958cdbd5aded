"""Context-tree weighting against a direct recursion over the definition."""

import math
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from starling.llm import ctw


def lower(data):
    return bytes(b + 32 if 65 <= b <= 90 else b for b in data)


def brute(train, texts):
    counts = defaultdict(lambda: [0, 0])  # (context, node) -> zeros, ones
    children = defaultdict(set)

    def bits(byte):
        node = 1
        for j in range(7, -1, -1):
            bit = byte >> j & 1
            yield node, bit
            node = 2 * node + bit

    def symbols(data):
        full = b"\xff" * 3 + lower(data) + b"\xff"
        for i in range(3, len(full)):
            yield full[i - 3 : i], full[i]

    for t in train:
        for ctx, byte in symbols(t):
            for node, bit in bits(byte):
                for d in range(4):
                    counts[ctx[3 - d :], node][bit] += 1
                    if d < 3:
                        children[ctx[3 - d :], node].add(ctx[2 - d :])

    def kt(a, b):
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    memo = {}

    def log_pw(ctx, node):
        if (ctx, node) not in memo:
            own = kt(*counts.get((ctx, node), (0, 0)))
            if len(ctx) == 3:
                memo[ctx, node] = own
            else:
                below = sum(log_pw(c, node) for c in sorted(children.get((ctx, node), ())))
                memo[ctx, node] = math.log(0.5) + np.logaddexp(own, below)
        return memo[ctx, node]

    def one(ctx, node):
        p = 0.5
        for d in (3, 2, 1, 0):
            c = ctx[3 - d :]
            a, b = counts.get((c, node), (0, 0))
            if d == 3:
                p = (b + 0.5) / (a + b + 1)
            elif a + b == 0:
                p = 0.5
            else:
                w = math.exp(math.log(0.5) + kt(a, b) - log_pw(c, node))
                p = w * (b + 0.5) / (a + b + 1) + (1 - w) * p
        return p

    out = []
    for t in texts:
        total = 0.0
        for ctx, byte in symbols(t):
            for node, bit in bits(byte):
                p = one(ctx, node)
                total += math.log10(p if bit else 1 - p)
        out.append(total)
    return out


TEXTS = ["The cat sat on the mat.", "the cat sat on the mat again\nand again", "", None, "Ünïcode ñ  \t x", "the cat",
         "zq" * 40, "The cat sat on the mat.", "a", "once more the cat sat", "   ", "mat mat mat"]


def test_scores_equal_the_definition(spark):
    rows = [(i, t, "x", i) for i, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string, key int")
    got = {r["doc_id"]: r for r in ctw.score_documents(docs, F.col("doc_id") % 4 == 0).collect()}
    assert sorted(got) == list(range(len(TEXTS)))
    train = [(t or "").encode() for i, t in enumerate(TEXTS) if i % 4]
    want = brute(train, [(t or "").encode() for t in TEXTS])
    words = lambda t: re.findall(rb"[^\x20\x09-\x0D]+", lower((t or "").encode()))
    count = Counter(w for t in train for w in [*words(t.decode()), "end"])
    n, v = sum(count.values()), len(count)
    for i, t in enumerate(TEXTS):
        r, tokens = got[i], [*words(t), "end"]
        assert math.isclose(r["score"], want[i], rel_tol=1e-9), i
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(tokens), sum(count[w] > 0 for w in tokens), n)
        assert math.isclose(r["base_score"], sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens))
        assert r["held_out"] == (i % 4 == 0)


def test_empty_table_and_no_training_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert ctw.score_documents(empty, F.lit(False)).collect() == []
    one = spark.createDataFrame([(1, "ab")], "doc_id long, text string")
    row = ctw.score_documents(one, F.lit(True)).first()
    assert row["train_tokens"] == 0 and row["n_known"] == 0 and row["base_score"] == 0.0
    assert math.isclose(row["score"], 3 * 8 * math.log10(0.5))


def test_unseen_weights_sum_to_one():
    rng = np.random.default_rng(1)
    text = bytes(rng.choice(list(b"abc "), 500).astype(np.uint8))
    keys, n = np.unique(ctw.grams(text), return_counts=True)
    trees = {}
    for k, c in zip(keys, n):
        trees.setdefault(int(k) >> 8 & 0xFFFF, []).append((int(k), int(c)))
    zeros, ones, pw = np.zeros((256, 256), int), np.zeros((256, 256), int), np.zeros((256, 256))
    for pair, rows in trees.items():
        t = ctw.PairTree(np.array([k for k, _ in rows]), np.array([c for _, c in rows]))
        zeros[pair & 255] += t.zeros
        ones[pair & 255] += t.ones
        pw[pair & 255] += t.log_pw
    top = ctw.TopTree(zeros, ones, pw)
    for ctx in (b"abc", b"xyz", b"zbc"):
        pair = ctx[1] << 8 | ctx[2]
        rows = trees.get(pair, [])
        base = ctx[0] << 24 | pair << 8
        p = ctw.log10_probabilities(top, np.array([k for k, _ in rows], int), np.array([c for _, c in rows], int),
                                    base + np.arange(256))
        assert math.isclose((10.0 ** p).sum(), 1.0, rel_tol=1e-9)


def test_query_sees_contexts_beyond_three_bytes(spark, tmp_root):
    from starling.llm.queries import op8_lm_score

    # the byte after "====" depends on the byte before it
    rows = [(i, ("a====b", "c====d")[i % 2]) for i in range(400)] + [(1000, "a====b"), (1001, "a====d")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_root}/documents.parquet")
    got = {r["doc_id"]: r["score"] for r in op8_lm_score(spark, tmp_root).collect()}
    assert got[1000] > got[1001] + 1


def test_deeper_weights_sum_to_one():
    rng = np.random.default_rng(2)
    text = bytes(rng.choice(list(b"ab"), 400).astype(np.uint8))
    keys, n = np.unique(ctw.grams(text, 6).astype(np.int64), return_counts=True)
    top = ctw.TopTree(np.ones((256, 256), int), np.ones((256, 256), int), np.zeros((256, 256)))
    same = (keys >> 8) & 0xFFFF == 0x6162
    for ctx in (int(keys[same][0]) >> 8 << 8, 0x7A7A7A7A616200):
        p = ctw.log10_probabilities(top, keys[same], n[same], ctx + np.arange(256), 6)
        assert math.isclose((10.0 ** p).sum(), 1.0, rel_tol=1e-9)


def test_few_bytes_are_kept_for_each_string(spark):
    """What a run leaves in the shared folder, against the distinct strings of its texts."""
    from pathlib import Path

    from starling.session import shared_root

    rng = np.random.default_rng(3)
    words = [bytes(rng.choice(list(b"abcdefghijklmnop"), 6).astype(np.uint8)).decode() for _ in range(2000)]
    texts = [" ".join(words[i] for i in rng.integers(0, 2000, 200)) for _ in range(200)]
    root = Path(shared_root(spark).removeprefix("file:"))
    size = lambda: sum(f.stat().st_size for f in root.rglob("*") if f.is_file())
    docs, before = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), size()
    assert ctw.score_documents(docs, F.lit(False), depth=6).count() == 200
    strings = len(np.unique(np.concatenate([ctw.grams(t.encode(), 6) for t in texts])))
    assert 0 < size() - before < 32 * strings


def test_packed_numbers():
    keys = np.array([0, 3, 2**40, 2**64 - 1], np.uint64)
    assert ctw.unpack_sorted(ctw.pack_sorted(keys)).tolist() == keys.tolist()
    assert ctw.unpack(ctw.pack(np.array([1.5, -2.0])), np.float64).tolist() == [1.5, -2.0]
    order, part, ends = ctw.by_part(ctw.GRAM, np.arange(0, 1 << 24, 1 << 7, dtype=np.uint64), 7)
    assert sorted(order.tolist()) == list(range(1 << 17)) and part.tolist() == list(range(7)) and ends[-1] == 1 << 17


def test_dealing_and_counting_take_little_room():
    """Neither holds several copies of a chunk's or a group's numbers at once."""
    n = 1 << 20
    keys = np.arange(n, dtype=np.uint64) * np.uint64(977)
    tracemalloc.start()
    order, part, ends = ctw.by_part(ctw.GRAM, keys, 32)
    dealt = tracemalloc.get_traced_memory()[1]
    tracemalloc.reset_peak()
    held = tracemalloc.get_traced_memory()[0]
    distinct, times = ctw.sorted_counts(np.append(keys, keys))
    counted = tracemalloc.get_traced_memory()[1] - held
    tracemalloc.stop()
    assert dealt < 28 * n  # 8 for the order; 40 and more with the hashes of all keys at once
    assert counted < 52 * n  # 16 for the two copies, 16 for the two of a sort of its own copy
    assert (distinct == keys).all() and (times == 2).all() and len(order) == ends[-1] == n and (part == np.arange(32)).all()
    assert [len(x) for x in ctw.sorted_counts(np.empty(0, np.uint64))] == [0, 0]
