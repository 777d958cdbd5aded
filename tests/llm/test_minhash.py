"""Near-dedup against all pairs; components against union-find."""

import random
import re

from pyspark.sql import functions as F

from starling.llm import minhash
from starling.llm.components import components


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def brute(rows, size, percent):
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(t))
        sets[i] = {tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))} if w else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for x in ids:
        for y in ids:
            if x < y and sets[x] and sets[y]:
                c = len(sets[x] & sets[y])
                if 100 * c >= percent * (len(sets[x]) + len(sets[y]) - c):
                    a, b = sorted((find(x), find(y)))
                    root[b] = a
    return {i: (len(sets[i]), find(i)) for i in ids}


def corpus(seed, n=260):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    texts = []
    for i in range(n):
        kind = rnd.random()
        if kind < 0.45 or len(texts) < 5:
            texts.append(" ".join(rnd.choices(words, k=rnd.choice([1, 2, 3, 30, 120, 400]))))
        elif kind < 0.55:
            texts.append(rnd.choice(texts))
        else:  # an edited copy, some of them of the first long text: one large group
            base = (texts[0] if rnd.random() < 0.5 else rnd.choice(texts)).split()
            for _ in range(rnd.randint(0, 1 + len(base) // 15)):
                base[rnd.randrange(len(base))] = rnd.choice(words)
            texts.append(" ".join(base).upper() if rnd.random() < 0.2 else " \t\n".join(base))
    texts[0] = texts[0] if len(texts[0]) > 300 else " ".join(rnd.choices(words, k=200))
    return [(i * 3 + 1, t) for i, t in enumerate(texts)] + [(10_001, None), (10_002, ""), (10_003, " \n "), (10_004, "solo")]


def test_equals_all_pairs(spark):
    for seed, size in ((1, 2), (2, 5)):
        rows = corpus(seed)
        docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, label string, n long")
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"])
               for r in minhash.near_duplicates(docs, shingle=size).collect()}
        want = brute(rows, size, 80)
        assert got == {i: (n, c, i == c) for i, (n, c) in want.items()}


def test_later_rounds_find_links_that_leaders_miss(spark, monkeypatch):
    """A chain in which only neighbours are similar; leaders see few of them."""
    monkeypatch.setattr(minhash, "ROUNDS", (minhash.SMALLEST, minhash.EXACT))
    base = [f"w{i}" for i in range(900)]
    rows = [(k, " ".join(base[k * 12 : k * 12 + 240])) for k in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(docs, shingle=1).collect()}
    assert got == {i: c for i, (_, c) in brute(rows, 1, 80).items()} == dict.fromkeys(range(30), 0)


def test_empty_table_null_ids_and_repeated_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert minhash.near_duplicates(empty).collect() == []
    docs = spark.createDataFrame([(None, "a b c"), (4, "a b c"), (4, "a b c"), (2, "a b c"), (9, None)],
                                 "doc_id long, text string")
    got = sorted((r["doc_id"] or -1, r["n_shingles"], r["component_id"] or -1, r["kept"])
                 for r in minhash.near_duplicates(docs).collect())
    assert got == [(-1, 1, -1, True), (2, 1, 2, True), (4, 1, 2, False), (4, 1, 2, False), (9, 0, 9, True)]


def test_components(spark):
    rnd = random.Random(5)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 440)]
    root = {}

    def find(i):
        root.setdefault(i, i)
        while root[i] != i:
            i = root[i]
        return i

    for u, v in edges:
        if u != v:
            a, b = sorted((find(u), find(v)))
            root[b] = a
    got = components(spark.createDataFrame(edges, "u long, v long"))
    assert {r["node"]: r["component"] for r in got.collect()} == {i: find(i) for i in list(root)}
    assert got.count() == got.select(F.countDistinct("node")).first()[0]
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []
