"""The prefix trie against a trie of nested dictionaries."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from starling.llm import prefixtrie as pt
from starling.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"


def turn_key(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16]


def brute(rows):
    """Node rows by walking every rebuilt conversation down a trie."""
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", turn_key(role or "", text or ""), text or ""))
    turns = {c: [(r, t) for *_, r, _, t in sorted(v)] for c, v in convs.items()}
    rebuilt = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(np.fmod(c, 5))
        rebuilt[c] = turns.get(base, [])[:h] + own[h:]
    if not rebuilt:
        return []
    nodes = {}
    for c, seq in rebuilt.items():
        for d in range(len(seq) + 1):
            nodes.setdefault(tuple(seq[:d]), []).append(c)
    children = {}
    for p in nodes:
        if p:
            children.setdefault(p[:-1], []).append(p)
    out = []

    def walk(p):
        own = (len(nodes[p]) - 1) * len(p[-1][1].encode()) if p else 0
        leaves, saved = (0, own) if p in children else (1, own)
        for q in children.get(p, ()):
            a, b = walk(q)
            leaves, saved = leaves + a, saved + b
        ends = ",".join(map(str, sorted(c for c in nodes[p] if len(rebuilt[c]) == len(p))))
        out.append((min(nodes[p]), len(p), min(nodes[p[:-1]]) if p else None, len(nodes[p]), len(children.get(p, ())),
                    leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
        return leaves, saved

    walk(())
    return out


def key(row):
    return tuple((x is not None, x) for x in row)


def same(got, rows):
    assert sorted(map(tuple, got), key=key) == sorted(brute(rows), key=key)


def made(rnd, n, words, most, ids=None):
    rows = []
    for c in range(n):
        for t in range(rnd.randint(0, most)):
            rows.append((c if ids is None else ids[c], t, rnd.choice(["user", "assistant"]), rnd.choice(words)))
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("lists, turns", [(4096, 1 << 17), (3, 1 << 17), (1, 4), (50, 7)])
def test_any_block_size(spark, monkeypatch, lists, turns):
    monkeypatch.setattr(pt, "BLOCK_LISTS", lists)
    monkeypatch.setattr(pt, "BLOCK_TURNS", turns)
    rnd = random.Random(lists)
    rows = made(rnd, 120, ["a", "b", "é"], 9)
    # a hot conversation of many copies, one that goes on behind it, long chains
    for c in range(200, 260):
        rows += [(c, t, "user", f"same {t}") for t in range(10)]
    rows += [(300, t, "user", f"same {t}") for t in range(40)] + [(305, t, "user", f"same {t}") for t in range(39)]
    same(pt.prefix_trie(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect(), rows)


def test_cases(spark):
    rows = [(1, None, None, None), (1, 0, "user", ""), (1, 0, "user", "x"), (1, 0, "user", "x"), (1, 0, "assistant", "y"),
            (None, 0, "user", "lost"), (0, 0, "user", "shared"), (-3, 2, "user", "z"), (-3, None, "user", "z"),
            (2, 0, "u", "ser"), (3, 0, "us", "er"), (7, 0, "user", "w" * 300_000), (9223372036854775807, 1, "user", "top"),
            (-9223372036854775808, 1, "user", "bottom")]
    df = spark.createDataFrame([(*r, 5, "x") for r in rows], SCHEMA + ", depth long, `a.b` string")
    same(pt.prefix_trie(df).collect(), rows)
    assert pt.prefix_trie(df.limit(0)).collect() == []
    assert pt.prefix_trie(df.where("conv_id IS NULL")).collect() == []


def test_one_turnless_conversation(spark):
    c = next(c for c in range(1, 99) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 2)
    rows = [(c, 0, "user", "gone")]
    same(pt.prefix_trie(spark.createDataFrame(rows, SCHEMA)).collect(), rows)


def test_sparse_table():
    rnd = np.random.default_rng(5)
    for n in (1, 2, 3, 7, 64, 100):
        v = rnd.integers(0, 6, n)
        table = pt.SparseTable(v)
        for d in range(8):
            for i in range(n):
                at, depth = np.array([i]), np.array([d])
                assert table.after(at, depth)[0] == next((j for j in range(i, n) if v[j] < d), n)
                assert table.before(at, depth)[0] == next((j for j in range(i, -1, -1) if v[j] < d), -1)
                for e in range(i, n + 1):
                    low = table.minimum(at, np.array([e]))[0]
                    assert low == (v[i:e].min() if e > i else pt.FAR)


def test_query_over_the_whole_table(spark):
    d = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    same(QUERIES["op13_prefix_trie"](spark, d).collect(), rows)
