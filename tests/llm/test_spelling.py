"""Spelling variants against brute force over all words."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from starling.llm import spelling as sp
from starling.llm.queries import QUERIES

RUN = re.compile("[A-Za-zÀ-ÿ]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def variants(word, alphabet):
    """All strings of one edit."""
    for i in range(len(word) + 1):
        for c in alphabet:
            yield word[:i] + c + word[i:]
        if i < len(word):
            yield word[:i] + word[i + 1 :]
            for c in alphabet:
                yield word[:i] + c + word[i + 1 :]


def brute(docs):
    n = Counter()
    for doc, text in docs:
        for r in RUN.findall(text or ""):
            r = r.translate(UPPER)
            h = 1 if doc is None else zlib.crc32(f"{doc}:{r}".encode())
            if h % 97 == 0:
                r = r[: h % len(r)] + r[h % len(r) + 1 :]
            if len(r) >= 5:
                n[r] += 1
    n = {w: k for w, k in n.items() if k >= 3}
    alphabet = sorted({c for w in n for c in w})
    form, near = {}, {}
    for w in n:
        close = {v for v in variants(w, alphabet) if v != w and v in n}
        near[w] = len(close)
        best = min(close, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, n[w], near[w], form[w], n.get(form[w]), root))
    return sorted(out, key=str)


COLUMNS = ("word", "n", "n_near", "form", "form_n", "root")


def result(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


def corpus(rnd, n_words, n_docs):
    parts = ["an", "ber", "é", "chi", "on", "ÿ", "ta", "le", "x", "aa"]
    base = ["".join(rnd.choice(parts) for _ in range(rnd.randint(2, 6))) for _ in range(n_words)]
    words = [w for w in base for _ in range(rnd.choice([1, 1, 3, 9]))]
    words += [rnd.choice([*variants(w, "aéÿx")]) for w in words for _ in range(3)]
    return [(i, rnd.choice([" ", "\n", "-", "1"]).join(
        rnd.choice([str.lower, str.title, str])(rnd.choice(words)) for _ in range(rnd.randint(0, 400)))) for i in range(n_docs)]


@pytest.mark.parametrize("least", [32, 2])
def test_against_all_words(spark, monkeypatch, least):
    monkeypatch.setattr(sp, "MIN_FREQUENCY", least)
    docs = corpus(random.Random(least), 300, 60)
    want = brute(docs)
    assert len(want) > 500 and sum(w[2] > 0 for w in want) > 100 and len({w[5] for w in want if w[3]}) > 5
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    assert result(sp.spelling_variants(df)) == want


def test_cases(spark):
    long = "q" * 20_000
    docs = [(1, None), (2, ""), (3, "Tests tests TESTS test tes"), (3, "tests"), (3, "tests"), (None, "tests tests texts"),
            (4, "texts texts"), (5, "×÷×÷× " * 3), (6, "École École École école école école"),
            (7, f"{long} {long}x {long}"), (8, f"{long} {long}x"), (9, f"{long}x " * 5), (10, "abcde " * 4 + "abcdf " * 4 + "abcdg " * 8)]
    df = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, n long, `a.b` string")
    assert result(sp.spelling_variants(df)) == brute(docs)
    assert sp.spelling_variants(df.limit(0)).collect() == []


def test_chains_of_forms(spark):
    chain = ["aaaaa", "aaaab", "aaabb", "aabbb", "abbbb", "bbbbb", "bbbbc", "bbbcc"]
    docs = [(None, " ".join(w for k, w in enumerate(chain) for _ in range(3 << k)))]
    got = result(sp.spelling_variants(spark.createDataFrame(docs, "doc_id long, text string")))
    assert got == brute(docs) and {r[5] for r in got} == {"bbbcc"}


words = st.text(alphabet="abÿ", min_size=5, max_size=14)
frequent = st.lists(st.text(alphabet="abÿ\x01\x02", min_size=2, max_size=5), max_size=40)


@settings(max_examples=600, deadline=None)
@given(words, frequent, st.integers(0, 20), st.sampled_from("abÿ"), st.sampled_from(["insert", "delete", "replace"]))
def test_near_words_meet_in_their_rarest_grams(word, grams, at, letter, edit):
    """Whatever the dictionary: near words share as many placed grams as the
    bound says, and one of their rarest ones."""
    at %= len(word)
    other = {"insert": word[:at] + letter + word[at:], "delete": word[:at] + word[at + 1 :],
             "replace": word[:at] + letter + word[at + 1 :]}[edit]
    if other == word or len(other) < 5:
        return
    keys = sorted({int(sp.gram_codes(np.frombuffer(g.encode("latin-1"), np.uint8).astype(np.uint64), len(g))[0]) for g in grams})
    d = sp.Dictionary(np.array(keys, np.uint64), np.arange(1, len(keys) + 1))
    short, long = sorted((word, other), key=len)
    step = len(long) - len(short)
    parts, common, rarest = {}, {}, {}
    for w in (short, long):
        parts[w] = d.decompose(w)
        bound = sp.affected(parts[w], len(w) + 2 * sp.PAD)
        common[w] = len(parts[w]) - bound
        assert common[w] >= 1
        rarest[w] = sorted(parts[w], key=lambda g: (g[2], g[3], g[0]))[: bound + 1]
    places = {(g[3], g[0]) for g in parts[long]}
    met = sum((g[3], g[0]) in places or (g[3], g[0] + step) in places for g in parts[short])
    assert met >= max(common.values())
    lists = {(g[3], g[0]) for g in rarest[long]}
    assert any((g[3], g[0]) in lists or (g[3], g[0] + step) in lists for g in rarest[short])


def test_query_over_the_whole_table(spark):
    d = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()]
    assert result(QUERIES["op11_spelling_variants"](spark, d)) == brute(docs)
