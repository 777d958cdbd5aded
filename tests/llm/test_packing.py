"""Packing against the tokenizers library and the rules of the contract."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from starling.llm import packing
from starling.llm.queries import QUERIES

TOK = Tokenizer.from_file(packing.default_vocabulary())
BITS = ["the", " ", "  ", "\n", " \n", "don't", "'s", "<|endoftext|>", "é", "́", " x1", "\t ", "\x1c", "\x85", "　",
        "日本", ".", " ..", "12", " 12", "​", "🙂"]


def ids_of(text):
    return TOK.encode(text or "", add_special_tokens=False).ids + [0]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(BITS), max_size=60).map("".join))
def test_stretches_give_the_ids_of_the_whole_text(text):
    enc = packing.encoder()
    want = ids_of(text)[:-1]
    assert np.frombuffer(enc.encode([text])[0], "<u4").tolist() == want
    latin = packing.NOT_LATIN.sub("", text)
    assert enc.latin and np.frombuffer(enc.encode([latin])[0], "<u4").tolist() == ids_of(latin)[:-1]
    by_stretch = packing.StretchEncoder.__new__(packing.StretchEncoder)
    by_stretch.__dict__ = enc.__dict__ | {"latin": None}
    assert np.frombuffer(by_stretch.encode([text])[0], "<u4").tolist() == want


def test_every_latin_character_by_rank_as_by_vocabulary():
    enc = packing.encoder()
    for c in map(chr, range(0x250)):
        for text in (c, f"a{c}b", f"1{c}2", f" {c} x", f"{c}{c}'s {c}.", f"\n{c} \t{c}", f"word {c}word", f"{c}<|endoftext|>{c}"):
            assert np.frombuffer(enc.encode([text])[0], "<u4").tolist() == ids_of(text)[:-1], repr(text)


def test_windows_give_the_ids_of_the_whole_text(monkeypatch):
    monkeypatch.setattr(packing, "WINDOW_CHARS", 50)
    rnd = random.Random(3)
    text = "".join(rnd.choice(BITS) for _ in range(4000))
    got = b"".join(packing.encoder().stream(text))
    assert np.frombuffer(got, "<u4").tolist() == ids_of(text)[:-1]


def test_powers_of_two():
    for n in range(1, 3000):
        p = packing.powers_of_two(n)
        assert sum(p) == n and len(p) == n.bit_count() and p == sorted(set(p), reverse=True)


def check(rows, texts):
    """``rows`` against the (doc_id, text) pairs, repeated ones too."""
    want = defaultdict(list)
    for doc, text in texts:
        ids = ids_of(text)
        lengths = [1024] * (len(ids) // 1024) + packing.powers_of_two(len(ids) % 1024)
        at = 0
        for n in lengths:
            part = ids[at : at + n]
            want[(doc, at, n, zlib.crc32(np.array(part, "<u4").tobytes()), len(ids))].append(1)
            at += n
    got = defaultdict(list)
    for r in rows:
        got[(r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"])].append(1)
    assert got == want
    assert sorted(r["sequence_id"] for r in rows) == list(range(len(rows)))
    assert all(r["offset"] == 0 and r["length"].bit_count() == 1 for r in rows)
    by_number = [r["length"] for r in sorted(rows, key=lambda r: r["sequence_id"])]
    assert by_number == sorted(by_number, reverse=True)  # buckets lie one behind the other


def test_cases(spark):
    long = " ".join(f"w{i % 977} and" for i in range(9000))
    texts = [(1, None), (2, ""), (3, "one two"), (3, "one two"), (3, "other"), (None, "no id"), (None, "no id"), (4, long),
             (5, "<|endoftext|> x<|endoftext|>"), (6, "日本" * 700)]
    df = spark.createDataFrame([(d, t, 7, "x") for d, t in texts], "doc_id long, text string, start long, `a.b` string")
    check(packing.pack(df.repartition(3)).collect(), texts)
    assert packing.pack(df.limit(0)).collect() == []


def test_ids_and_buckets(spark, tmp_root):
    texts = [(i, " ".join(["token"] * (i * 37))) for i in range(40)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    packed = packing.pack(df, limit=64, with_ids=True)
    whole = defaultdict(dict)
    for r in packed.collect():
        assert r["length"] <= 64 and len(r["ids"]) == 4 * r["length"]
        whole[r["doc_id"]][r["start"]] = bytes(r["ids"])
    for doc, text in texts:
        data = b"".join(v for _, v in sorted(whole[doc].items()))
        assert np.frombuffer(data, "<u4").tolist() == ids_of(text)
    packing.write_buckets(packed, tmp_root)
    back = spark.read.parquet(tmp_root)
    assert back.where("octet_length(ids) = 4 * length").count() == packed.count()
    with pytest.raises(ValueError):
        packing.pack(df, limit=100)


def test_query_over_the_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    check(QUERIES["op12_packing"](spark, "/root/testdata/sf0.001").collect(),
          [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])
