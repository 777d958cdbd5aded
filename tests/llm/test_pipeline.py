"""The pipeline on a planted corpus: what goes, what stays, and the digests."""

import hashlib
import random

import corpus_pipeline
from starling.llm import bpe
from starling.session import shared_path


def prose(rnd, n):
    return " ".join("".join(rnd.choice(["th", "an", "er", "in", "ou", "st"]) for _ in range(rnd.randint(1, 4))) for _ in range(n))


def corpus():
    rnd = random.Random(8)
    rows = [(i, prose(rnd, 120), "en", f"s{i % 3}") for i in range(40)]
    rows += [(100 + i, t.upper() if i % 2 else t, "en", "s0") for i, (_, t, _, _) in enumerate(rows[:10])]  # copies
    rows += [(200 + i, " ".join([*t.split()[:-2], "changed", "end"]), None, "s1") for i, (_, t, _, _) in enumerate(rows[10:15])]
    passage = prose(rnd, 60)
    rows += [(300 + i, f"{prose(rnd, 150)} {passage} {prose(rnd, 150)}", "en", "s2") for i in range(6)]
    rows += [(400, None, "en", "s0"), (401, "", "en", "s0"), (402, "12 34 !!", "en", "s0"), (39, rows[39][1], "en", "s0")]
    return rows, passage


def test_planted_corpus(spark):
    rows, passage = corpus()
    root = shared_path(spark, "tests", unique=True)
    extra = "kept string, draw int, others double, rep long, row string, `score a-b` string"  # names of the operators
    spark.createDataFrame([(i, t, lang, s, len(t or ""), "k", 1, None, 2, "r", "x") for i, t, lang, s in rows],
                          f"doc_id long, text string, lang string, source string, n_chars long, {extra}").write.parquet(
        f"{root}/documents.parquet")
    docs, seen = spark.read.parquet(f"{root}/documents.parquet"), {}
    names = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, root)
        if name != "bpe_round_trip":
            assert out.columns == names
        out.write.parquet(f"{root}/{k}")
        docs = spark.read.parquet(f"{root}/{k}")
        seen[name] = docs.collect()
    ids = lambda name: sorted(r["doc_id"] for r in seen[name])
    clean = [*range(40), *range(300, 306)]
    assert ids("language_id") == sorted(i for i, *_ in rows if i not in (400, 401, 402))
    assert ids("minhash_near_dedup") == clean
    texts = {r["doc_id"]: r["text"] for r in seen["suffix_array_dedup"]}
    assert sorted(texts) == clean and sum(passage in t for t in texts.values()) == 1
    full = {i: t for i, t, *_ in rows}
    assert all(texts[i] == full[i] for i in range(40))
    drawn = ids("source_mixing")
    assert sorted(set(drawn)) == clean and max(map(drawn.count, clean)) <= 2
    tok = bpe.tokenizer()
    for r in seen["bpe_round_trip"]:
        ids_ = [i for w in tok.encode(texts[r["doc_id"]]) for i in w]
        assert r["n_tokens"] == len(ids_)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids_)).encode()).hexdigest()
    again = corpus_pipeline.run(spark, root)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, seen["bpe_round_trip"]))


def test_empty_table(spark):
    root = shared_path(spark, "tests", unique=True)
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        f"{root}/documents.parquet")
    assert corpus_pipeline.run(spark, root).collect() == []
