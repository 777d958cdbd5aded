"""Language ID: held-out accuracy, rejection and defined cases."""

import random

from pyspark.sql import functions as F

from conftest import SF_SMALL
from starling.llm import langid

SYLLABLES = {"xx": ["ka", "to", "mi", "ru", "sen"], "yy": ["sch", "ein", "gen", "ück", "ung"], "zz": ["eau", "que", "ill", "ère", "ou"]}


def prose(rnd, lang, n):
    return " ".join("".join(rnd.choices(SYLLABLES[lang], k=rnd.randint(1, 4))) for _ in range(n))


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    held = langid.fold("doc_id", 4) == 2
    out = langid.identify(docs, langid.train(docs.where(~held)), ["doc_id", "lang", held.alias("held_out")])
    r = out.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("acc"),
                                  F.avg(F.col("rejected").cast("int")).alias("gone")).first()
    assert r["acc"] > 0.95 and r["gone"] < 0.02
    assert out.count() == docs.count()


def test_classes_margins_and_cases(spark):
    rnd = random.Random(1)
    rows = [(i, prose(rnd, lang, 60), lang) for i, lang in enumerate(list(SYLLABLES) * 40)]
    train = spark.createDataFrame([*rows, (999, "stray", None), (998, None, "xx")], "doc_id long, text string, lang string")
    model = langid.train(train)
    assert sorted(model) == sorted(SYLLABLES)
    ask = [(1, prose(rnd, "yy", 40).upper(), None), (2, None, None), (3, "", "a"), (4, "12 !?", "b"), (5, prose(rnd, "zz", 1), None),
           (6, prose(rnd, "zz", 30_000), None), (6, prose(rnd, "xx", 50), None)]
    df = spark.createDataFrame([(*r, 0.5) for r in ask], "doc_id long, text string, lang string, score double")
    got = [(r["doc_id"], r["lang_pred"], r["rejected"]) for r in langid.identify(df, model).collect()]
    assert got[:4] == [(1, "yy", False), (2, "und", True), (3, "und", True), (4, "und", True)]
    assert got[5:] == [(6, "zz", False), (6, "xx", False)] and not got[4][2]
    for r in langid.identify(df, model).collect():
        assert 0.0 <= r["score"] <= 1.0


def test_narrow_margin_is_rejected():
    content = b"the same words for both of the languages " * 50
    same = langid.Classifier({"a": content, "b": content})
    assert same.classify("other words stand here " * 20)[3] is True
    assert same.classify("short")[3] is False


def test_no_labels_and_empty_table(spark):
    df = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert langid.train(df) == {}
    assert langid.identify(df, {}).first()["lang_pred"] == "und"
    assert langid.identify(df.limit(0), {"a": b"x"}).collect() == []


def test_sample_is_bounded_and_takes_the_smallest_hashes(spark):
    rows = [(f"text {i}", "aa" if i % 3 else "bb") for i in range(3000)]
    df = spark.createDataFrame(rows, "text string, lang string")
    got = langid.sample_texts(df, per_language=10).collect()
    want = {}
    for r in df.withColumn("h", F.pmod(F.xxhash64("text"), F.lit(1 << 30))).collect():
        want.setdefault(r["lang"], []).append(r["h"])
    assert {k: 10 for k in want} == {k: sum(r["label"] == k for r in got) for k in want}


def test_copies_train_as_their_texts_do(spark):
    rnd = random.Random(4)
    rows = [(f"{prose(rnd, lang, 30)}\n{prose(rnd, lang, 30)}", lang) for lang in list(SYLLABLES) * 20]
    hot = [(prose(rnd, "xx", 40), "xx")] * 2000
    once = spark.createDataFrame([*rows, hot[0]], "text string, lang string")
    many = spark.createDataFrame([*rows, *rows, *hot], "text string, lang string")
    assert langid.train(many, per_language=15) == langid.train(once, per_language=15)
    model = langid.train(many)
    assert model == langid.train(once) and min(map(len, model.values())) > 5_000
    ask = spark.createDataFrame([(lang, prose(rnd, lang, 60)) for lang in SYLLABLES], "doc_id string, text string")
    for r in langid.identify(ask, model).collect():
        assert r["lang_pred"] == r["doc_id"] and not r["rejected"]


def test_every_label_is_learned(spark):
    rnd = random.Random(5)
    words = {f"l{k:03}": ["".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=8)) for _ in range(20)] for k in range(140)}
    rows = [(" ".join(own * 2), lang) for lang, own in words.items()] + [(" ".join(words["l000"]), "l000")]
    model = langid.train(spark.createDataFrame(rows, "text string, lang string"))
    assert sorted(model) == sorted(words) and next(iter(model)) == "l000" and all(model.values())
    ask = spark.createDataFrame([(lang, " ".join(own[::-1])) for lang, own in words.items()], "doc_id string, text string")
    assert all(r["lang_pred"] == r["doc_id"] for r in langid.identify(ask, model).collect())
