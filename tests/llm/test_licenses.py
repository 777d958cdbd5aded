"""License scans: base places by brute force, method labels on planted notices."""

import random
import re

from starling.llm import licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def brute(text):
    w, places = WORD.findall(lower(text)), []
    for phrase, label in licenses.BASE_PHRASES.items():
        p = phrase.split()
        places += [(i, label) for i in range(len(w)) if w[i : i + len(p)] == p]
    starts = [i for i, _ in places]
    return (len(w), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places})))


def test_base_places_equal_brute_force(spark):
    rnd = random.Random(1)
    bits = ["CC", "by", "general", "Public", "license", "all", "rights", "reserved", "the", "ü", "x1", "cc-by", "of"]
    seps = [" ", "-", "\n", ". ", "  "]
    texts = [None, "", " \n", "ALL RIGHTS RESERVED", "cc by " * 500]
    texts += ["".join(rnd.choice(bits) + rnd.choice(seps) for _ in range(rnd.randint(1, 200))) for _ in range(200)]
    texts.append("word " * 300_000 + "general public license")  # several pieces
    df = spark.createDataFrame([(i, t, 5) for i, t in enumerate(texts)], "doc_id long, text string, n_words int")
    rows = licenses.scan_licenses(df).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert tuple(r)[1:6] == brute(texts[r["doc_id"]]), r["doc_id"]
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
        assert 0.0 <= r["score"] <= 1.0 and (r["score"] > 0) == (r["labels"] != "")


def test_method_labels(spark):
    filler = "some words of a text that no licence has written here and there "
    cases = [(f"{filler * 3}{text}. {filler}", label) for label, text, _ in licenses.TEMPLATES]
    cases += [("This file is licensed under the Apache License, Version 2.0 of it", "apache"), (filler, ""),
              ("the license of mit students: a version of public use", ""), ("apache helicopters and a driver license", "")]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "doc_id long, text string")
    for r in licenses.scan_licenses(df).collect():
        want = cases[r["doc_id"]][1]
        assert want in r["labels"].split(",") if want else r["labels"] == "", cases[r["doc_id"]]


def test_idf_covers_all_documents_and_empty_table(spark):
    df = spark.createDataFrame([(i, "apache here" if i % 4 == 0 else None) for i in range(40)], "doc_id long, text string")
    df_counts, n = licenses.document_frequencies(df, licenses.LicenseIndex({}, 0).vocabulary)
    assert (df_counts[b"apache"], n) == (10, 40)
    assert licenses.scan_licenses(df.limit(0)).collect() == []


def test_bundle_and_notice_behind_long_text():
    every = licenses.LicenseIndex({}, 0).vocabulary
    rnd = random.Random(2)
    for df in ({}, {w: rnd.randint(0, 900) for w in sorted(every)}):
        index = licenses.LicenseIndex(df, 1000)
        bundle = "\n\n".join(text for _, text, _ in licenses.TEMPLATES)
        assert set(index.scan(bundle.encode())[5].split(",")) == {label for label, _, _ in licenses.TEMPLATES}
        long = " x ".join(w.decode() for w in sorted(every) * 40)
        assert index.scan(long.encode())[5] == ""
        for label, text, _ in licenses.TEMPLATES:
            assert label in index.scan(f"{long} x {text}".encode())[5].split(","), text
