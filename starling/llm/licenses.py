"""Operator 2: license scans with a positional rare-token index.

Templates are word sequences with a label and mandatory key phrases. Document
frequencies of the licence vocabulary are counted over all documents; the
index posts, for every template, its ``POSTED`` words of highest IDF with their
positions. Every posted word that a file holds is looked up, however many
licences it bundles; each (template, file position - template position) that at
least ``MIN_VOTES`` of them agree on is an alignment. An alignment is a finding if enough of the
template's words stand at their relative positions and every mandatory phrase
stands within the aligned window.

Base phrases are posted under their rarest word. Each of that word's places is
looked up and verified, so every place of a phrase is found.

Defined cases: a null or empty text has 0 words, 0 places, null first and last
word, empty label strings and score 0; repeated rows are scanned each; further
columns are ignored; a long text is read in pieces, so memory holds its licence
words only. With an empty table the IDF of all words is equal and ties go to
the alphabetically first word.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starling.llm.common import pieces, record_batch, slices, texts_as_bytes

# The base phrases and their labels.
BASE_PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

# Opening sentences and notices of well-known licences, as
# (label, text, mandatory phrases).
TEMPLATES = [
    ("agpl", "licensed under the GNU Affero General Public License, version 3", ["affero general public license"]),
    ("apache", "Licensed under the Apache License, Version 2.0", ["apache license"]),
    ("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
               "compliance with the License. You may obtain a copy of the License at", ["apache license"]),
    ("artistic", "licensed under the Artistic License 2.0", ["artistic license"]),
    ("boost", "Distributed under the Boost Software License, Version 1.0", ["boost software license"]),
    ("bsd", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file",
     ["bsd style license"]),
    ("bsd", "licensed under the BSD 3-Clause License", ["bsd", "clause license"]),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met", ["redistribution and use in source and binary forms"]),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License",
     ["creative commons attribution"]),
    ("cc-by", "Licensed under CC BY 4.0", ["cc by"]),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0", ["cc by nc"]),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0", ["cc by sa"]),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights "
            "to this work", ["waived all copyright"]),
    ("epl", "This program is made available under the terms of the Eclipse Public License", ["eclipse public license"]),
    ("gpl", "This work is licensed under the GNU General Public License, version 3", ["gnu general public license"]),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
            "General Public License as published by the Free Software Foundation", ["gnu general public license"]),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted", ["with or without fee is hereby granted"]),
    ("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
     ["lesser general public license"]),
    ("mit", "Released under the MIT License", ["mit license"]),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files", ["permission is hereby granted free of charge"]),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
     ["mozilla public license"]),
    ("public-domain", "This is free and unencumbered software released into the public domain", ["public domain"]),
]

#: Words that the index posts for each template.
POSTED = 6
#: Posted words that must agree on an alignment.
MIN_VOTES = 2
#: Share of a template's words that must stand at their relative positions.
MIN_COVERAGE = 0.6
#: Words by which a mandatory phrase may be off the alignment.
SLACK = 3

_TO_SPACE = bytes(b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))


def split_words(data: bytes) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z."""
    return data.lower().translate(_TO_SPACE).split()


def text_words(data: bytes) -> Iterator[list[bytes]]:
    """The words of a text, a list for each piece."""
    for p in pieces(data):
        yield split_words(p)


class Template:
    def __init__(self, label: str, text: str, phrases: list[str]):
        self.label, self.words = label, split_words(text.encode())
        self.phrases = [split_words(p.encode()) for p in phrases]
        self.phrase_at = [self._find(p) for p in self.phrases]

    def _find(self, phrase: list[bytes]) -> int:
        return next(i for i in range(len(self.words)) if self.words[i : i + len(phrase)] == phrase)


class LicenseIndex:
    """Postings of the templates' and base phrases' rarest words."""

    def __init__(self, df: dict[bytes, int], n_docs: int, templates=None, base=None):
        self.templates = [Template(*t) for t in (TEMPLATES if templates is None else templates)]
        base = BASE_PHRASES if base is None else base
        self.base = [(split_words(p.encode()), label) for p, label in base.items()]
        self.vocabulary = frozenset(w for t in self.templates for w in t.words) | {w for p, _ in self.base for w in p}
        self.idf = {w: math.log((n_docs + 1) / (df.get(w, 0) + 1)) for w in self.vocabulary}
        rare = lambda w: (-self.idf[w], w)
        self.postings: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        for k, t in enumerate(self.templates):
            posted = set(sorted(set(t.words), key=rare)[:POSTED])
            for i, w in enumerate(t.words):
                if w in posted:
                    self.postings[w].append((k, i))
        self.anchors: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        for k, (phrase, _) in enumerate(self.base):
            w = min(phrase, key=rare)
            self.anchors[w].append((k, phrase.index(w)))
        self.keys = frozenset(self.postings) | frozenset(self.anchors)

    def hits(self, data: bytes) -> tuple[int, dict[int, bytes]]:
        """Number of words, and the licence words by position (empty if the
        text holds no posted word)."""
        n, any_key = 0, False
        for words in text_words(data):
            n += len(words)
            any_key = any_key or not self.keys.isdisjoint(words)
        found: dict[int, bytes] = {}
        if any_key:
            at = 0
            for words in text_words(data):
                found.update((at + i, w) for i, w in enumerate(words) if w in self.vocabulary)
                at += len(words)
        return n, found

    def base_places(self, found: dict[int, bytes], places: dict[bytes, list[int]]) -> list[tuple[int, str]]:
        """(start, label) of every place of a base phrase."""
        out = []
        for w, posts in self.anchors.items():
            for at in places.get(w, ()):
                for k, i in posts:
                    phrase, label = self.base[k]
                    if all(found.get(at - i + j) == x for j, x in enumerate(phrase)):
                        out.append((at - i, label))
        return out

    def alignments(self, places: dict[bytes, list[int]]) -> Counter:
        """Votes of the file's posted words for (template, start)."""
        votes: Counter = Counter()
        for w, posts in self.postings.items():
            for at in places.get(w, ()):
                for k, i in posts:
                    votes[k, at - i] += 1
        return votes

    def verify(self, k: int, start: int, found: dict[int, bytes]) -> float:
        """Share of template ``k``'s words that stand at their places, or 0 if
        it is too small or a mandatory phrase is missing."""
        t = self.templates[k]
        share = sum(found.get(start + i) == w for i, w in enumerate(t.words)) / len(t.words)
        if share < MIN_COVERAGE:
            return 0.0
        for phrase, at in zip(t.phrases, t.phrase_at):
            if not any(all(found.get(start + at + s + j) == w for j, w in enumerate(phrase))
                       for s in range(-SLACK, SLACK + 1)):
                return 0.0
        return share

    def scan(self, data: bytes) -> tuple[int, int, int | None, int | None, str, str, float]:
        """(n_words, n_base, first_word, last_word, base_labels, labels, score)."""
        n, found = self.hits(data)
        if not found:
            return n, 0, None, None, "", "", 0.0
        places: dict[bytes, list[int]] = defaultdict(list)
        for at, w in found.items():
            places[w].append(at)
        base = self.base_places(found, places)
        score, labels = (1.0 if base else 0.0), {label for _, label in base}
        for (k, start), votes in self.alignments(places).items():
            if votes >= min(MIN_VOTES, len(set(self.templates[k].words))) and (share := self.verify(k, start, found)):
                labels.add(self.templates[k].label)
                score = max(score, share)
        starts = [at for at, _ in base]
        return (n, len(base), min(starts, default=None), max(starts, default=None),
                ",".join(sorted({label for _, label in base})), ",".join(sorted(labels)), score)


def document_frequencies(docs: DataFrame, vocabulary: frozenset[bytes]) -> tuple[dict[bytes, int], int]:
    """Document frequency of each licence word over all documents, and the
    number of documents. At most one row per vocabulary word reaches the
    driver; tasks pre-aggregate their rows."""

    def count(batches):
        df, n = Counter(), 0
        for b in slices(batches):
            for data in texts_as_bytes(b.column("text")):
                n += 1
                df.update(set().union(*(vocabulary.intersection(words) for words in text_words(data))))
        rows = [*df.items(), (None, n)]
        yield record_batch({"word": ([w for w, _ in rows], pa.binary()), "n": ([c for _, c in rows], pa.int64())})

    total = (docs.select("text").mapInArrow(count, "word binary, n long")
             .groupBy("word").agg(F.sum("n").alias("n")).collect())
    got = {None if r["word"] is None else bytes(r["word"]): r["n"] for r in total}
    n_docs = got.pop(None, 0)
    return got, n_docs


def build_index(docs: DataFrame, templates=None, base=None) -> LicenseIndex:
    """The index with IDF over all of ``docs``."""
    empty = LicenseIndex({}, 0, templates, base)
    return LicenseIndex(*document_frequencies(docs, empty.vocabulary), templates, base)


def scan_licenses(docs: DataFrame, index: LicenseIndex | None = None) -> DataFrame:
    """Per document: doc_id, n_words, n_base, first_word, last_word,
    base_labels, labels, score. Two passes over the texts, no shuffle of texts."""
    index = index or build_index(docs)
    held = docs.sparkSession.sparkContext.broadcast(index)  # a few KB: the templates' postings

    def run(batches):
        scan = held.value.scan
        for b in slices(batches):
            rows = [scan(data) for data in texts_as_bytes(b.column("text"))]
            n, nb, first, last, bl, la, sc = zip(*rows) if rows else ((),) * 7
            yield record_batch({
                "doc_id": b.column("doc_id"), "n_words": (n, pa.int64()), "n_base": (nb, pa.int64()),
                "first_word": (first, pa.int64()), "last_word": (last, pa.int64()),
                "base_labels": (bl, pa.string()), "labels": (la, pa.string()), "score": (sc, pa.float64())})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n_words long, n_base long, first_word long, last_word long, "
             "base_labels string, labels string, score double")
