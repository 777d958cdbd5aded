"""Operator 11: spelling variants by a variable-length gram index.

Words are counted over all texts, then indexed by grams of ``QMIN`` to ``QMAX``
characters. The gram dictionary is pruned by frequency: a gram that stands more
than T times in the words is extended by a character, one that does not is kept
as it is. A padded word is decomposed into positional grams: from each place
the shortest gram that is rare (or the longest one), unless an earlier gram
covers it. The dictionary is therefore given by the frequent grams alone; T
grows with the number of grams, so there are never more than ``MAX_FREQUENT``
of a length, and they are sent to all tasks as two arrays of numbers.

One edit changes only grams that it touches, and grams behind it that an
extended gram before them may newly cover: grams that end less than ``QMAX``
places behind it. The most grams that any one edit of
the word can so affect is the word's bound; two near words share at least as
many grams as either has beyond its bound, at the same place or, behind the
edit, one further. So each word's gram lists are merged on its bound + 1 rarest
grams only (its longest lists are skipped): near words meet in one of them. The
padding leaves each word of ``MIN_CHARS`` characters or more one gram at least
beyond its bound, so no word needs a scan (``decompose`` checks it).

A list is keyed by gram, length of the word and place; longer words are looked
up with both places that an inserted character allows. What meets is compared
by the characters it holds (a 64-bit set: one edit changes two of them at most)
and verified by its edit distance. From near words each word takes its form, and
roots are found by pointer doubling: counts double at each step, so the chains
have at most as many steps as a count has bits.

Defined cases: a null or empty text has no words; a null doc_id deletes no
character; repeated rows count each time; ties of n go to the smaller word; an
empty table has no words; words of any length are indexed whole; further
columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starling.llm.common import Stored, pieces, record_batch, slices

#: Shortest word, least occurrences, and how often a character is deleted.
MIN_CHARS, MIN_COUNT, DELETE_MODULUS = 5, 3, 97
#: Lengths of grams, characters of padding at either end, smallest T, and most
#: frequent grams of one length.
QMIN, QMAX, PAD, MIN_FREQUENCY, MAX_FREQUENT = 2, 5, 3, 32, 1 << 18
#: Distinct words that a task counts before it passes them on.
COUNTED = 200_000
BEGIN, END = "\x01", "\x02"  # padding; no word holds them

if MIN_CHARS + 2 * PAD < 2 * QMAX:
    raise ValueError("the padding must leave every word a gram that no one edit affects")


# ------------------------------------------------------------ words
def count_words(docs: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT,
                modulus: int = DELETE_MODULUS) -> DataFrame:
    """word and n: the words of all texts, from each some characters deleted as
    the crc32 of ``<doc_id>:<word>`` chooses, of the given length and count."""
    run_of = re.compile(f"[a-zÀ-ÿ]{{{min_chars},}}")  # whole runs: shorter ones cannot become words

    def run(batches):
        total: Counter = Counter()

        def out():
            rows = record_batch({"word": ([*total], pa.string()), "n": ([*total.values()], pa.int64())})
            total.clear()
            return rows

        for b in slices(batches):
            for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text").cast(pa.binary()).to_pylist()):
                if not text:
                    continue
                start = None if doc is None else zlib.crc32(f"{doc}:".encode())
                for piece in pieces(text):
                    # bytes.lower changes A-Z only
                    for word, n in Counter(run_of.findall(piece.lower().decode("utf-8"))).items():
                        if start is not None:
                            h = zlib.crc32(word.encode("utf-8"), start)
                            if h % modulus == 0:
                                at = h % len(word)
                                word = word[:at] + word[at + 1 :]
                                if len(word) < min_chars:
                                    continue
                        total[word] += n
                if len(total) > COUNTED:
                    yield out()
        yield out()

    counted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


# ------------------------------------------------------------ gram dictionary
def codes(word: str) -> np.ndarray:
    """The padded word as characters of 8 bits."""
    return np.frombuffer((BEGIN * PAD + word + END * PAD).encode("latin-1"), dtype=np.uint8).astype(np.uint64)


def gram_codes(chars: np.ndarray, q: int) -> np.ndarray:
    """The grams of ``q`` characters as numbers; no two grams have the same."""
    n = len(chars) - q + 1
    out = np.zeros(max(n, 0), dtype=np.uint64)
    for k in range(q):
        out = (out << np.uint64(8)) | chars[k : n + k]
    return out


class Dictionary:
    """The frequent grams, sorted, with their counts."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray):
        order = np.argsort(grams)
        self.grams, self.counts = grams[order], counts[order]

    def count(self, grams: np.ndarray) -> np.ndarray:
        """How often the grams stand in the words; 0 for those that are rare."""
        if not len(self.grams):
            return np.zeros(len(grams), dtype=np.int64)
        at = np.minimum(np.searchsorted(self.grams, grams), len(self.grams) - 1)
        return np.where(self.grams[at] == grams, self.counts[at], 0)

    def decompose(self, word: str) -> list[tuple[int, int, int, int]]:
        """(start, end, count, gram) of the word's grams, none inside another."""
        chars = codes(word)
        n = len(chars)
        size = np.full(n - QMIN + 1, QMIN)
        open_, found = np.ones(len(size), dtype=bool), {q: gram_codes(chars, q) for q in range(QMIN, QMAX + 1)}
        counts = {q: self.count(g) for q, g in found.items()}
        for q in range(QMIN, QMAX):
            longer = n - q  # places where a gram of q + 1 characters begins
            open_[longer:] = False
            open_[:longer] &= counts[q][:longer] > 0
            size[open_] = q + 1
        out, covered = [], 0
        for p, q in enumerate(size.tolist()):
            if p + q > covered:
                covered = p + q
                out.append((p, covered, int(counts[q][p]), int(found[q][p])))
        return out


def affected(grams: list[tuple[int, int, int, int]], n: int) -> int:
    """The most grams of a padded word of ``n`` characters that one edit inside
    the padding can change: those that hold the place, and those behind it that
    a gram from before it may cover after the edit."""
    end = np.array([g[1] for g in grams])  # ascending, as no gram lies in another
    upto = lambda x: np.searchsorted(end, x, side="right")
    # a gram with the place p in it, or behind it and within the reach of one
    # that begins at p or before, is a gram that ends in p + 1 .. p + QMAX
    at = np.arange(PAD, n - PAD)
    replaced = upto(at + QMAX) - upto(at)  # or deleted
    inserted = upto(at + QMAX) - upto(at + 1)  # behind the place
    first = upto(PAD + QMAX - 1) - upto(PAD)  # before the first
    return int(max(replaced.max(), inserted.max(), first))


def frequent_grams(spark: SparkSession, words: DataFrame) -> Dictionary:
    """The grams that stand more than T times in the padded words. T is so
    large that at most MAX_FREQUENT grams of each length do."""

    def run(batches):
        total: Counter = Counter()

        def out():
            grams = np.fromiter(total, dtype=np.uint64, count=len(total)).astype(np.int64)
            rows = record_batch({"gram": (grams, pa.int64()), "n": ([*total.values()], pa.int64())})
            total.clear()
            return rows

        for b in slices(batches, 2048):
            per_word = [codes(w) for w in b.column("word").to_pylist()]
            for q in range(QMIN, QMAX + 1):
                if per_word:
                    grams, n = np.unique(np.concatenate([gram_codes(c, q) for c in per_word]), return_counts=True)
                    for g, k in zip(grams.tolist(), n.tolist()):
                        total[g] += k
            if len(total) > COUNTED:
                yield out()
        yield out()

    places = words.agg(F.sum(F.length("word") + 2 * PAD)).first()[0] or 0
    least = max(MIN_FREQUENCY, -(-places // MAX_FREQUENT))
    got = (words.select("word").mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
           .where(F.col("n") > least).toArrow())
    return Dictionary(got["gram"].to_numpy().astype(np.uint64), got["n"].to_numpy())


# ------------------------------------------------------------ near words
def character_set(word: Column) -> Column:
    """A 64-bit set of the word's characters (each at its code modulo 64)."""
    bit = lambda c: F.call_function("shiftleft", F.lit(1).cast("long"), (F.ascii(c) % 64).cast("int"))
    return F.aggregate(F.split(word, ""), F.lit(0).cast("long"),
                       lambda a, c: F.when(c == "", a).otherwise(a.bitwiseOR(bit(c))))


def postings(words: DataFrame, dictionary: Dictionary) -> DataFrame:
    """Each word's bound + 1 rarest grams: word, n, chars, length, gram, at."""
    shared = words.sparkSession.sparkContext.broadcast(dictionary)

    def run(batches):
        d = shared.value
        for b in slices(batches, 1024):
            rows, take = [], []
            for k, w in enumerate(b.column("word").to_pylist()):
                grams = d.decompose(w)
                bound = affected(grams, len(w) + 2 * PAD)
                if bound >= len(grams):
                    raise AssertionError(f"no gram of {w!r} survives every edit")
                for p, _, _, g in sorted(grams, key=lambda g: (g[2], g[3], g[0]))[: bound + 1]:
                    rows.append((len(w), g, p))
                    take.append(k)
            length, gram, at = zip(*rows) if rows else ((), (), ())
            chosen = pa.array(take, pa.int32())
            yield record_batch({c: b.column(c).take(chosen) for c in ("word", "n", "chars")} | {
                "length": (length, pa.int32()), "gram": (gram, pa.int64()), "at": (at, pa.int32())})

    return words.select("word", "n", character_set(F.col("word")).alias("chars")).mapInArrow(
        run, "word string, n long, chars long, length int, gram long, at int")


def near_words(words: DataFrame) -> DataFrame:
    """a, n_a, b, n_b: the pairs of words (word, n) at an edit distance of one,
    each pair once."""
    listed = Stored(postings(words, frequent_grams(words.sparkSession, words)), "grams").df
    probe = lambda longer, shift: F.struct(
        (F.col("length") + longer).alias("length"), (F.col("at") + shift).alias("at"))
    asks = listed.select(F.col("word").alias("a"), F.col("n").alias("n_a"), F.col("chars").alias("chars_a"), "gram",
                         F.explode(F.array(probe(0, 0), probe(1, 0), probe(1, 1))).alias("to"))
    asks = asks.select("a", "n_a", "chars_a", "gram", "to.length", "to.at")
    lists = listed.select(F.col("word").alias("b"), F.col("n").alias("n_b"), F.col("chars").alias("chars_b"), "gram",
                          "length", "at")
    met = asks.join(lists, ["gram", "length", "at"]).where(
        (F.bit_count(F.col("chars_a").bitwiseXOR(F.col("chars_b"))) <= 2)
        & ((F.length("a") < F.length("b")) | (F.col("a") < F.col("b"))))
    return met.where(F.levenshtein("a", "b", 1) == 1).select("a", "n_a", "b", "n_b").distinct()


# ------------------------------------------------------------ forms and roots
def roots(forms: DataFrame) -> DataFrame:
    """word and root of the rows (word, form): forms followed to the last, by
    doubling the step until nothing moves."""
    now = Stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = now.df.select(F.col("word").alias("at"), F.col("root").alias("next"))
        moved = now.df.join(further, F.col("root") == F.col("at"), "left")
        after = Stored(moved.select("word", F.coalesce("next", "root").alias("root"),
                                    F.col("next").isNotNull().alias("moved")), "roots")
        now.drop()
        now = after
        if not now.df.where("moved").limit(1).count():
            return now.df.select("word", "root")


def spelling_variants(docs: DataFrame) -> DataFrame:
    """Per word: word, n, n_near, form, form_n, root."""
    words = Stored(count_words(docs), "words").df
    pairs = near_words(words)
    both = F.explode(F.array(
        F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("near_n")),
        F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("n_a").alias("near_n"))))
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near"))
    per_word = pairs.select(both.alias("p")).select("p.*").groupBy("word").agg(
        F.count("*").alias("n_near"), best.alias("best"))
    doubled = -F.col("best.less") >= 2 * F.col("n")
    found = Stored(words.join(per_word, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(doubled, F.col("best.near")).alias("form"), F.when(doubled, -F.col("best.less")).alias("form_n")), "forms").df
    last = roots(found.where("form IS NOT NULL"))
    return found.join(last, "word", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
