"""Operator 6: suffix-array dedup by distributed prefix doubling.

Of all texts' bytes, those are removed that a string of ``LENGTH`` bytes covers
which also starts earlier (a smaller doc_id, or the same document before).

Prefix doubling ranks positions by strings of growing length, and drops a
position as soon as its rank is unique. A rank only has to be equal for equal
strings, so a rank here is the 64-bit name (Karp-Rabin hash, mixed) of the
string; Spark sorts and groups (rank, position) pairs at each length. Not every
position takes part in the first lengths: a window of LENGTH bytes is stood for
by its anchor, the position of its smallest ``GRAM``-byte rank (leftmost of
equals). Equal windows have equal anchors, so the sparse suffix array of the
anchors, about one position in 32, is enough.

1. Length 32: rank of the gram at each anchor. Unique ranks are out.
2. Rank of all text that the anchor's windows cover. If a smaller document has
   the same (rank 1, rank 2), all windows of the anchor are repeats. If all
   anchors of rank 1 also agree in rank 2, the first is no repeat. Only the
   first of each (rank 1, rank 2) whose rank 1 has several rank 2 goes on.
3. Length 66: its windows that begin up to 33 bytes before the anchor share the
   66 bytes from it on, the others 66 bytes around it. Unique ranks are out.
4. Length 100, past the threshold: rank of each window that is left. A window
   is a repeat if a smaller document has its rank.

Repeats within one document are found in its own task. Bytes under any
repeated window are removed at the end. Ranks of 64 bits make a false repeat
in 10^8 ranked windows a matter of 10^-4.

Hot ranks (a passage in a third of all documents) are counted with map-side
sums and joined by joins that AQE splits; rows carry positions, never texts.
Documents without any repeat in another one are not shuffled (a fixed-size
bit filter, backed by an exact join).

Defined cases: a null text is empty; texts below LENGTH bytes keep everything
but take part in nothing; rows with a null doc_id come before all others, in
the order of their text's hash; a doc_id with several texts is several documents,
in the order of the texts' hashes; rows equal in both are one document and keep
the same; an empty table gives no rows; further columns stay, but for those
named like the results. A task holds about 40 bytes for each byte of its longest text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType, LongType, StringType, StructField, StructType

from starling.llm.common import (
    SLICE_ROWS,
    Stored,
    byte_codes,
    cut,
    give_back,
    id_filter,
    in_filter,
    mix64,
    powers,
    record_batch,
    release,
    row_keys,
    slices,
    texts_as_bytes,
)

LENGTH = 100
GRAM = 32
#: Grams in a window.
SPREAD = LENGTH - GRAM + 1
#: Windows that begin fewer bytes than this before their anchor are its right half.
HALF = (SPREAD + 1) // 2 - 1
#: Bytes of text that are ranked at a time (a longer text is taken whole).
BUFFER_BYTES = 1 << 18
#: Bits of a position within a buffer.
POSITION_BITS = 30


class Ranked:
    """Names of substrings, and anchors, of a few texts laid end to end."""

    def __init__(self, texts: list[bytes]):
        self.raw = np.frombuffer(b"".join(texts), np.uint8)
        size = np.array([len(t) for t in texts], np.int64)
        self.start = np.concatenate([[0], np.cumsum(size)])
        up, self.down = powers(len(self.raw) + 1)
        self.total = np.zeros(len(self.raw) + 1, np.uint64)
        np.cumsum(byte_codes()[self.raw] * up[:-1], out=self.total[1:])
        self.text_of = np.repeat(np.arange(len(texts)), size)

    def names(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Ranks of the strings from ``lo`` to ``hi``."""
        return mix64((self.total[hi] - self.total[lo]) * self.down[lo] + (hi - lo).astype(np.uint64))

    def anchors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(position, its text, rank of its gram, first and last window)."""
        n = len(self.raw)
        if n < LENGTH:
            return (np.empty(0, np.int64),) * 2 + (np.empty(0, np.uint64),) + (np.empty(0, np.int64),) * 2
        grams = mix64((self.total[GRAM:] - self.total[:-GRAM]) * self.down[: n - GRAM + 1] + np.uint64(GRAM))
        bits = np.uint64(POSITION_BITS)
        low, span = (grams >> bits << bits) | np.arange(n - GRAM + 1, dtype=np.uint64), 1
        while 2 * span <= SPREAD:
            low = np.minimum(low[:-span], low[span:])
            span *= 2
        if span < SPREAD:
            low = np.minimum(low[: len(low) - (SPREAD - span)], low[SPREAD - span :])
        window = np.flatnonzero(self.text_of[: n - LENGTH + 1] == self.text_of[LENGTH - 1 :])
        at = (low[window] & np.uint64((1 << POSITION_BITS) - 1)).astype(np.int64)
        new = np.flatnonzero(np.diff(at, prepend=-1))
        at_new = at[new]
        last = window[np.append(new[1:], len(at)) - 1] if len(new) else np.empty(0, np.int64)
        return at_new, self.text_of[at_new], grams[at_new], window[new], last


def buffers(texts: list[bytes]) -> Iterator[tuple[list[int], Ranked]]:
    """The texts of at least LENGTH bytes, a buffer of them at a time."""
    held, size = [], 0
    for i, t in enumerate(texts):
        if len(t) >= LENGTH:
            held.append(i)
            size += len(t)
            if size >= BUFFER_BYTES:
                yield held, Ranked([texts[k] for k in held])
                held, size = [], 0
    if held:
        yield held, Ranked([texts[k] for k in held])


# An anchor as one number: its start in the text, and how far before it its
# first and last window begin (below SPREAD <= 128).
def pack(start: np.ndarray, far: np.ndarray, near: np.ndarray) -> np.ndarray:
    return start << 14 | far << 7 | near


def unpack(packed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return packed >> 14, packed >> 7 & 127, packed & 127


def anchor_ranks(keyed: DataFrame) -> DataFrame:
    """(r1, r2, doc, at) of every anchor, once for each document."""

    def run(batches):
        for b in slices(batches):
            docs = b.column("doc").to_numpy()
            for held, ranked in buffers(texts_as_bytes(b.column("text"))):
                at, text, r1, first, last = ranked.anchors()
                r2 = ranked.names(first, last + LENGTH) ^ mix64((at - first).astype(np.uint64))
                doc = docs[np.array(held)][text]
                packed = pack(at - ranked.start[text], at - first, at - last)
                yield record_batch({"r1": pa.array(r1.view(np.int64)), "r2": pa.array(r2.view(np.int64)),
                                    "doc": pa.array(doc), "at": pa.array(packed)})

    return keyed.mapInArrow(run, "r1 long, r2 long, doc long, at long")


def with_texts(keyed: DataFrame, rows: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """``fn(doc, text, at)`` for each document of ``rows`` (doc, at): its whole
    text meets the array of its ``at``. Other documents' texts are left out of
    the shuffle by a bit filter."""
    lists = rows.groupBy("doc").agg(F.collect_list("at").alias("at"))
    texts = thinned(keyed, filter_of(rows.select(F.col("doc").alias("id")).distinct()))
    # a shuffle even for few lists, so that a task has one Python worker, not one on each side of a broadcast join
    return texts.join(lists.hint("merge"), "doc").select("doc", "text", "at").mapInArrow(fn, schema)


def filter_of(ids: DataFrame) -> Broadcast:
    """The bit filter of ``ids`` on all executors."""
    return ids.sparkSession.sparkContext.broadcast(id_filter(ids, ids.count()))


def thinned(keyed: DataFrame, held: Broadcast) -> DataFrame:
    """The documents that may be in the filter ``held``."""

    def run(batches):
        for b in slices(batches):
            some = in_filter(held.value, b.column("h").to_numpy())
            yield b.filter(pa.array(some)).drop_columns(["h"])

    return keyed.withColumn("h", F.xxhash64("doc")).mapInArrow(run, keyed.schema)


def half_ranks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Length 66: (rank, doc, at) of the halves of each anchor's windows."""
    for b in slices(batches):
        docs = b.column("doc").to_pylist()
        for doc, text, packed in zip(docs, texts_as_bytes(b.column("text")), b.column("at").to_pylist()):
            ranked, (at, far, near) = Ranked([text]), unpack(np.array(packed, np.int64))
            right, left = near < HALF, far >= HALF
            lo = np.concatenate([at[right], at[left] - HALF])
            hi = np.concatenate([at[right] + LENGTH - HALF + 1, at[left] + GRAM])
            half = np.concatenate([pack(at[right], np.minimum(far[right], HALF - 1), near[right]),
                                   pack(at[left], far[left], np.maximum(near[left], HALF))])
            r = ranked.names(lo, hi) ^ np.repeat(np.array([0, 1], np.uint64), [right.sum(), left.sum()])
            yield record_batch({"r": pa.array(r.view(np.int64)), "doc": (([doc] * len(r)), pa.int64()),
                                "at": pa.array(half)})


def window_ranks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Length 100: (rank, doc, start) of each window of the anchors."""
    for b in slices(batches):
        docs = b.column("doc").to_pylist()
        for doc, text, packed in zip(docs, texts_as_bytes(b.column("text")), b.column("at").to_pylist()):
            at, far, near = unpack(np.array(packed, np.int64))
            n = far - near + 1
            begin = np.unique(np.repeat(at - far - np.cumsum(n) + n, n) + np.arange(n.sum()))
            r, first = np.unique(Ranked([text]).names(begin, begin + LENGTH), return_index=True)
            yield record_batch({"r": pa.array(r.view(np.int64)), "doc": (([doc] * len(r)), pa.int64()),
                                "at": pa.array(begin[first])})


def repeats(keyed: DataFrame) -> DataFrame | None:
    """(doc, anchors, windows): packed anchors whose windows, and starts of
    windows that, a smaller document has too. Null arrays are empty."""
    spark = keyed.sparkSession
    ranks = anchor_ranks(keyed)
    shared = ranks.groupBy("r1").agg(F.count("*").alias("n")).where("n > 1").select("r1")
    kept = Stored(ranks.join(shared, "r1"), "anchors")
    release(spark)

    classes = kept.df.groupBy("r1", "r2").agg(F.min("doc").alias("first"))
    several = classes.groupBy("r1").agg(F.count("*").alias("ways"))
    judged = Stored(kept.df.join(classes.join(several, "r1"), ["r1", "r2"]).where("doc > first OR ways > 1")
                    .select("doc", "at", F.expr("doc > first").alias("repeat")), "judged")
    kept.drop()
    release(spark)

    open_ = judged.df.where("NOT repeat").select("doc", "at")
    halves = Stored(with_texts(keyed, open_, half_ranks, "r long, doc long, at long"), "halves")
    shared = halves.df.groupBy("r").agg(F.count("*").alias("n")).where("n > 1").select("r")
    left = Stored(halves.df.join(shared, "r").select("doc", "at"), "left")
    halves.drop()
    release(spark)

    windows = Stored(with_texts(keyed, left.df, window_ranks, "r long, doc long, at long"), "windows")
    left.drop()
    release(spark)
    first = windows.df.groupBy("r").agg(F.min("doc").alias("first"), F.count("*").alias("n")).where("n > 1")
    later = windows.df.join(first, "r").where("doc > first").select("doc", "at", F.lit(True).alias("window"))
    whole = judged.df.where("repeat").select("doc", "at", F.lit(False).alias("window"))
    found = cut(whole.unionAll(later).groupBy("doc").agg(
        F.collect_list(F.expr("IF(window, NULL, at)")).alias("anchors"),
        F.collect_list(F.expr("IF(window, at, NULL)")).alias("windows")))
    judged.drop()
    windows.drop()
    release(spark)
    return found


def removed_bytes(text: bytes, anchors: list[int] | None, windows: list[int] | None) -> np.ndarray | None:
    """Mask of the bytes to remove; None for none."""
    if len(text) < LENGTH:
        return None
    ranked = Ranked([text])
    repeat = np.zeros(len(text) - LENGTH + 2, np.int64)
    if anchors:
        at, far, near = unpack(np.array(anchors, np.int64))
        np.add.at(repeat, at - far, 1)
        np.add.at(repeat, at - near + 1, -1)
    repeat = np.cumsum(repeat)[:-1] > 0
    if windows:
        repeat[np.array(windows, np.int64)] = True
    r1 = ranked.anchors()[2]
    if len(np.unique(r1)) < len(r1):  # the document may repeat itself
        begin = np.arange(len(repeat))
        _, first = np.unique(ranked.names(begin, begin + LENGTH), return_index=True)
        again = np.ones(len(repeat), bool)
        again[first] = False
        repeat |= again
    if not repeat.any():
        return None
    edge = np.zeros(len(text) + 1, np.int64)
    start = np.flatnonzero(repeat)
    np.add.at(edge, start, 1)
    np.add.at(edge, start + LENGTH, -1)
    return np.cumsum(edge)[:-1] > 0


def split_kept(text: bytes, mask: np.ndarray | None) -> tuple[bytes, int, int]:
    """(kept bytes, number removed, number of maximal removed runs)."""
    if mask is None:
        return text, 0, 0
    kept = np.frombuffer(text, np.uint8)[~mask].tobytes()
    return kept, len(text) - len(kept), int((np.diff(mask.astype(np.int8), prepend=0) == 1).sum())


def remove_repeats(docs: DataFrame, as_text: bool = False) -> DataFrame:
    """The rows of ``docs`` (doc_id, text and any others) with kept (binary:
    the remaining bytes; or, ``as_text``, a string without the characters that
    were cut), n_bytes, n_removed and n_spans."""
    results = ("kept", "n_bytes", "n_removed", "n_spans")
    names = [c for c in docs.columns if c not in results]
    others = [F.col(f"`{c}`") for c in names if c != "text"]
    packed = row_keys(docs.select("text", "doc_id", F.struct(*others).alias("row")))
    order = F.coalesce("row_key", F.expr("-9223372036854775808L + (xxhash64(text) & 2305843009213693951L)"))
    found = repeats(packed.select(order.alias("doc"), "text"))
    whole = packed.select(order.alias("doc"), "text", "row")
    held = filter_of(found.select(F.col("doc").alias("id")))
    left = StructType([StructField("kept", StringType() if as_text else BinaryType()),
                       *(StructField(c, LongType()) for c in results[1:])])

    def rows_of(texts: list[bytes], anchors: list, windows: list) -> pa.StructArray:
        rows = []
        for t, a, w in zip(texts, anchors, windows):
            kept, removed, spans = split_kept(t, removed_bytes(t, a, w))
            rows.append((kept.decode("utf-8", "ignore") if as_text else kept, len(t), removed, spans))
        columns = [*zip(*rows)] or [()] * 4
        types = (pa.string() if as_text else pa.binary(), pa.int64(), pa.int64(), pa.int64())
        return pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=list(results))

    # one Python worker a task: what no other document repeats is told apart and cut in one function
    @F.arrow_udf(StructType([StructField("own", BooleanType()), *left.fields]))
    def cut_own(text: pa.Array, h: pa.Array) -> pa.Array:
        parts = []
        for at in range(0, max(len(text), 1), SLICE_ROWS):
            own = ~in_filter(held.value, h.slice(at, SLICE_ROWS).to_numpy())
            some = pa.array(own)
            done = rows_of([t if mine else b"" for t, mine in zip(texts_as_bytes(text.slice(at, SLICE_ROWS)), own)],
                           [None] * len(own), [None] * len(own))
            parts.append(pa.StructArray.from_arrays([some, *done.flatten()], names=["own", *results]))
        give_back()
        return pa.concat_arrays(parts)

    @F.arrow_udf(left)
    def cut_out(text: pa.Array, anchors: pa.Array, windows: pa.Array) -> pa.Array:
        parts = [rows_of(texts_as_bytes(text.slice(at, SLICE_ROWS)), *(c.slice(at, SLICE_ROWS).to_pylist() for c in (anchors, windows)))
                 for at in range(0, max(len(text), 1), SLICE_ROWS)]
        give_back()
        return pa.concat_arrays(parts)

    alone = (whole.select("row", "text", cut_own.asNondeterministic()("text", F.xxhash64("doc")).alias("left")).where("left.own")
             .select("row", "text", F.struct(*(F.col("left").getField(c).alias(c) for c in results)).alias("left")))
    shared = thinned(whole, held).join(found.hint("merge"), "doc", "left").select("row", "text", cut_out("text", "anchors", "windows").alias("left"))
    out = alone.unionAll(shared)
    return out.select(*(F.col("text") if c == "text" else F.col("row").getField(c).alias(c) for c in names),
                      *(F.col("left").getField(c).alias(c) for c in results))


def digest(kept: DataFrame) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
