"""Operator 12: packing documents by power-of-two decomposition.

A document's tokens (its ids and an end id) are split into pieces whose lengths
are the powers of two of the binary form of their number, the largest first:
as many pieces of ``limit`` tokens as fit, then one piece for each bit of the
rest. A piece is a sequence of its own, so no sequence holds tokens of two
documents and none needs padding. Sequences of equal length form a bucket;
their numbers are consecutive, bucket after bucket from the longest, so that a
reader takes whole batches of one length.

One pass encodes and cuts, numbering each task's pieces of a length from 0; its
result is written to the shared folder. Summing those counts over the tasks
gives the first number of each (length, task), which is added to the piece's
own: the pieces themselves are not shuffled, and a task that is lost and run
again writes the same file.

A text is encoded a window of about a million characters at a time, cut at a
single space between two other characters (a longer window only where no such
place comes): the pre-tokenizer never joins the two sides of it, so the ids of
the windows together are those of the whole text. Windows of Latin characters
go through the vocabulary's rank file, which gives the same ids in less time;
others, whose character classes may differ between libraries, through the
vocabulary itself, in stretches between such spaces, of which frequent ones are
looked up rather than encoded again.

Defined cases: a null or empty text is the end id alone, one piece of length 1;
repeated rows and rows without a doc_id are documents by themselves; strings of
special tokens in a text are encoded as the tokenizer does (as one id); an
empty table has no pieces; further columns, whatever their names, are ignored.
"""

from __future__ import annotations

import base64
import functools
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starling.llm.common import Stored, record_batch, slices

#: Longest sequence, in tokens.
LIMIT = 1024
#: Id put behind each document.
END_ID = 0
#: Where a text may be cut: a single space between two characters that no
#: definition of white space contains.
CUT = re.compile(r"(?<=\S)(?= \S)")
WINDOW_CHARS = 1 << 20
#: Stretches remembered by a worker, and the longest of them.
CACHE_ENTRIES, CACHE_CHARS = 400_000, 48


#: What the rank file is not used for.
NOT_LATIN = re.compile("[^\x00-\u024f]")


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def rank_encoding(path: str, special: dict[str, int]):
    """The same vocabulary from its rank file (base64 bytes and rank a line)."""
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)


class StretchEncoder:
    """Ids of texts as little-endian 32-bit bytes."""

    def __init__(self, vocabulary: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(vocabulary)
        self.tok.no_truncation()
        self.tok.no_padding()
        ranks = os.path.splitext(vocabulary)[0] + ".tiktoken"
        special = {t.content: i for i, t in self.tok.get_added_tokens_decoder().items()}
        self.latin = rank_encoding(ranks, special) if os.path.exists(ranks) else None
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _known(self, stretches: list[str]) -> dict[str, bytes]:
        """The ids of the distinct ``stretches``; those not remembered are encoded."""
        found, missing = {}, []
        for s in set(stretches):
            ids = self.young.get(s) or self.old.get(s)
            if ids is None:
                missing.append(s)
            else:
                found[s] = ids
                if len(s) <= CACHE_CHARS:
                    self.young[s] = ids
        for s, e in zip(missing, self.tok.encode_batch_fast(missing, add_special_tokens=False) if missing else ()):
            found[s] = ids = np.array(e.ids, dtype="<u4").tobytes()
            if len(s) <= CACHE_CHARS:
                self.young[s] = ids
        if len(self.young) > CACHE_ENTRIES:
            self.old, self.young = self.young, {}
        return found

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text."""
        by_rank = [self.latin is not None and not NOT_LATIN.search(t) for t in texts]
        cut = [[] if fast or not t else CUT.split(t) for t, fast in zip(texts, by_rank)]
        known = self._known([s for c in cut for s in c])
        return [self.latin.encode_to_numpy(t, allowed_special="all").astype("<u4").tobytes() if fast
                else b"".join([known[s] for s in c]) for t, c, fast in zip(texts, cut, by_rank)]

    def stream(self, text: str) -> Iterator[bytes]:
        """The ids of a text of any length, a window at a time."""
        at = 0
        while at < len(text):
            stop = CUT.search(text, at + WINDOW_CHARS) if len(text) - at > WINDOW_CHARS else None
            end = stop.start() if stop else len(text)
            yield self.encode([text[at:end]])[0]
            at = end


@functools.lru_cache(maxsize=2)
def encoder(vocabulary: str | None = None) -> StretchEncoder:
    return StretchEncoder(vocabulary or default_vocabulary())


def powers_of_two(n: int) -> list[int]:
    """The powers of two that add up to ``n``, the largest first."""
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


def cut_tokens(windows: Iterator[bytes], limit: int, end_id: int) -> list[tuple[int, int, bytes]]:
    """(start, length, ids as bytes) of the pieces of one document."""
    out, start, rest = [], 0, b""
    end = np.array([end_id], dtype="<u4").tobytes()
    for window in (*windows, end):
        rest += window
        whole = len(rest) // (4 * limit)
        for k in range(whole):
            out.append((start, limit, rest[4 * limit * k : 4 * limit * (k + 1)]))
            start += limit
        rest = rest[4 * limit * whole :]
    at = 0
    for n in powers_of_two(len(rest) // 4):
        out.append((start + at, n, rest[4 * at : 4 * (at + n)]))
        at += n
    return out


def pieces(docs: DataFrame, limit: int = LIMIT, end_id: int = END_ID, vocabulary: str | None = None,
           with_ids: bool = False) -> DataFrame:
    """The pieces of each document, with the task that cut them and their
    number among its pieces of that length (``task``, ``nth``)."""
    if limit < 1 or limit & (limit - 1):
        raise ValueError(f"the longest sequence must be a power of two, not {limit}")

    def run(batches):
        enc, task, seen = encoder(vocabulary), TaskContext.get().partitionId(), {}
        for b in slices(batches, 64):
            texts = [t or "" for t in b.column("text").to_pylist()]
            short = [i for i, t in enumerate(texts) if len(t) <= WINDOW_CHARS]
            ids = dict(zip(short, enc.encode([texts[i] for i in short])))
            cols = [[] for _ in range(7)]
            for i, doc in enumerate(b.column("doc_id").to_pylist()):
                cut = cut_tokens([ids.pop(i)] if i in ids else enc.stream(texts[i]), limit, end_id)
                total = cut[-1][0] + cut[-1][1]
                for start, n, data in cut:
                    nth = seen[n] = seen.get(n, -1) + 1
                    row = (doc, start, n, zlib.crc32(data), total, nth, data if with_ids else None)
                    for c, v in zip(cols, row):
                        c.append(v)
            names = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "nth")
            out = {n: (c, pa.int64()) for n, c in zip(names, cols)} | {"task": ([task] * len(cols[0]), pa.int64())}
            if with_ids:
                out["ids"] = (cols[6], pa.binary())
            yield record_batch(out)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text")).mapInArrow(
        run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, nth long, task long"
             + (", ids binary" if with_ids else ""))


def pack(docs: DataFrame, limit: int = LIMIT, end_id: int = END_ID, vocabulary: str | None = None,
         with_ids: bool = False) -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32 (of its ids as little-endian
    unsigned 32-bit numbers), doc_tokens, sequence_id, offset (0: a piece is a
    sequence) and, on demand, the ids as such bytes. Sequence numbers run from
    0 without a gap, longest bucket first."""
    cut = Stored(pieces(docs, limit, end_id, vocabulary, with_ids), "pieces").df
    per_task = cut.groupBy("length", "task").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("task").rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0))
    # at most log2(limit) + 1 rows, one for each length
    lengths = cut.groupBy("length").agg(F.count("*").alias("n_length"))
    first = F.coalesce(F.sum("n_length").over(Window.orderBy(F.desc("length")).rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0))
    base = (per_task.withColumn("before", before)
            .join(lengths.withColumn("first", first).select("length", "first"), "length")
            .select("length", "task", (F.col("before") + F.col("first")).alias("base")))
    return cut.join(base, ["length", "task"]).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("base") + F.col("nth")).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"), *(["ids"] if with_ids else []))


def write_buckets(packed: DataFrame, path: str) -> None:
    """Write packed sequences (``with_ids=True``) as one folder for each
    length; a length's files are cut by size, not by task."""
    packed.hint("rebalance", "length").write.partitionBy("length").parquet(path)
