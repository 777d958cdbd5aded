"""Helpers that several operators share: lineage cuts, batches, word hashes."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starling.session import delete_path, shared_path, shared_root

#: Rows of an Arrow batch that a task turns into Python objects at a time.
SLICE_ROWS = 256
#: Bytes of a text that are hashed at a time (cut at white space).
PIECE_BYTES = 1 << 20

MASK64 = (1 << 64) - 1
POLY = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
WHITE = bytes([32, 9, 10, 11, 12, 13])  # what bytes.split() splits at


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder; later plans start there."""
    spark = df.sparkSession
    root = shared_root(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return df.checkpoint(eager=True)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner delete the shuffle files of frames no longer held."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def row_keys(docs: DataFrame) -> DataFrame:
    """``docs`` with ``row_key``: a long in the order of doc_id that rows share
    only if both doc_id and text are equal; null without a doc_id. It is the
    doc_id itself unless some doc_id has several texts. Then the distinct
    (doc_id, hash of the text) pairs are sorted over all tasks and numbered, each
    task from the number of pairs before its own."""
    doc = F.col("doc_id").cast("long")
    digest = F.xxhash64(F.coalesce("text", F.lit("")))
    pairs = docs.where("doc_id IS NOT NULL").select(doc.alias("doc_id"), digest.alias("h")).distinct()
    if pairs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").isEmpty():
        return docs.withColumn("row_key", doc)

    def number(batches):
        task, n = TaskContext.get().partitionId(), 0
        for b in batches:
            yield record_batch({"of_doc": b.column("doc_id"), "h": b.column("h"), "task": ([task] * b.num_rows, pa.int64()),
                                "nth": (range(n, n + b.num_rows), pa.int64())})
            n += b.num_rows

    numbered = Stored(pairs.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h").mapInArrow(
        number, "of_doc long, h long, task long, nth long"), "row_keys").df
    before = F.coalesce(F.sum("n").over(Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    tasks = numbered.groupBy("task").agg(F.count("*").alias("n")).select("task", before.alias("before"))  # a row a task
    keys = numbered.join(tasks, "task").select("of_doc", F.col("h").alias("of_text"), (F.col("before") + F.col("nth")).alias("row_key"))
    return docs.join(keys, (doc == F.col("of_doc")) & (digest == F.col("of_text")), "left").drop("of_doc", "of_text")


@functools.lru_cache(maxsize=1)
def _trim():
    """The C library's malloc_trim, where it has one."""
    with contextlib.suppress(OSError, AttributeError, TypeError):
        return ctypes.CDLL(None).malloc_trim
    return lambda keep: 0


#: What this worker holds for the tasks of one stage: a function that lets go of it, and the stage.
_held: dict[Callable[[], None], int | None] = {}


def _stage() -> int | None:
    """The stage of this worker's task; none on the driver."""
    context = TaskContext.get()
    return None if context is None else context.stageId()


def hold_for_stage(let_go: Callable[[], None]) -> None:
    """Have ``let_go`` called as soon as this worker works for another stage
    than now. What takes long to make (a tokenizer, its cache) is shared by the
    tasks of a stage, but does not lie beside what later stages need."""
    _held[let_go] = _stage()


def let_go_of_other_stages() -> None:
    """Let go of what this worker holds for another stage than its task's."""
    now = _stage()
    for let_go in (others := [f for f, stage in _held.items() if stage != now]):
        del _held[let_go]
        let_go()
    if others:
        give_back()


def give_back() -> None:
    """Return freed memory to the system. A Python worker outlives its task and
    would keep the most that any task took, beside those that work."""
    pa.default_memory_pool().release_unused()
    _trim()(0)


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """The batches in slices of a bounded number of rows; what a batch took is
    given back before the next one, what other stages left before the first."""
    let_go_of_other_stages()
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
        give_back()


def texts_as_bytes(column: pa.Array) -> list[bytes]:
    """The texts of a string column as UTF-8 bytes, null as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def record_batch(columns: dict[str, pa.Array | tuple[list, pa.DataType]]) -> pa.RecordBatch:
    """A record batch from arrays or (values, type) pairs."""
    arrays = [v if isinstance(v, pa.Array) else pa.array(v[0], v[1]) for v in columns.values()]
    return pa.RecordBatch.from_arrays(arrays, names=list(columns))


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser on uint64 (Murmur's constants)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


@functools.lru_cache(maxsize=4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """POLY and its inverse to the powers 0..n-1, modulo 2**64."""
    both = []
    for base in (POLY, pow(POLY, -1, 1 << 64)):
        p = np.full(n, base, dtype=np.uint64)
        p[0] = 1
        both.append(np.cumprod(p, dtype=np.uint64))
    return both[0], both[1]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(12, (n - 1).bit_length())
    a, b = _powers(size)
    return a[:n], b[:n]


@functools.lru_cache(maxsize=1)
def byte_codes() -> np.ndarray:
    """A random-looking odd 64-bit code for each byte value."""
    return mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(POLY)) | np.uint64(1)


@functools.lru_cache(maxsize=1)
def _is_white() -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(WHITE)] = True
    return table


def pieces(data: bytes, size: int = PIECE_BYTES) -> Iterator[bytes]:
    """``data`` in pieces of about ``size`` bytes that end at white space; a
    longer run without white space stays whole."""
    at, n = 0, len(data)
    while n - at > size:
        end = at + size
        while end < n and data[end] not in WHITE:
            end += 1
        yield data[at:end]
        at = end
    yield data[at:] if at else data


def _piece_hashes(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, dtype=np.uint8)
    word = ~_is_white()[raw]
    edge = np.flatnonzero(np.diff(word, prepend=False, append=False))
    start, end = edge[0::2], edge[1::2]
    if not len(start):
        return np.empty(0, dtype=np.uint64)
    up, down = powers(len(raw) + 1)
    total = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum(byte_codes()[raw] * up[:-1], out=total[1:])
    h = (total[end] - total[start]) * down[start]
    return mix64(h + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def word_hashes(data: bytes) -> np.ndarray:
    """64-bit hashes of the words ``[^\\x20\\x09-\\x0D]+`` of ``data``, in order."""
    if len(data) <= PIECE_BYTES:
        return _piece_hashes(data)
    return np.concatenate([_piece_hashes(p) for p in pieces(data)])


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``size`` words; the whole sequence
    as one run if it is shorter; empty without words."""
    n = len(words)
    if not n:
        return words
    run = min(size, n)
    h = np.full(n - run + 1, run, dtype=np.uint64)
    for i in range(run):
        h = mix64(h * np.uint64(POLY) + words[i : n - run + 1 + i])
    return np.unique(h)


def id_filter(ids: DataFrame, n: int, max_bits: int = 1 << 27) -> np.ndarray:
    """A bit array (16 bits for each of ``n`` ids, ``max_bits`` = 16 MB at most)
    with the hash of every value of column ``id`` set. It only thins a scan
    that an exact join follows, so a full array costs time, not results."""
    bits = min(max_bits, 1 << max(16, (16 * n).bit_length()))
    at = F.pmod(F.xxhash64("id"), F.lit(bits))
    words = (ids.select(at.alias("at")).groupBy(F.shiftright("at", 5).alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 31 AS int))")).alias("bits")).toArrow())
    out = np.zeros(bits // 32, np.uint32)
    out[words["word"].to_numpy()] = words["bits"].to_numpy().astype(np.uint32)
    return out


def in_filter(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which of the xxhash64 values of ids may be in the filter."""
    at = hashes % (len(table) * 32)
    return (table[at >> 5] >> (at & 31).astype(np.uint32)) & 1 == 1


class Stored:
    """A frame written as Parquet to the shared folder; ``drop`` deletes it."""

    def __init__(self, df: DataFrame, name: str):
        self.spark, self.path = df.sparkSession, shared_path(df.sparkSession, "llm", name, unique=True)
        df.write.parquet(self.path)
        self.df = self.spark.read.parquet(self.path)

    def drop(self) -> None:
        delete_path(self.spark, self.path)
