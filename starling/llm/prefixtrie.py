"""Operator 13: the prefix trie of conversations, by range minima over sorted LCPs.

A turn is named by a 128-bit digest of its role and text (SHA-256, cut), a
conversation by the list of its turns' digests. Equal lists are combined, the
distinct ones sorted globally; ``lcp[i]`` is the number of turns that list i
shares with the one before it (-1 for the first). A trie node of depth d is an
interval of lists in which every lcp but the first is at least d.

Every candidate prefix (list i, depth d) finds its interval by two independent
binary searches over a sparse table of range minima of the LCPs: the nearest
position at or before i, and the nearest behind it, with an lcp below d. No
candidate needs another's result and no stack is kept. A node is given out by
its leftmost list; its figures are differences of prefix sums over the interval
(members, bytes, distinct bytes, leaves), a range minimum (smallest member) and
a count of LCPs equal to d (children).

The sorted lists are kept in blocks. A task searches within its block; what
goes beyond an edge is answered in two steps: a sparse table over the minima of
all blocks (a few numbers a block; blocks grow with the input so that there are
at most ``MAX_BLOCKS`` and one a task) names the block in which the search ends,
and that block answers each (side, depth) once, whoever asks.

A list of n turns has n + 1 candidates, so the work goes with the number of
turns of distinct lists. Copies of a conversation are counted before they are
shuffled. The digest over the ids of conversations that end at one node is
sequential by nature: sorted ids are joined to short strings by many tasks, one
task hashes a node's strings as a stream, in constant memory. A conversation's
digests (24 bytes a turn) are one row; its texts are not.

Defined cases: rows without a conv_id belong to no conversation; a null turn
comes first; turns of equal number are ordered by role and digest; repeated
rows are turns by themselves; a null role or text is empty; an empty table has
no nodes, not even a root; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starling.llm.common import Stored, record_batch

#: Lists and turns of a block, and blocks that a larger input is held to.
BLOCK_LISTS, BLOCK_TURNS, MAX_BLOCKS = 4096, 1 << 17, 1 << 15
#: Ids joined to one string.
JOINED_IDS = 1000
NO_IDS = hashlib.sha256(b"").hexdigest()
FAR = np.int64(np.iinfo(np.int64).max)

NODE_SCHEMA = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
               "saved_tokens long, ends_sha256 string")
BLOCK_SCHEMA = ("block long, n long, lcp array<int>, length array<int>, copies array<long>, low array<long>, "
                "ends array<string>, sizes array<long>, first array<binary>, last array<binary>")
ANSWER_SCHEMA = ("target long, side int, depth int, copies long, total long, fresh long, leaves long, same long, "
                 "low long")


# ------------------------------------------------------------ conversations
def conversations(turns: DataFrame) -> DataFrame:
    """conv_id and its turns in order, each a digest and the bytes of its text."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.substring(F.unhex(F.sha2(F.concat(
        F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)), 1, 16)
    rows = turns.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), digest.alias("digest"),
        F.octet_length(text).cast("long").alias("size"))
    listed = F.sort_array(F.collect_list(F.struct("turn", "role", "digest", "size")))
    return rows.groupBy("conv_id").agg(listed.alias("t")).select(
        "conv_id", F.transform("t", lambda t: F.struct(t["digest"].alias("digest"), t["size"].alias("size"))).alias("turns"))


def rebuild(convs: DataFrame, base: Column, inherited: Column, most: int) -> DataFrame:
    """Each conversation with its first ``inherited`` turns (``most`` at the
    utmost) replaced by those of conversation ``base``; none where it is absent."""
    heads = convs.select(F.col("conv_id").alias("base"), F.slice("turns", 1, most).alias("head"))
    own = convs.select("conv_id", "turns", base.alias("base"), inherited.cast("int").alias("h"))
    empty = F.slice("turns", 1, 0)
    return own.join(heads, "base", "left").select("conv_id", F.concat(
        F.slice(F.coalesce("head", empty), F.lit(1), F.col("h")),
        F.slice("turns", F.col("h") + 1, F.size("turns"))).alias("turns"))


def digest_of_ids(members: DataFrame) -> DataFrame:
    """key and the SHA-256 of its conv_ids, ascending, comma-joined."""

    def join_ids(batches):
        key, ids = None, []

        def out(rows):
            return record_batch({"key": ([r[0] for r in rows], pa.binary()), "first": ([r[1] for r in rows], pa.int64()),
                                 "ids": ([r[2] for r in rows], pa.string())})

        for b in batches:
            rows = []
            for k, c in zip(b.column("key").to_pylist(), b.column("conv_id").to_pylist()):
                if ids and (k != key or len(ids) == JOINED_IDS):
                    rows.append((key, ids[0], ",".join(map(str, ids))))
                    ids = []
                key = k
                ids.append(c)
            yield out(rows)
        if ids:
            yield out([(key, ids[0], ",".join(map(str, ids)))])

    def hash_ids(batches):
        key, sha = None, None

        def out(rows):
            return record_batch({"key": ([r[0] for r in rows], pa.binary()), "ends": ([r[1] for r in rows], pa.string())})

        for b in batches:
            rows = []
            for k, ids in zip(b.column("key").to_pylist(), b.column("ids").to_pylist()):
                if k != key:
                    if sha:
                        rows.append((key, sha.hexdigest()))
                    key, sha = k, hashlib.sha256(ids.encode())
                else:
                    sha.update(b"," + ids.encode())
            yield out(rows)
        if sha:
            yield out([(key, sha.hexdigest())])

    joined = (members.select("key", "conv_id").repartitionByRange("key", "conv_id")
              .sortWithinPartitions("key", "conv_id").mapInArrow(join_ids, "key binary, first long, ids string"))
    return joined.repartition("key").sortWithinPartitions("key", "first").mapInArrow(hash_ids, "key binary, ends string")


# ------------------------------------------------------------ blocks
def common_turns(a: list[bytes], b: list[bytes]) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def blocks_of(lists: DataFrame, most_lists: int, most_turns: int) -> DataFrame:
    """The distinct lists in their global order, as rows of BLOCK_SCHEMA; a
    block's number is its task's, shifted, plus its own within the task."""

    def run(batches):
        task, nth, last = TaskContext.get().partitionId() << 32, 0, None
        held: list[tuple] = []
        turns = 0

        def block():
            lcp = [-1] + [common_turns(a[0], b[0]) for a, b in zip(held, held[1:])]
            columns = {
                "block": [task + nth], "n": [len(held)], "lcp": [lcp], "length": [[len(h[0]) for h in held]],
                "copies": [[h[2] for h in held]], "low": [[h[3] for h in held]], "ends": [[h[4] for h in held]],
                "sizes": [[s for h in held for s in h[1]]], "first": [held[0][0]], "last": [held[-1][0]]}
            ints, longs = pa.list_(pa.int32()), pa.list_(pa.int64())
            types = (pa.int64(), pa.int64(), ints, ints, longs, longs, pa.list_(pa.string()), longs,
                     pa.list_(pa.binary()), pa.list_(pa.binary()))
            return record_batch({k: (v, t) for (k, v), t in zip(columns.items(), types)})

        for b in batches:
            for row in zip(*(b.column(c).to_pylist() for c in ("digests", "sizes", "copies", "low", "ends"))):
                if held and (len(held) >= most_lists or turns >= most_turns):
                    yield block()
                    held, turns, nth = [], 0, nth + 1
                held.append(row)
                turns += len(row[0]) + 1
        if held:
            yield block()

    return lists.repartitionByRange("digests").sortWithinPartitions("digests").mapInArrow(run, BLOCK_SCHEMA)


class SparseTable:
    """Range minima: level k has the minimum of 2**k values from each place."""

    def __init__(self, values: np.ndarray):
        self.levels, self.n = [values], len(values)
        while 2 << (len(self.levels) - 1) <= self.n:
            low, half = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(np.minimum(low[:-half], low[half:]))

    def after(self, at: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The first place from ``at`` on with a value below ``depth``; n if none."""
        pos = np.array(at, dtype=np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            level = self.levels[k]
            inside = pos + (1 << k) <= self.n
            pos += np.where(inside & (level[np.minimum(pos, len(level) - 1)] >= depth), 1 << k, 0)
        return pos

    def before(self, at: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The last place up to ``at`` with a value below ``depth``; -1 if none."""
        pos = np.array(at, dtype=np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            level, start = self.levels[k], pos - (1 << k) + 1
            pos -= np.where((start >= 0) & (level[np.clip(start, 0, len(level) - 1)] >= depth), 1 << k, 0)
        return pos

    def minimum(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """The minimum of start..stop-1, the largest number where that is empty."""
        out = np.full(len(start), FAR)
        size = stop - start
        for k, level in enumerate(self.levels):
            here = np.flatnonzero((size >= 1 << k) & (size < 2 << k))
            out[here] = np.minimum(level[start[here]], level[stop[here] - (1 << k)])
        return out


@dataclass
class Directory:
    """A few numbers of every block, in the order of the lists."""

    block: np.ndarray
    edge: np.ndarray  # lcp of the block's first list with the list before it
    least: np.ndarray  # smallest lcp of the block, the edge too
    n_least: np.ndarray  # how often that occurs
    low: np.ndarray
    sums: np.ndarray  # 4 x (blocks + 1): copies, total, fresh, leaves of the blocks before

    def __post_init__(self):
        self.lcps, self.lows = SparseTable(self.least), SparseTable(self.low)

    def index(self, block: int) -> int:
        return int(np.searchsorted(self.block, block))

    def next_edge(self, b: int) -> int:
        return int(self.edge[b + 1]) if b + 1 < len(self.block) else -1

    def requests(self, b: int) -> Iterator[tuple[int, int, int]]:
        """(side, depth, target block) of the searches that leave block ``b``."""
        for side, edge in ((-1, int(self.edge[b])), (1, self.next_edge(b))):
            if edge >= 0:
                depth = np.arange(edge + 1)
                start = np.full(edge + 1, b + side)
                ends = self.lcps.before(start, depth) if side < 0 else self.lcps.after(start, depth)
                for d, t in zip(depth.tolist(), ends.tolist()):
                    if 0 <= t < len(self.block):
                        yield side, d, int(self.block[t])


def directory(blocks: DataFrame) -> Directory:
    """Read from the blocks: one row of numbers for each (at most MAX_BLOCKS
    and one a task, see ``node_table``)."""
    order = Window.orderBy("block")  # over the blocks' short rows
    shared = F.array_position(F.zip_with("prev", "first", lambda x, y: x.eqNullSafe(y)), False) - 1
    heads = blocks.select(
        "block", "first", "last", F.array_min(F.slice("lcp", 2, F.size("lcp"))).alias("inner"), "lcp", "length", "copies",
        "low", "sizes")
    head_size = F.slice("sizes", 1, F.element_at("length", 1))
    add = lambda column: F.aggregate(column, F.lit(0).cast("long"), lambda a, x: a + x)
    # bytes of the turns of all lists; of those that the list before does not share (the first list: all of its)
    per_list = _per_list()
    rows = heads.select(
        "block", "first", "last", "inner", F.size("last").alias("last_length"), head_size.alias("head"),
        F.size(F.filter("lcp", lambda x: x == F.col("inner"))).alias("n_inner"), F.array_min("low").alias("low"),
        add("copies").alias("copies"), per_list("lcp", "length", "copies", "sizes").alias("s"))
    rows = rows.withColumn("prev", F.lag("last").over(order)).withColumn(
        "edge", F.when(F.col("prev").isNull(), -1).otherwise(shared).cast("int"))
    rows = rows.withColumn("next_edge", F.coalesce(F.lead("edge").over(order), F.lit(-1)))
    least = F.coalesce(F.least("edge", "inner"), F.col("edge"))
    got = rows.select(
        "block", "edge", least.alias("least"),
        ((F.col("edge") == least).cast("int") + F.when(F.col("inner") == least, F.col("n_inner")).otherwise(0)).alias("n_least"),
        "low", "copies", F.col("s.total").alias("total"),
        (F.col("s.fresh") - add(F.slice("head", F.lit(1), F.greatest("edge", F.lit(0))))).alias("fresh"),
        (F.col("s.leaves") + (F.col("next_edge") < F.col("last_length")).cast("long")).alias("leaves"),
    ).orderBy("block").toPandas()
    sums = np.zeros((4, len(got) + 1), dtype=np.int64)
    for k, name in enumerate(("copies", "total", "fresh", "leaves")):
        sums[k, 1:] = np.cumsum(got[name].to_numpy(np.int64))
    column = lambda name: got[name].to_numpy(np.int64)
    return Directory(column("block"), column("edge"), column("least"), column("n_least"), column("low"), sums)


def _per_list():
    """total, fresh and leaves of a block by itself: its first list shares
    nothing, its last list is not counted as a leaf."""

    @F.pandas_udf("total long, fresh long, leaves long")
    def sums(lcp, length, copies, sizes):
        import pandas as pd

        out = []
        for row in zip(lcp, length, copies, sizes):
            f = Figures(*map(np.asarray, row), next_edge=FAR)
            out.append((int(f.total.sum()), int(f.fresh.sum()), int(f.leaf.sum())))
        return pd.DataFrame(out, columns=["total", "fresh", "leaves"])

    return sums


class Figures:
    """Numbers of the lists of one block; ``lcp[0]`` is its edge."""

    def __init__(self, lcp, length, copies, sizes, next_edge):
        self.lcp, self.length = lcp.astype(np.int64), length.astype(np.int64)
        self.n = len(self.lcp)
        self.first = np.concatenate([[0], np.cumsum(self.length)])[:-1]
        self.bytes = np.concatenate([[0], np.cumsum(np.asarray(sizes, dtype=np.int64))])
        every = np.arange(self.n)
        whole = self.upto(every, self.length)
        self.copies = copies.astype(np.int64)
        self.total = self.copies * whole
        self.fresh = whole - self.upto(every, np.maximum(self.lcp, 0))
        self.leaf = np.append(self.lcp[1:], next_edge) < self.length

    def upto(self, i: np.ndarray, turns: np.ndarray) -> np.ndarray:
        """Bytes of the first ``turns`` turns of lists ``i``."""
        return self.bytes[self.first[i] + turns] - self.bytes[self.first[i]]

    def prefix_sums(self) -> np.ndarray:
        """4 x (n + 1): copies, total, fresh, leaves of the lists before."""
        out = np.zeros((4, self.n + 1), dtype=np.int64)
        for k, values in enumerate((self.copies, self.total, self.fresh, self.leaf)):
            out[k, 1:] = np.cumsum(values)
        return out


def block_figures(row: dict, d: Directory) -> tuple[int, Figures]:
    b = d.index(row["block"])
    lcp = np.array(row["lcp"], dtype=np.int64)
    lcp[0] = d.edge[b]
    return b, Figures(lcp, np.array(row["length"]), np.array(row["copies"]), row["sizes"], d.next_edge(b))


def answers(row: dict, d: Directory) -> list[tuple]:
    """Rows of ANSWER_SCHEMA for the (side, depth) pairs asked of a block: sums
    of the lists before the place where the search from the left ends; the
    smallest member on the asker's side of the place."""
    _, f = block_figures(row, d)
    table, low, sums = SparseTable(f.lcp), np.array(row["low"], dtype=np.int64), f.prefix_sums()
    out = []
    for q in row["asked"]:
        depth = np.array([q["depth"]])
        if q["side"] > 0:
            end = int(table.after(np.array([0]), depth)[0])
            out.append((row["block"], 1, q["depth"], *(int(s[end]) for s in sums), int((f.lcp[:end] == q["depth"]).sum()),
                        int(low[:end].min()) if end else None))
        else:
            start = int(table.before(np.array([f.n - 1]), depth)[0])
            out.append((row["block"], -1, q["depth"], 0, 0, 0, 0, 0, int(low[start:].min())))
    return out


def nodes(row: dict, d: Directory) -> dict[str, tuple]:
    """The nodes whose leftmost list lies in a block, as columns of NODE_SCHEMA."""
    b, f = block_figures(row, d)
    table, low = SparseTable(f.lcp), np.array(row["low"], dtype=np.int64)
    lows, sums = SparseTable(low), f.prefix_sums()
    known = {(a["side"], a["depth"]): a for a in row["answers"] or ()}
    # candidates: list i with each depth from its lcp to its length
    start = np.maximum(f.lcp, 0)
    count = f.length - start + 1
    i = np.repeat(np.arange(f.n), count)
    depth = np.arange(len(i)) - np.repeat(np.cumsum(count) - count, count) + start[i]
    left, right = table.before(i, depth), table.after(i + 1, depth)
    members = [s[right] - s[i] for s in sums]
    smallest = np.minimum(lows.minimum(np.maximum(left, 0), i), lows.minimum(i, right))
    by_lcp = np.sort(f.lcp * (f.n + 1) + np.arange(f.n))
    children = np.searchsorted(by_lcp, depth * (f.n + 1) + right) - np.searchsorted(by_lcp, depth * (f.n + 1) + i + 1)
    # intervals that go on behind the block, or begin before it
    beyond = (right == f.n) & (d.next_edge(b) >= depth)
    for x in np.unique(depth[beyond]).tolist():
        here = beyond & (depth == x)
        target = int(d.lcps.after(np.array([b + 1]), np.array([x]))[0])
        a = known[1, x] if target < len(d.block) else None
        for m, s, name in zip(members, d.sums, ("copies", "total", "fresh", "leaves")):
            m[here] += s[target] - s[b + 1] + (a[name] if a else 0)
        between = slice(b + 1, target)
        children[here] += int(d.n_least[between][d.least[between] == x].sum()) + (a["same"] if a else 0)
        far = int(d.lows.minimum(np.array([b + 1]), np.array([target]))[0])
        if a and a["low"] is not None:
            far = min(far, a["low"])
        smallest[here] = np.minimum(smallest[here], far)
    outside = left < 0
    for x in np.unique(depth[outside]).tolist():
        target = int(d.lcps.before(np.array([b - 1]), np.array([x]))[0])
        far = min(known[-1, x]["low"], int(d.lows.minimum(np.array([target + 1]), np.array([b]))[0]))
        here = outside & (depth == x)
        smallest[here] = np.minimum(smallest[here], far)
    own = left == i
    above = f.upto(i, np.maximum(depth - 1, 0))
    n, total, fresh, leaves = members
    saved = total - n * above - (fresh - (above - f.upto(i, start[i])))
    ends = [row["ends"][k] if e else NO_IDS for k, e in zip(i[own].tolist(), (f.length[i] == depth)[own].tolist())]
    parent = np.roll(smallest, 1)[own]
    children = children + (f.length[i] > depth)
    longs = {"conv_id": smallest[own], "depth": depth[own], "parent": parent, "n_convs": n[own],
             "n_children": children[own], "n_leaves": leaves[own], "saved_tokens": saved[own]}
    out = {k: pa.array(v, pa.int64()) for k, v in longs.items()}
    out["parent"] = pa.array(parent, pa.int64(), mask=depth[own] == 0)
    return {("parent_conv_id" if k == "parent" else k): v for k, v in out.items()} | {"ends_sha256": (ends, pa.string())}


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for b in batches:
        for k in range(b.num_rows):
            yield b.slice(k, 1).to_pylist()[0]


def node_table(convs: DataFrame) -> DataFrame:
    """The trie over conversations (conv_id, turns as an array of struct digest,
    size): rows of NODE_SCHEMA. ``depth`` 0 is the root."""
    spark = convs.sparkSession
    digests = F.transform("turns", lambda t: t["digest"])
    key = F.unhex(F.sha2(F.concat_ws("", F.transform(digests, F.hex)).cast("binary"), 256))
    listed = Stored(convs.select("conv_id", "turns", key.alias("key")), "trie_lists")
    same = Stored(listed.df.groupBy("key").agg(
        F.count("*").alias("copies"), F.min("conv_id").alias("low"), F.max(F.size("turns")).alias("n")), "trie_keys")
    size = same.df.agg(F.count("*").alias("lists"), F.coalesce(F.sum(F.col("n") + 1), F.lit(0)).alias("turns")).first()
    shared = same.df.where("copies > 1").select("key")
    ends = digest_of_ids(listed.df.join(shared, "key"))
    one = listed.df.select(F.col("conv_id").alias("low"), "turns").join(same.df, "low")
    lists = one.join(ends, "key", "left").select(
        digests.alias("digests"), F.transform("turns", lambda t: t["size"]).alias("sizes"), "copies", "low",
        F.coalesce("ends", F.sha2(F.col("low").cast("string").cast("binary"), 256)).alias("ends"))
    blocks = Stored(blocks_of(lists, max(BLOCK_LISTS, -(-size["lists"] // MAX_BLOCKS)),
                              max(BLOCK_TURNS, -(-size["turns"] // MAX_BLOCKS))), "trie_blocks")
    listed.drop()
    same.drop()
    shared_directory = spark.sparkContext.broadcast(directory(blocks.df))

    def ask(batches):
        d = shared_directory.value
        for b in batches:
            rows = [(block, *r) for block in b.column("block").to_pylist() for r in d.requests(d.index(block))]
            cols = [*zip(*rows)] or [()] * 4
            types = (pa.int64(), pa.int32(), pa.int32(), pa.int64())
            yield record_batch({n: (c, t) for n, c, t in zip(("block", "side", "depth", "target"), cols, types)})

    def answer(batches):
        d = shared_directory.value
        names = [c.split()[0] for c in ANSWER_SCHEMA.split(", ")]
        for row in _rows(batches):
            cols = zip(*answers(row, d))
            yield record_batch({n: (c, pa.int32() if n in ("side", "depth") else pa.int64()) for n, c in zip(names, cols)})

    def give(batches):
        d = shared_directory.value
        for row in _rows(batches):
            yield record_batch(nodes(row, d))

    asked = blocks.df.select("block").mapInArrow(ask, "block long, side int, depth int, target long")
    per_target = asked.select("target", "side", "depth").distinct().groupBy(F.col("target").alias("block")).agg(
        F.collect_list(F.struct("side", "depth")).alias("asked"))
    body = ("block", "lcp", "length", "copies", "low", "sizes")
    replies = blocks.df.select(*body).join(per_target, "block").mapInArrow(answer, ANSWER_SCHEMA)
    per_block = asked.join(replies, ["target", "side", "depth"]).groupBy("block").agg(F.collect_list(F.struct(
        "side", "depth", "copies", "total", "fresh", "leaves", "same", "low")).alias("answers"))
    return blocks.df.select(*body, "ends").join(per_block, "block", "left").mapInArrow(give, NODE_SCHEMA)


def prefix_trie(turns: DataFrame, group: int = 5, most: int = 8) -> DataFrame:
    """The trie over rebuilt conversations: conversation c takes its first h
    turns from conversation c - c % ``group``, h being the unsigned crc32 of c
    in decimal modulo ``most`` + 1, and its own turns after its first h."""
    convs = Stored(conversations(turns), "trie_conversations")
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % (most + 1)
    return node_table(rebuild(convs.df, F.col("conv_id") - F.col("conv_id") % group, h, most))
