"""Operator 8: LM scoring with context-tree weighting over bytes.

A text is its bytes (A-Z lower-cased) and an end symbol. Each byte is decomposed
into eight binary decisions, first bit first; a decision's node is the bits of
the byte seen so far. For every node there is a tree over the last 0 to
``depth`` bytes (the query: 6, about a word), whose counts come from all training documents. A context
of depth d holds the Krichevsky-Trofimov estimate of its own counts and, by
context-tree weighting, half of its probability goes to its children's product.
The log10 probability of a text adds up, bit by bit, the mixture over all
depths along its context. Code length per byte is -score / log10(2) / bytes.

The base score is a smoothed unigram model over words and an end token:
log10((c + 0.1) / (N + 0.1 (V + 1))).

Plan. Words (as 64-bit hashes) and strings of depth + 1 bytes are dealt into
parts, strings by their pair of last context bytes. Tasks count them in bounded
chunks; a shuffle adds up each part. Lists of numbers travel and are stored
packed: differences of sorted numbers, byte by byte, so that the codec of the
shuffle or the file leaves little of them. A task builds the trees below the
pairs of a part, bit by bit, as sorted arrays of the nodes that occur: memory
goes with the distinct strings of a part; depths 1 and 0 are at most 65,536 and
256 nodes whatever the corpus, and are the only parts the driver and a
broadcast hold. For scoring, documents are dealt into groups of about
``GROUP_BYTES`` of text by a hash; a group asks each part once for the distinct
words and strings it holds, a part answers ``MERGE_ROWS`` questions at a time,
and the group's documents are scored with the answers, which are in the order
of the questions and so need no keys. A frequent word is thus one entry per
group, not per document.

Defined cases: a null or empty text is the end symbol alone; repeated rows are
counted and scored each; a null doc_id counts as the empty id; without any
training document N = V = 0 and the base model gives each token probability 1;
unseen contexts give every bit one half; further columns are ignored.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starling.llm.common import Stored, give_back, mix64, record_batch, release, slices, texts_as_bytes, word_hashes

#: Bytes of context unless the caller says otherwise.
DEPTH = 3
#: Bytes of text of a scoring group; the fewest groups of a table of ``SMALL_BYTES`` each or more.
GROUP_BYTES, MIN_GROUPS, SMALL_BYTES = 16 << 20, 24, 1 << 16
#: Bytes of text whose counts a task gathers before it emits them.
CHUNK_BYTES = 8 << 20
#: Values that are gathered before they are merged or answered, and symbols that are scored at a time.
MERGE_ROWS, SCORE_ROWS = 1 << 20, 1 << 18
#: Counts whose logarithms are kept.
TABLE = 1 << 16
#: Stands for the end of a text and for what precedes it; no UTF-8 byte.
END = 0xFF
WORD, GRAM = 0, 1
LN_HALF, LN_PI, LN_10 = math.log(0.5), math.log(math.pi), math.log(10.0)


def grams(data: bytes, depth: int = DEPTH) -> np.ndarray:
    """For each byte of the text and its end, the byte and the ``depth`` before
    it as one number, the byte lowest."""
    kind = np.uint32 if depth < 4 else np.uint64
    raw = np.frombuffer(bytes([END] * depth) + data + bytes([END]), dtype=np.uint8).astype(kind)
    out = raw[depth:].copy()
    for i in range(1, depth + 1):
        out |= raw[depth - i : len(raw) - i] << kind(8 * i)
    return out


def log_gamma(x: np.ndarray) -> np.ndarray:
    """ln Gamma(x), x > 0: Stirling's series at x + 8, then down again."""
    product = np.ones_like(x)
    for i in range(8):
        product *= x + i
    y = x + 8.0
    r = 1.0 / (y * y)
    series = (1 / 12 - r * (1 / 360 - r * (1 / 1260 - r / 1680))) / y
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + series - np.log(product)


@functools.lru_cache(maxsize=1)
def _log_gammas() -> tuple[np.ndarray, np.ndarray]:
    """ln Gamma(n + 1/2) and ln Gamma(n + 1) of small n."""
    n = np.arange(TABLE, dtype=float)
    return log_gamma(n + 0.5), log_gamma(n + 1.0)


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """ln of the Krichevsky-Trofimov probability of the counts."""
    half, whole = _log_gammas()
    total = zeros + ones
    large = total >= TABLE
    if not large.any():
        return np.where(total > 0, half[zeros] + half[ones] - whole[total] - LN_PI, 0.0)
    out = np.empty(total.shape)
    out[~large] = log_kt(zeros[~large], ones[~large])
    a, b = zeros[large].astype(float), ones[large].astype(float)
    out[large] = log_gamma(a + 0.5) + log_gamma(b + 0.5) - log_gamma(a + b + 1.0) - LN_PI
    return out


def weigh(zeros: np.ndarray, ones: np.ndarray, below: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ln of the weighted probability, posterior weight of the node's own
    estimate), given the sum of its children's ln probabilities."""
    own = log_kt(zeros, ones)
    total = LN_HALF + np.logaddexp(own, below)
    return total, np.exp(LN_HALF + own - total)


def kt_one(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """KT estimate that the next bit is one."""
    return (ones + 0.5) / (zeros + ones + 1.0)


def shortened(keys: np.ndarray, n: np.ndarray, depth: int) -> list[tuple[np.ndarray, ...]]:
    """For the depths ``depth`` to 2: the distinct strings with so many bytes
    of context, sorted, their counts, and the place in them of each string of
    the depth before."""
    order = np.argsort(keys)
    out = [(keys[order], n[order].astype(np.int64), np.empty(0, np.int64))]
    for d in range(depth - 1, 1, -1):
        short, place = np.unique(out[-1][0] & ((1 << 8 * (d + 1)) - 1), return_inverse=True)
        out.append((short, np.bincount(place, out[-1][1], len(short)).astype(np.int64), place))
    return out


def levels(strings: list[tuple[np.ndarray, ...]], j: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(ids, zeros, ones, ln of the weighted probability, posterior weight of
    the own estimate) of the nodes of bit ``j`` at the depths of ``strings``. An
    id is the context with the node in place of the byte, so that sorted
    strings have their nodes in runs; at full depth the own estimate has all
    the weight."""
    start = log_pw = None
    for keys, n, place in strings:
        byte = keys & 0xFF
        node = keys - byte + ((1 << j) | (byte >> (8 - j)))
        edge = np.ones(len(keys), bool)
        edge[1:] = node[1:] != node[:-1]
        first = np.flatnonzero(edge)
        ids, total = node[first], np.add.reduceat(n, first)
        ones = np.add.reduceat(n * ((byte >> (7 - j)) & 1).astype(np.int64), first)
        zeros = total - ones
        if start is None:
            log_pw, stop = log_kt(zeros, ones), np.ones(len(ids))
        else:
            run = np.cumsum(edge) - 1
            log_pw, stop = weigh(zeros, ones, np.bincount(run[place[start]], log_pw, len(ids)))
        start = first
        yield ids, zeros, ones, log_pw, stop


class PairTree:
    """Counts and weighted probabilities of the 255 nodes (at 1..255) of one
    pair of context bytes, from its strings."""

    def __init__(self, keys: np.ndarray, n: np.ndarray, depth: int = DEPTH):
        self.zeros, self.ones, self.log_pw = np.zeros(256, np.int64), np.zeros(256, np.int64), np.zeros(256)
        strings = shortened(keys, n, depth)
        for j in range(8):
            for ids, zeros, ones, log_pw, _ in levels(strings, j):
                pass
            node = ids & 0xFF
            self.zeros[node], self.ones[node], self.log_pw[node] = zeros, ones, log_pw


class TopTree:
    """Depths 1 and 0: weights and estimates of 256 x 256 and 256 nodes."""

    def __init__(self, zeros: np.ndarray, ones: np.ndarray, below: np.ndarray):
        log_pw, self.stop1 = weigh(zeros, ones, below)
        self.kt1 = kt_one(zeros, ones)
        zeros0, ones0 = zeros.sum(axis=0), ones.sum(axis=0)
        _, self.stop0 = weigh(zeros0, ones0, log_pw.sum(axis=0))
        self.kt0 = kt_one(zeros0, ones0)


def log10_probabilities(top: TopTree, keys: np.ndarray, n: np.ndarray, wanted: np.ndarray,
                        depth: int = DEPTH) -> np.ndarray:
    """log10 P(byte | ``depth`` bytes before) of the wanted strings, whose pairs
    of context bytes have all of their training strings in ``keys``."""
    if not len(wanted):
        return np.zeros(0)
    strings = shortened(keys, n, depth) if len(keys) else []
    asked = [(wanted, np.arange(len(wanted)))]  # the distinct wanted strings of each depth, and the place of each in the next
    for d in range(depth - 1, 1, -1):
        short, place = np.unique(asked[-1][0] & ((1 << 8 * (d + 1)) - 1), return_inverse=True)
        asked[-1] = asked[-1][0], place
        asked.append((short, np.arange(len(short))))
    out = np.zeros(len(wanted))
    for j in range(8):
        short = asked[-1][0]
        last, node = (short >> 8) & 0xFF, (1 << j) | ((short & 0xFF) >> (8 - j))
        known, left = top.stop0[node] * top.kt0[node], 1.0 - top.stop0[node]
        known, left = known + left * top.stop1[last, node] * top.kt1[last, node], left * (1.0 - top.stop1[last, node])
        # the estimate is ``known`` and ``left`` of that of the deeper contexts
        trees = [(ids, kt_one(zeros, ones), stop) for ids, zeros, ones, _, stop in levels(strings, j)] or [None] * len(asked)
        for (short, place), tree in zip(reversed(asked), reversed(trees)):
            if short is not asked[-1][0]:
                known, left = known[place], left[place]
            if tree is None:
                continue
            ids, own, stop = tree
            ask = short - (short & 0xFF) + ((1 << j) | ((short & 0xFF) >> (8 - j)))
            at = np.minimum(np.searchsorted(ids, ask), len(ids) - 1)
            weight = np.where(ids[at] == ask, stop[at], 0.0)  # an unseen node leaves the estimate to the others
            known, left = known + left * weight * own[at], left * (1.0 - weight)
        p = known + 0.5 * left
        out += np.log10(np.where((wanted >> (7 - j)) & 1 == 1, p, 1.0 - p))
    return out


# ------------------------------------------------------------------- Spark
def pack(numbers: np.ndarray) -> bytes:
    """64-bit numbers byte by byte: all first bytes, all second ones and so on."""
    return numbers.view(np.uint8).reshape(-1, 8).T.tobytes()


def unpack(data: bytes | pa.Buffer, kind: type) -> np.ndarray:
    return np.frombuffer(data, np.uint8).reshape(8, -1).T.copy().view(kind).ravel()


def pack_sorted(keys: np.ndarray) -> bytes:
    return pack(np.diff(keys.astype(np.uint64), prepend=np.uint64(0)))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data, np.uint64), dtype=np.uint64)


def by_part(kind: int, keys: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, parts, ends): sorted keys in the order of their parts, sorted
    within, which parts occur and where each ends. Strings of one pair of last
    context bytes share a part."""
    part = np.empty(len(keys), np.uint16 if parts <= 1 << 16 else np.int64)
    size = np.zeros(parts, np.int64)
    for at in range(0, len(keys), SCORE_ROWS):  # hashes take several times the room of their keys
        some = keys[at : at + SCORE_ROWS].astype(np.uint64)
        hashed = mix64((some >> np.uint64(8)) & np.uint64(0xFFFF)) if kind == GRAM else some
        some = (hashed % np.uint64(parts)).astype(np.int64)
        part[at : at + SCORE_ROWS] = some
        size += np.bincount(some, minlength=parts)
    found = np.flatnonzero(size)
    return np.argsort(part, kind="stable"), found, np.cumsum(size)[found]


def sorted_counts(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct numbers, sorted, and how often each occurs; sorts in place."""
    numbers.sort()
    first = np.flatnonzero(np.append(True, numbers[1:] != numbers[:-1])) if len(numbers) else np.empty(0, np.int64)
    return numbers[first], np.diff(first, append=len(numbers))


def corpus_counts(training: DataFrame, parts: int, depth: int = DEPTH) -> DataFrame:
    """(kind, part, keys, n, total, size): sorted words or strings of each part
    with their counts, packed, the sum of these and how many there are. Tasks
    add up chunks of bounded size before the shuffle."""

    def rows(kind, arrays):
        keys = np.concatenate(arrays)
        arrays.clear()
        keys, n = sorted_counts(keys)
        order, part, ends = by_part(kind, keys, parts)
        keys, n = np.split(keys[order], ends[:-1]), np.split(n[order], ends[:-1])
        if len(part):
            yield record_batch({"kind": ([kind] * len(part), pa.int32()), "part": pa.array(part),
                                "keys": ([pack_sorted(k) for k in keys], pa.binary()), "n": ([pack(x) for x in n], pa.binary())})

    def count(batches):
        words, strings, size = [], [], 0
        for b in slices(batches):
            for data in texts_as_bytes(b.column("text")):
                data = data.lower()
                words.append(word_hashes(data))
                strings.append(grams(data, depth))
                size += len(data)
                if size >= CHUNK_BYTES:
                    yield from rows(WORD, words)
                    yield from rows(GRAM, strings)
                    words, strings, size = [], [], 0
                    give_back()
        if strings:
            yield from rows(WORD, words)
            yield from rows(GRAM, strings)
        del words, strings
        give_back()

    def add_up(t: pa.Table) -> pa.Table:
        keys = np.concatenate([unpack_sorted(x) for x in t["keys"].to_pylist()])
        n = np.concatenate([unpack(x, np.int64) for x in t["n"].to_pylist()])
        order = np.argsort(keys)
        keys, n = keys[order], n[order]
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        n = np.add.reduceat(n, first)
        out = pa.table({"kind": t["kind"][:1], "part": t["part"][:1], "keys": pa.array([pack_sorted(keys[first])]),
                        "n": pa.array([pack(n)]), "total": pa.array([int(n.sum())]), "size": pa.array([len(n)])})
        del keys, order, first, n
        give_back()
        return out

    found = training.select("text").mapInArrow(count, "kind int, part long, keys binary, n binary")
    return found.repartition(parts, "kind", "part").groupBy("kind", "part").applyInArrow(
        add_up, "kind int, part long, keys binary, n binary, total long, size long")


def top_tree(strings: DataFrame, depth: int = DEPTH) -> TopTree:
    """Depths 1 and 0 of the tree, from the rows of strings of
    ``corpus_counts``; at most 65,536 rows reach the driver."""

    def nodes(batches):
        for b in slices(batches, 1):
            dense = [np.zeros(1 << 16) for _ in range(3)]
            own = shortened(unpack_sorted(b.column("keys")[0].as_py()).view(np.int64),
                            unpack(b.column("n")[0].as_py(), np.int64), depth)
            for j in range(8):
                for ids, zeros, ones, log_pw, _ in levels(own, j):
                    pass
                for total, x in zip(dense, (zeros, ones, log_pw)):  # last context byte and node
                    total += np.bincount(ids & 0xFFFF, x, 1 << 16)
            some = np.flatnonzero(dense[0] + dense[1])
            yield record_batch({"at": pa.array(some), "zeros": pa.array(dense[0][some].astype(np.int64)),
                                "ones": pa.array(dense[1][some].astype(np.int64)), "log_pw": pa.array(dense[2][some])})

    found = (strings.select("keys", "n").mapInArrow(nodes, "at long, zeros long, ones long, log_pw double")
             .groupBy("at").agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"),
                                F.sum("log_pw").alias("log_pw")).toArrow())
    dense = [np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64), np.zeros(1 << 16)]
    for a, name in zip(dense, ("zeros", "ones", "log_pw")):
        a[found["at"].to_numpy()] = found[name].to_numpy()
    return TopTree(*(a.reshape(256, 256) for a in dense))


def sorted_distinct(numbers: np.ndarray) -> np.ndarray:
    """By sorting in place, which is faster here than the hash table of np.unique."""
    numbers.sort()
    return numbers[np.append(True, numbers[1:] != numbers[:-1])] if len(numbers) else numbers


def _distinct(arrays: Iterator[np.ndarray], kind: type) -> np.ndarray:
    """Distinct values of many arrays, merged as they come."""
    merged, held, size = np.empty(0, kind), [], 0
    for a in arrays:
        held.append(a)
        size += len(a)
        if size > MERGE_ROWS:
            merged, held, size = sorted_distinct(np.concatenate([merged, *held])), [], 0
    return sorted_distinct(np.concatenate([merged, *held]))


def group_keys(texts: list[bytes], hashes: list[np.ndarray], depth: int) -> list[tuple[int, np.ndarray]]:
    """The sorted distinct words (of ``hashes``) and strings of a group of documents."""
    return [(WORD, _distinct(hashes, np.uint64)),
            (GRAM, _distinct((grams(x, depth).astype(np.uint64) for x in texts), np.uint64))]


def _wanted(t: pa.Table, parts: int, depth: int) -> pa.Table:
    """What a group of documents asks each part."""
    rows, texts = [], [x.lower() for x in texts_as_bytes(t["text"])]
    for kind, keys in group_keys(texts, [word_hashes(x) for x in texts], depth):
        order, part, ends = by_part(kind, keys, parts)
        if len(part):
            rows += [(kind, p, pack_sorted(k)) for p, k in zip(part.tolist(), np.split(keys[order], ends[:-1]))]
        del order
    del texts
    give_back()
    kinds, part, keys = zip(*rows)
    return pa.table({"grp": pa.array([t["grp"][0].as_py()] * len(rows), pa.int64()), "kind": pa.array(kinds, pa.int32()),
                     "part": pa.array(part, pa.int64()), "keys": pa.array(keys, pa.binary())})


def answers(counts: DataFrame, wanted: DataFrame, top, parts: int, depth: int) -> DataFrame:
    """(grp, kind, part, value): for each row of ``wanted``, the packed counts
    of its words or log10 probabilities of its strings, in their order. ``top``
    is the broadcast ``TopTree``."""

    def answer(kind, part, known, asked):
        lists = [unpack_sorted(x) for _, x in asked]
        order = sorted_distinct(np.concatenate(lists))
        keys, n = known
        if kind == GRAM:
            value = log10_probabilities(top.value, keys.view(np.int64), n, order.view(np.int64), depth)
        else:
            value = np.zeros(len(order))
            if len(keys):
                at = np.minimum(np.searchsorted(keys, order), len(keys) - 1)
                value = np.where(keys[at] == order, n[at], 0).astype(float)
        values = [pack(value[np.searchsorted(order, x)]) for x in lists]
        return record_batch({"grp": ([g for g, _ in asked], pa.int64()), "kind": ([kind] * len(asked), pa.int32()),
                             "part": ([part] * len(asked), pa.int64()), "value": (values, pa.binary())})

    def run(batches):
        now, known, asked, size = None, None, [], 0
        for b in slices(batches, 1):
            grp, kind, part, keys, n = (b.column(c)[0].as_py() for c in ("grp", "kind", "part", "keys", "n"))
            if asked and ((kind, part) != now or size >= MERGE_ROWS):
                yield answer(*now, known, asked)
                asked, size = [], 0
            if (kind, part) != now:
                give_back()
                now, known = (kind, part), (np.empty(0, np.uint64), np.empty(0, np.int64))
            if grp is None:  # sorted before the questions
                known = unpack_sorted(keys), unpack(n, np.int64)
            else:
                asked.append((grp, keys))
                size += len(keys) // 8
        if asked:
            yield answer(*now, known, asked)

    both = counts.select(F.lit(None).cast("long").alias("grp"), "kind", "part", "keys", "n").unionByName(
        wanted.withColumn("n", F.lit(None).cast("binary")))
    return both.repartition(parts, "kind", "part").sortWithinPartitions("kind", "part", F.asc_nulls_first("grp")).mapInArrow(
        run, "grp long, kind int, part long, value binary")


def score_documents(docs: DataFrame, held_out: Column, doc_id: str = "doc_id",
                    depth: int = DEPTH) -> DataFrame:
    """Per document: doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score, score, n_symbols (bytes and end). Learns from the rows whose
    ``held_out`` is false and scores all, with contexts of up to ``depth`` bytes
    (2 to 6: a string must fit a key)."""
    if not 2 <= depth <= 6:
        raise ValueError("depth must be 2 to 6")
    spark = docs.sparkSession
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), held_out.alias("held_out"), "text")
    size = docs.agg(F.sum(F.octet_length("text")).alias("size"),
                    F.count_if(~F.col("held_out")).alias("ends")).first()
    size, ends = size["size"] or 0, size["ends"]
    groups = max(min(MIN_GROUPS, 1 + size // SMALL_BYTES), -(-size // GROUP_BYTES))
    counts = Stored(corpus_counts(docs.where(~F.col("held_out")), groups, depth), "lm_counts")
    total = counts.df.where(F.col("kind") == WORD).agg(F.sum("total").alias("n"), F.sum("size").alias("v")).first()
    n_train, v_train = (total["n"] or 0) + ends, (total["v"] or 0) + (ends > 0)
    release(spark)

    top = spark.sparkContext.broadcast(top_tree(counts.df.where(F.col("kind") == GRAM), depth))  # 4 x 65,536 numbers
    dealt = docs.select(F.pmod(F.xxhash64("doc_id", "text"), F.lit(groups)).alias("grp"), "doc_id", "held_out", "text")
    dealt = dealt.repartition(groups, "grp")
    wanted = dealt.select("grp", "text").groupBy("grp").applyInArrow(
        lambda t: _wanted(t, groups, depth), "grp long, kind int, part long, keys binary")
    values = Stored(answers(counts.df, wanted, top, groups, depth), "lm_values")
    del wanted
    counts.drop()
    release(spark)
    scale = n_train + 0.1 * (v_train + 1)

    def score(own: pa.Table, table: pa.Table) -> pa.Table:
        texts = [x.lower() for x in texts_as_bytes(own["text"])] if own.num_rows else []
        told = {at: i for i, at in enumerate(zip(table["kind"].to_pylist(), table["part"].to_pylist()))}
        hashes, known = [word_hashes(x) for x in texts], []
        for kind, keys in group_keys(texts, hashes, depth) if texts else ():
            order, part, stops = by_part(kind, keys, groups)
            value, begin = np.empty(len(keys)), 0
            for p, stop in zip(part.tolist(), stops.tolist()):
                value[order[begin:stop]] = unpack(table["value"][told[kind, p]].as_buffer(), np.float64)
                begin = stop
            known.append((keys, value))
            del order
        give_back()
        rows, held, symbols = [], [], 0

        def flush():
            g = np.concatenate([x for _, _, x in held])
            order = np.argsort(g)
            chance = np.empty(len(g))
            chance[order] = known[GRAM][1][np.searchsorted(known[GRAM][0], g[order])]
            for (h, n_symbols, _), own_chance in zip(held, np.split(chance, np.cumsum([n for _, n, _ in held])[:-1])):
                c = np.append(known[WORD][1][np.searchsorted(known[WORD][0], h)] if len(h) else np.empty(0), ends)
                rows.append((len(c), int((c > 0).sum()), float(np.log10((c + 0.1) / scale).sum()) if scale > 0.1 else 0.0,
                             float(own_chance.sum()), n_symbols))

        for data, h in zip(texts, hashes):
            g = grams(data, depth).astype(np.uint64)
            held.append((h, len(g), g))
            symbols += len(g)
            if symbols >= SCORE_ROWS:
                flush()
                held, symbols = [], 0
        if held:
            flush()
        del texts, hashes, held
        known.clear()
        give_back()
        n, n_known, base, full, n_symbols = zip(*rows) if rows else ((),) * 5
        return pa.table({
            "doc_id": own["doc_id"] if rows else pa.array([], pa.int64()),
            "held_out": own["held_out"] if rows else pa.array([], pa.bool_()),
            "n_tokens": pa.array(n, pa.int64()), "n_known": pa.array(n_known, pa.int64()),
            "train_tokens": pa.array([n_train] * len(rows), pa.int64()), "base_score": pa.array(base, pa.float64()),
            "score": pa.array(full, pa.float64()), "n_symbols": pa.array(n_symbols, pa.int64())})

    told = values.df.repartition(groups, "grp")
    return dealt.groupBy("grp").cogroup(told.groupBy("grp")).applyInArrow(
        score, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
               "base_score double, score double, n_symbols long")
