"""Operator 1: MinHash near-dedup by a signature-coordinate inverted join.

Documents with the same shingle set form a class; one representative of each
goes on. Its MinHash signature has ``COORDINATES`` values. Two sets with a
Jaccard similarity of 0.8 agree on 77 of 96 coordinates on average, on fewer
than ``MATCHES`` = 56 with a probability below 1e-5.

* Prefix merging. Every (coordinate, value) is a posting list; lists are
  ordered by length, shortest first, over all representatives. Two signatures
  that agree on MATCHES coordinates share a list among the first COORDINATES -
  MATCHES + 1 of each, so only those are posted and merged. A list of one
  representative takes a place in that prefix but need not be posted. A
  posting's key also has a byte of a second coordinate, which the list
  chooses: texts that share little more than one shingle do not meet. Two sets
  at the threshold share 26 lists on average and agree on the second
  coordinate of four in five; none is left with a probability below 1e-7.
* Skip merging. The long lists behind the prefix are not merged; for a pair
  found in the prefix they are probed in a one-byte-per-coordinate sketch,
  which gives the number of collisions. Pairs of MATCHES or more go on.
* Confirmation compares the full shingle sets of both texts.

A list is not expanded into all of its pairs. Rounds compare its members with
its leader (the smallest; a random one) if they are not yet in the same
component; each round's links are contracted. In the second round one pair of
two components, the one with most collisions, is confirmed. The members of
lists that still hold different components are joined exactly, on their full
sets: sets are ordered by the shingles' frequency, the larger one's first fifth
meets the smaller one's first ninth, and a meeting too late in either order is
no candidate. Texts that are alike below the threshold hold shingles of their
own there and are not paired, so a large group of them costs no square. Only
pairs inside one component stay uncompared.

Defined cases: a null or empty text, or one without words, has an empty set
and is linked with nothing; rows of the same doc_id and text share a class; a
row with a null doc_id is returned with a null component and kept; an empty
table gives no rows; further columns are ignored. Long texts are hashed whole,
in blocks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starling.llm.common import (
    cut,
    id_filter,
    in_filter,
    mix64,
    record_batch,
    release,
    row_keys,
    shingle_hashes,
    slices,
    texts_as_bytes,
    word_hashes,
)
from starling.llm.components import components

COORDINATES = 96
MATCHES = 56
#: The leader that a list has in a round: its smallest member, or one that an
#: order of the list's own puts first. The last round is exact.
SMALLEST, MIXED, EXACT = "smallest", "mixed", "exact"
ROUNDS = (SMALLEST, MIXED, EXACT)
#: Shingles that are hashed to all coordinates at a time.
BLOCK = 4096


def coefficients(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Odd factors and offsets of ``n`` hash functions on uint64."""
    at = np.arange(1, 2 * n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (mix64(at[:n]) | np.uint64(1))[:, None], mix64(at[n:])[:, None]


def signature(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest value of each hash function over the shingles."""
    low = np.full(len(a), np.iinfo(np.uint64).max)
    for at in range(0, len(shingles), BLOCK):
        np.minimum(low, (shingles[None, at : at + BLOCK] * a + b).min(axis=1), out=low)
    return low


def set_of(data: bytes, shingle: int) -> np.ndarray:
    """Sorted hashes of the distinct word shingles of a text."""
    return shingle_hashes(word_hashes(data.lower()), shingle)


def signatures(docs: DataFrame, shingle: int, coordinates: int) -> DataFrame:
    """doc_id, n_shingles, the 128-bit identity of the set (s1, s2), the keys
    of its (coordinate, value) pairs and the sketch; keys null for no set."""

    def run(batches):
        a, b = coefficients(coordinates)
        at = np.arange(1, coordinates + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        for batch in slices(batches):
            n, s1, s2, keys, sketch = [], [], [], [], []
            for data in texts_as_bytes(batch.column("text")):
                h = set_of(data, shingle)
                n.append(len(h))
                s1.append(int(mix64(h).sum(dtype=np.uint64).view(np.int64)))
                s2.append(int(np.bitwise_xor.reduce(mix64(h + np.uint64(1)), initial=0).astype(np.uint64).view(np.int64)))
                k = mix64(signature(h, a, b) ^ at) if len(h) else None
                keys.append(None if k is None else k.view(np.int64))
                sketch.append(None if k is None else k.astype(np.uint8).tobytes())
            yield record_batch({"doc_id": batch.column("doc_id"), "n_shingles": (n, pa.int64()), "s1": (s1, pa.int64()),
                                "s2": (s2, pa.int64()), "keys": (keys, pa.list_(pa.int64())),
                                "sketch": (sketch, pa.binary())})

    return docs.mapInArrow(run, "doc_id long, n_shingles long, s1 long, s2 long, keys array<long>, sketch binary")


def prefix_postings(classes: DataFrame, coordinates: int, matches: int) -> DataFrame:
    """(key, rep): the posting lists of the prefixes, without lists of one."""
    postings = classes.select("rep", F.posexplode("keys").alias("at", "key"))
    length = postings.groupBy("key").agg(F.count("*").alias("df")).where("df > 1")
    own = (postings.join(length, "key").groupBy("rep")
           .agg(F.sort_array(F.collect_list(F.struct("df", "key", "at"))).alias("own")))
    room = F.size("own") - F.lit(matches - 1)  # the prefix less its lists of one
    prefix = own.where(room > 0).select("rep", F.slice("own", F.lit(1), room).alias("own"))
    prefix = prefix.join(classes.select("rep", "sketch"), "rep").select("rep", "sketch", F.explode("own").alias("x"))
    second = (F.col("x.at") + 1 + F.pmod(F.xxhash64("x.key"), F.lit(coordinates - 1)).cast("int")) % coordinates
    byte = F.substring("sketch", second + 1, F.lit(1))
    return prefix.select(F.xxhash64("x.key", byte).alias("key"), "rep")


def open_lists(members: DataFrame) -> DataFrame:
    """The postings (key, rep, label) of lists that hold several components."""
    mixed = members.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi")
    return members.join(mixed.select("key"), "key")


def candidate_pairs(members: DataFrame, leader: str) -> DataFrame:
    """Distinct (a, b), a < b: members of one list and of different components,
    one of them the list's leader."""
    still = open_lists(members)
    mixed = F.col("key") if leader == MIXED else F.lit(0)  # rep XOR key is an order of its own in each list
    leaders = (still.groupBy("key").agg(F.min(F.col("rep").bitwiseXOR(mixed)).alias("m"))
               .select("key", F.col("m").bitwiseXOR(mixed).alias("lead")))
    pairs = still.join(leaders, "key").where("rep <> lead")
    return pairs.select(F.least("rep", "lead").alias("a"), F.greatest("rep", "lead").alias("b")).distinct()


def colliding(pairs: DataFrame, sketches: DataFrame, matches: int, percent: int) -> DataFrame:
    """The pairs (with different labels) that agree on ``matches`` coordinates
    of the sketch and whose set sizes allow the similarity; ``n`` collisions."""
    side = lambda x: sketches.select(F.col("rep").alias(x), F.col("n").alias(f"n{x}"),
                                     F.col("label").alias(f"l{x}"), F.col("sketch").alias(f"s{x}"))

    def run(batches):
        for t in slices(batches, 8192):
            both = [np.frombuffer(b"".join(t.column(c).to_pylist()), np.uint8).reshape(t.num_rows, -1) for c in ("sa", "sb")]
            n = (both[0] == both[1]).sum(axis=1)
            t = t.select(["a", "b", "la", "lb"]).append_column("n", pa.array(n, pa.int64()))
            yield t.filter(pa.array(n >= matches))

    near = F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent
    return (pairs.join(side("a"), "a").join(side("b"), "b").where(near & F.expr("la <> lb"))
            .select("a", "b", "la", "lb", "sa", "sb").mapInArrow(run, "a long, b long, la long, lb long, n long"))


def best_pairs(pairs: DataFrame) -> DataFrame:
    """One pair of each two components: the one with most collisions."""
    low, high = F.least("la", "lb"), F.greatest("la", "lb")
    pair = F.struct("n", F.struct("a", "b", "la", "lb", "n").alias("pair"))
    return pairs.groupBy(low.alias("low"), high.alias("high")).agg(F.max(pair).alias("best")).select("best.pair.*")


def full_sets(docs: DataFrame, ids: DataFrame, shingle: int) -> DataFrame:
    """(rep, shingles): the whole shingle sets of the documents in ``ids``."""
    held = docs.sparkSession.sparkContext.broadcast(id_filter(ids, ids.count()))

    def run(batches):
        table = held.value
        for b in slices(batches):
            b = b.filter(pa.array(in_filter(table, b.column("at").to_numpy())))
            sets = [set_of(data, shingle).tobytes() for data in texts_as_bytes(b.column("text"))]
            yield record_batch({"id": b.column("doc_id"), "shingles": (sets, pa.binary())})

    found = docs.select("doc_id", "text", F.xxhash64("doc_id").alias("at")).mapInArrow(run, "id long, shingles binary")
    return found.join(ids, "id").dropDuplicates(["id"])


def exact_pairs(sets: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """(a, b, la, lb): pairs of ``sets`` (id, shingles) of different labels
    that may reach the similarity; none that does is missing. Prefixes are
    taken of the sets ordered by frequency, rarest shingle first; shingles of
    one set only take a place in it but are not posted."""

    def run(batches):
        for t in slices(batches):
            both = [(i, np.frombuffer(s, np.int64)) for i, s in zip(t.column("id").to_pylist(), t.column("shingles").to_pylist())]
            for i, h in both:
                yield record_batch({"id": pa.array(np.full(len(h), i)), "n": pa.array(np.full(len(h), len(h))),
                                    "shingle": pa.array(h)})

    rows = sets.mapInArrow(run, "id long, n long, shingle long")
    often = rows.groupBy("shingle").agg(F.count("*").alias("df")).where("df > 1")
    own = (rows.join(often, "shingle").groupBy("id", "n")
           .agg(F.sort_array(F.collect_list(F.struct("df", "shingle"))).alias("own")).join(labels, "id"))
    alone = F.col("n") - F.size("own")
    # n less the least overlap, rounded up in whole numbers, and one more
    part = lambda p, q: F.expr(f"CAST(n - (n * {p} + {q - 1}) DIV {q} + 1 AS INT)")
    probe, index = part(percent, 100), part(2 * percent, 100 + percent)
    posted = own.where(probe > alone).select("id", "n", "label", alone.alias("alone"), index.alias("index"), F.posexplode(
        F.slice("own", F.lit(1), (probe - alone).cast("int"))).alias("at", "x"))
    posted = posted.select("id", "n", "label", "index", "x.shingle", (F.col("alone") + F.col("at") + 1).alias("at"))
    x = posted.select("shingle", *(F.col(c).alias(f"x_{c}") for c in ("id", "n", "label", "at")))
    y = posted.where("at <= index").select("shingle", *(F.col(c).alias(f"y_{c}") for c in ("id", "n", "label", "at")))
    met = x.join(y, "shingle").where(
        F.expr("(y_n < x_n OR (y_n = x_n AND y_id < x_id)) AND x_label <> y_label")
        & (F.col("y_n") * 100 >= F.col("x_n") * percent)
        & ((1 + F.least(F.expr("x_n - x_at"), F.expr("y_n - y_at"))) * (100 + percent) >= F.expr("x_n + y_n") * percent))
    return met.select(F.col("x_id").alias("a"), F.col("y_id").alias("b"), F.col("x_label").alias("la"),
                      F.col("y_label").alias("lb")).distinct()


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Labels (u, v) of the pairs whose full sets reach the similarity."""
    side = lambda x: sets.select(F.col("id").alias(x), F.col("shingles").alias(f"s{x}"))

    def run(batches):
        for t in slices(batches):
            keep = []
            for x, y in zip(t.column("sa").to_pylist(), t.column("sb").to_pylist()):
                common = len(np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), assume_unique=True))
                keep.append(100 * common >= percent * ((len(x) + len(y)) // 8 - common))
            t = t.filter(pa.array(keep, pa.bool_()))
            yield record_batch({"u": t.column("la"), "v": t.column("lb")})

    return pairs.join(side("a"), "a").join(side("b"), "b").select("la", "lb", "sa", "sb").mapInArrow(run, "u long, v long")


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, coordinates: int = COORDINATES,
                    matches: int = MATCHES) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id (smallest doc_id that
    links reach), kept (doc_id = component_id). Links are pairs with 100 x
    intersection >= ``percent`` x union of their shingle sets. Where a doc_id
    has several texts, each text is a document of its own with that id."""
    docs = row_keys(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    found = _by_key(docs.select(F.col("row_key").alias("doc_id"), "text"), shingle, percent, coordinates, matches)
    ids = docs.where("row_key <> doc_id").select("row_key", "doc_id").distinct()
    if ids.isEmpty():
        return found
    ids = docs.where("row_key IS NOT NULL").select("row_key", F.col("doc_id").alias("of_row")).distinct()
    first = ids.select(F.col("row_key").alias("first_key"), F.col("of_row").alias("of_first"))
    named = found.join(ids, F.col("doc_id") == F.col("row_key"), "left").join(
        first, F.col("component_id") == F.col("first_key"), "left")
    return named.select(F.col("of_row").alias("doc_id"), "n_shingles", F.col("of_first").alias("component_id"),
                        F.coalesce(F.col("of_row") == F.col("of_first"), F.lit(True)).alias("kept"))


def _by_key(docs: DataFrame, shingle: int, percent: int, coordinates: int, matches: int) -> DataFrame:
    """``near_duplicates`` of documents of which no two differ under one id."""
    spark = docs.sparkSession
    signed = cut(signatures(docs, shingle, coordinates))
    identity = ["n_shingles", "s1", "s2"]
    some = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    reps = some.groupBy(*identity).agg(F.min("doc_id").alias("rep"))
    classes = cut(some.join(reps, identity).where("doc_id = rep").dropDuplicates(["rep"])
                  .select("rep", F.col("n_shingles").alias("n"), "keys", "sketch"))
    members = cut(signed.select("doc_id", *identity))
    reps = cut(members.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy(*identity).agg(F.min("doc_id").alias("rep")))
    del signed, some
    release(spark)
    lists = cut(prefix_postings(classes, coordinates, matches))
    sketches = cut(lists.select("rep").distinct().join(classes.select("rep", "n", "sketch"), "rep"))
    del classes
    release(spark)

    labels = None
    for leader in ROUNDS:
        named = lists if labels is None else lists.join(labels, "rep", "left")
        label = F.col("rep") if labels is None else F.coalesce("label", "rep")
        own = sketches if labels is None else sketches.join(labels, "rep", "left")
        postings = named.select("key", "rep", label.alias("label"))
        if leader == EXACT:
            rest = cut(open_lists(postings).select(F.col("rep").alias("id"), "label").distinct())
            sets = cut(full_sets(docs, rest.select("id"), shingle))
            pairs = cut(exact_pairs(sets, rest, percent))
        else:
            pairs = candidate_pairs(postings, leader)
            pairs = colliding(pairs, own.select("rep", "n", label.alias("label"), "sketch"), matches, percent)
            pairs = cut(best_pairs(pairs) if leader == MIXED else pairs)
        if pairs.isEmpty():
            continue
        if leader != EXACT:
            sets = full_sets(docs, pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), shingle)
        links = components(confirmed(pairs, sets, percent))
        if labels is None:
            labels = cut(links.select(F.col("node").alias("rep"), F.col("component").alias("label")))
        else:  # old labels are renamed; a new label names itself as well
            moved = labels.join(links, F.col("label") == F.col("node"), "left").select(
                "rep", F.coalesce("component", "label").alias("label"))
            new = links.join(labels, F.col("node") == F.col("rep"), "left_anti").select(
                F.col("node").alias("rep"), F.col("component").alias("label"))
            labels = cut(moved.unionAll(new))
        release(spark)

    out = members.join(reps, identity, "left")
    if labels is not None:
        out = out.join(labels, "rep", "left")
    component = F.coalesce(*(["label"] if labels is not None else []), "rep", "doc_id")
    return out.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), component).alias("component_id")).select(
        "doc_id", "n_shingles", "component_id", F.coalesce(F.expr("doc_id = component_id"), F.lit(True)).alias("kept"))
