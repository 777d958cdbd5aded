"""Operator 7: exact top-k inner products by Fagin's threshold algorithm.

Vectors are dealt into blocks by a hash of their id, the queries as well. A
task gets one block of vectors and one block of queries. It sorts the block's
components into one list per dimension and, for a query, reads the lists from
their best ends in steps: every vector met for the first time is scored in
full; the bound is the score that a vector not met yet could have at most, the
product of the query with the last component read in each list. A query is
finished when the bound is below its k-th score (an equal score with a smaller
id could still come before), or when every vector of the block has been met. The k best of every block meet in one ranking per
query, limited to k rows a task before the shuffle.

Queries are a stated set against all rows, in blocks: a block of vectors is
read once for each block of ``QUERY_ROWS`` queries.

Defined cases: vectors that are null, empty, or hold a null or non-finite
component, and rows without an id, take no part; rows equal in id and vector
are one, every other row of a repeated id is a candidate (for queries of another
id) and, where the id is a query, its rows share one ranking; only vectors of equal length are compared; ties go to the
smaller id; with fewer candidates than k all are returned; a component so large
that a score might not fit a long is an error that names the row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Fewest blocks that vectors are dealt into, and most rows of a block.
MIN_BLOCKS, BLOCK_ROWS = 48, 16384
#: Queries of a block.
QUERY_ROWS = 4096
#: Entries read from each list between two looks at the bound.
STEP = 8


def integer_vectors(vectors: DataFrame, vec_id: str, vector: str, scale: float) -> DataFrame:
    """(id, v): the vectors that take part, as floor(scale * x)."""
    x = F.col(vector).cast("array<double>")
    whole = (F.size(x) > 0) & F.forall(x, lambda e: F.coalesce(F.abs(e) < F.lit(float("inf")), F.lit(False)))
    # so many squares of this bound fit a long
    bound = F.floor(F.sqrt(F.lit(2.0**63 - 2.0**20) / F.size(x)))
    told = F.concat(F.lit("components too large for exact scores, id "), F.col(vec_id).cast("string"))
    unit = F.transform(x, lambda e: F.when(F.abs(e * scale) < bound, F.floor(e * scale)).otherwise(
        F.raise_error(told).cast("long")))
    return vectors.where(F.col(vec_id).isNotNull() & whole).select(F.col(vec_id).cast("long").alias("id"), unit.alias("v")).distinct()


class SortedLists:
    """A block's vectors with one sorted list per dimension."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.rows = ids[order], rows[order]
        self.lists = np.argsort(-self.rows, axis=0, kind="stable")  # (rows, dimensions), largest first
        self.floats = self.rows.astype(float)
        self.largest = float(np.abs(self.floats).max(initial=0.0))

    def top(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray, int]:
        """(ids, scores) of the k best but ``own``, and how many were scored."""
        n = len(self.ids)
        used = np.flatnonzero(query)
        q = query[used]
        if not len(used):  # every score is 0
            best = np.flatnonzero(self.ids != own)[:k]
            return self.ids[best], np.zeros(len(best), np.int64), 0
        # floats where every sum is a whole number that they hold exactly
        exact = self.largest * float(np.abs(query.astype(float)).sum()) < 2.0**53
        rows, factors = (self.floats, query.astype(float)) if exact else (self.rows, query)
        down, up = used[q > 0], used[q < 0]
        met = self.ids == own
        scored, left = 0, n - int(met.sum())
        best, scores = np.empty(0, np.int64), np.empty(0, np.int64)
        depth, step = 0, STEP
        while depth < n and scored < left:
            end = min(n, depth + step)
            seen = np.zeros(n, bool)
            seen[self.lists[depth:end, down]] = True
            seen[self.lists[n - end : n - depth, up]] = True
            new = np.flatnonzero(seen & ~met)
            met[new] = True
            scored += len(new)
            # most of a block at once is cheaper without picking its rows
            found = (rows @ factors)[new] if 16 * len(new) > n else rows[new] @ factors
            if len(found) > k:  # ties of the k-th stay for the smaller id
                good = found >= np.partition(found, len(found) - k)[len(found) - k]
                new, found = new[good], found[good]
            best, scores = self._keep(np.concatenate([best, new]), np.concatenate([scores, found.astype(np.int64)]), k)
            depth, step = end, step * 2
            last = np.where(q > 0, self.lists[end - 1, used], self.lists[n - end, used])
            if len(best) >= min(k, n) and scores[-1] > self.rows[last, used] @ q:
                break
        return self.ids[best], scores, scored

    @staticmethod
    def _keep(best: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        order = np.lexsort((best, -scores))[:k]
        return best[order], scores[order]


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding",
          scale: float = 256.0) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best rows of each query.
    ``is_query`` is a condition on the column ``id``."""
    rows = integer_vectors(vectors, vec_id, vector, scale)
    size = rows.agg(F.count("*").alias("n"), F.count_if(is_query).alias("q")).first()
    blocks = max(MIN_BLOCKS, -(-size["n"] // BLOCK_ROWS))
    query_blocks = max(1, -(-size["q"] // QUERY_ROWS))
    part = lambda n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    length = F.size("v").alias("dim")
    items = rows.select("id", "v", length, part(blocks).alias("block"), every(query_blocks).alias("qblock"))
    queries = rows.where(is_query).select("id", "v", length, every(blocks).alias("block"), part(query_blocks).alias("qblock"))
    keys = ["dim", "block", "qblock"]

    def search(own: pa.Table, ask: pa.Table) -> pa.Table:
        out = []
        if own.num_rows and ask.num_rows:
            ids, rows = _dense(own)
            lists = SortedLists(ids, rows)
            for q, query in zip(*_dense(ask)):
                best, scores, _ = lists.top(query, q, k)
                out.append((np.full(len(best), q), best, scores))
        cols = [np.concatenate(c) for c in zip(*out)] if out else [np.empty(0, np.int64)] * 3
        return pa.table(dict(zip(("query_id", "vec_id", "score"), map(pa.array, cols))))

    found = items.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInArrow(
        search, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return (found.withColumn("rank", rank).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


def _dense(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    v = t["v"].combine_chunks()
    flat = v.flatten() if isinstance(v, pa.ListArray) else pa.concat_arrays([c.flatten() for c in v.chunks])
    return t["id"].to_numpy(), flat.to_numpy().reshape(t.num_rows, -1)
