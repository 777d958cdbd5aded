"""Versioned dimension merge, SCD type 2 (M1, M2; J1 match, W1 windows).

Rules (the warehouse procedure bodies are not available; these are ours):

1. unknown key, op I or U -> insert an open version (end 9999-12-31, flag 1);
2. known active key, equal hash -> nothing;
3. known active key, other hash -> close the active version at the change
   time and open a new one;
4. op D -> close the active version, insert nothing; unknown key -> nothing;
5. I after D -> new version even with the same hash;
6. changes are ordered by ``dms_timestamp``; changes of one key with one
   timestamp collapse to the last by op (I < U < D), then hash, then type-1
   values, then the remaining columns;
7. type-1 columns (off by default) take, in every version, the value of the
   last change of that version's run;
8. a change not newer than the key's boundary (start of its active version,
   or the time of the delete that closed it) is late: it goes to ``late`` and
   does not rewrite history. Changes without a usable timestamp or without a
   key go there too.

State between batches is the active set plus ``tombstones`` (key, time of the
delete that closed its last version), so a batch costs the active set and the
batch, never the closed history.

Plan. Everything is expressed with joins, aggregations and windows:

* per-key batch statistics (counts; partial aggregation) give the batch keys
  and whether it has hot keys; they are checkpointed and read by all branches;
* the active set is matched with the batch keys in one left join (bucketed
  scan in the dimension store: only the keys are shuffled);
* the batch's changes, the state of its keys (open version, tombstone) and
  boundary markers form one row set, shuffled once by (key, chunk); one sort
  by time and the tie rule feeds every window: boundary (rule 8), tie
  collapse (first row of its time, rule 6), previous event, next kept event;
* hot keys, those with more than ``max_group_rows`` changes, are split off where
  the changes are read (their list is broadcast) and merged apart; all other
  keys take the plain path above, with its one shuffle. The hot keys' changes
  of one key and time are first collapsed by a partial aggregation (rule 6), so
  a bulk update under one timestamp is one row; keys that still have more rows
  are cut at quantiles of their rows' times into chunks of about
  ``max_group_rows`` rows (MAX_CHUNKS at most), whatever the spread of the
  times. Per-chunk summaries stitch the chunk edges; AQE chooses how they are
  joined by their size. Only the hot keys' rows are checkpointed. With more than
  MAP_SIDE_KEYS hot keys all keys go through the chunks.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampType

from starling.functions.audit import open_end
from starling.session import free_shuffle_files, shared_root
from starling.schemas import DIM_CUSTOMER, DIM_PRODUCT, OP_DELETE, OP_UPDATE

VERSION_COLUMNS = ("record_start_ts", "record_end_ts", "active_flag")
DEFAULT_MAX_GROUP_ROWS = 1_000_000
#: Most chunks that a hot key is cut into.
MAX_CHUNKS = 1024
#: Most hot keys that are broadcast (each with a boundary or its cuts).
MAP_SIDE_KEYS = 10_000


@dataclass(frozen=True)
class DimensionSpec:
    """Columns and roles of one versioned dimension."""

    name: str
    key: str
    schema: StructType
    hash_col: str = "hash_value"
    op_col: str = "cdc_operation"
    ts_col: str = "dms_timestamp"
    type1_columns: tuple[str, ...] = field(default=())

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def payload(self) -> list[str]:
        """Columns a change carries into a version (all but the version columns)."""
        return [c for c in self.columns if c not in VERSION_COLUMNS]

    def with_type1(self, *cols: str) -> "DimensionSpec":
        return DimensionSpec(self.name, self.key, self.schema, self.hash_col, self.op_col, self.ts_col, tuple(cols))


CUSTOMER_DIM = DimensionSpec("dim_customer", "customer_id", DIM_CUSTOMER)
PRODUCT_DIM = DimensionSpec("dim_product", "product_id", DIM_PRODUCT)

def tombstone_schema(spec: DimensionSpec) -> StructType:
    key_field = spec.schema[spec.key]
    return StructType([key_field, StructField("deleted_ts", TimestampType(), True)])


def late_schema(spec: DimensionSpec) -> StructType:
    fields = [spec.schema[c] for c in spec.payload]
    return StructType(fields + [StructField(spec.ts_col, TimestampType(), True),
                                StructField("late_boundary_ts", TimestampType(), True)])


def empty_frame(spark: SparkSession, schema: StructType) -> DataFrame:
    """Empty DataFrame planned in the JVM: ``Filter(false)`` is folded into an
    empty local relation by the optimizer, which then prunes every join and
    union branch that reads it (a first batch skips all dimension lookups)."""
    return spark.range(1).select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]).where(F.lit(False))


def empty_dimension(spark: SparkSession, spec: DimensionSpec) -> DataFrame:
    return empty_frame(spark, spec.schema)


def empty_tombstones(spark: SparkSession, spec: DimensionSpec) -> DataFrame:
    return empty_frame(spark, tombstone_schema(spec))


def row_schema(spec: DimensionSpec) -> StructType:
    """Columns of the tagged merge output: dimension columns plus the change
    time (late rows), the boundary (late rows), the delete time (tombstones)."""
    extra = [StructField(spec.ts_col, TimestampType(), True),
             StructField("late_boundary_ts", TimestampType(), True),
             StructField("deleted_ts", TimestampType(), True)]
    return StructType(list(spec.schema.fields) + extra)


@dataclass
class MergeResult:
    """The merge output as one frame tagged by ``part``:

    * ``active``: open versions after the batch (kept and new);
    * ``closed``: versions this batch closed;
    * ``tombstones``: keys whose last version was closed by a delete;
    * ``late``: changes not applied (rule 8).

    One frame so that a writer stores all parts in one pass; the accessors
    filter on ``part``, which the optimizer pushes into the union branches.
    """

    rows: DataFrame
    spec: DimensionSpec

    def part(self, name: str, cols: list[str]) -> DataFrame:
        return self.rows.where(F.col("part") == name).select(*cols)

    @property
    def active(self) -> DataFrame:
        return self.part("active", self.spec.columns)

    @property
    def closed(self) -> DataFrame:
        return self.part("closed", self.spec.columns)

    @property
    def late(self) -> DataFrame:
        return self.part("late", late_schema(self.spec).fieldNames())

    @property
    def tombstones(self) -> DataFrame:
        return self.part("tombstones", tombstone_schema(self.spec).fieldNames())

    def dimension(self) -> DataFrame:
        """All versions produced or kept by this merge (active and closed)."""
        return self.rows.where(F.col("part").isin("active", "closed")).select(*self.spec.columns)


def tag(df: DataFrame, spec: DimensionSpec, part: str | None = None) -> DataFrame:
    """Project ``df`` onto ``row_schema`` (missing columns NULL) plus ``part``."""
    have = set(df.columns)
    cols = [f"`{f.name}`" if f.name in have else f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`"
            for f in row_schema(spec).fields]
    return df.selectExpr(*cols, f"'{part}' AS part" if part else "part")


def quantile_cuts(events: DataFrame, key: str, ts: str, max_group_rows: int) -> DataFrame:
    """(key, _cuts): for keys with more than ``max_group_rows`` rows, the times
    at which their rows are cut into chunks, at quantiles of the rows."""
    fractions = [i / MAX_CHUNKS for i in range(1, MAX_CHUNKS)]
    n = events.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > max_group_rows)
    times = (events.join(n, key).groupBy(key).agg(
        F.max("_n").alias("_n"), F.percentile_approx(F.unix_micros(ts), fractions, 4 * MAX_CHUNKS).alias("_q")))
    m = F.least(F.lit(MAX_CHUNKS), F.ceil(F.col("_n") / F.lit(max_group_rows))).cast("int")
    cut = F.transform(F.sequence(F.lit(1), F.col("_m") - 1),
                      lambda i: F.get("_q", F.floor(i * MAX_CHUNKS / F.col("_m")).cast("int") - 1))
    return (times.withColumn("_m", m).where("_m > 1")
            .select(key, F.array_distinct(cut).alias("_cuts")))


def with_bounds(chg: DataFrame, bounds: DataFrame, stats: DataFrame, key: str, max_group_rows: int) -> DataFrame:
    """``chg`` with ``_b``, its key's boundary (NULL without one); ``bounds``
    has one row per key, ``stats`` the changes per key (``_n``).

    A join on the key would bring all changes of a hot key to one task, and its
    other side is an aggregate on that key, so AQE would not split it. So
    the changes of the MAP_SIDE_KEYS hottest keys beyond ``max_group_rows``
    meet their boundaries where they are read (a broadcast of at most
    that many rows). Each other key holds at most one in MAP_SIDE_KEYS of the
    batch, or ``max_group_rows`` changes, and goes through the plain join."""
    hot = F.broadcast(stats.where(F.col("_n") > F.lit(max_group_rows)).orderBy(F.col("_n").desc(), key)
                      .limit(MAP_SIDE_KEYS).select(key))
    found = F.broadcast(bounds.join(hot, key, "left_semi"))
    map_side = chg.join(hot, key, "left_semi").join(found, key, "left")
    return map_side.unionByName(chg.join(hot, key, "left_anti").join(bounds, key, "left"))


def shuffled(rows: DataFrame, h: str, *by: str) -> DataFrame:
    """``rows`` dealt by ``by``. A hash ``h`` in lower-case hex digits hardly
    compresses and makes up most of a row: it travels as the bytes they spell,
    any other text as it is."""
    if rows.schema[h].dataType != StringType():
        return rows.repartition(*by)
    raw = F.unhex(h)
    return (rows.withColumn("_raw", F.when(F.lower(F.hex(raw)) == F.col(h), raw))
            .withColumn(h, F.when(F.col("_raw").isNull(), F.col(h)))
            .repartition(*by)
            .withColumn(h, F.coalesce(h, F.lower(F.hex("_raw")))).drop("_raw"))


# Row kinds of the merge's row set: a change of the batch, an open version of
# a batch key, a tombstone of a batch key (a delete at its original time), and
# a boundary marker (rule 8).
_CHANGE, _EXISTING, _TOMB, _MARKER = 0, 1, 2, 3


def _op_rank(op: Column) -> Column:
    return F.when(op == OP_DELETE, 2).when(op == OP_UPDATE, 1).otherwise(0)


def batch_stats(changes: DataFrame, spec: DimensionSpec) -> DataFrame:
    """Per key of a batch: number of changes (partial aggregation; reads only
    the key column)."""
    return changes.where(F.col(spec.key).isNotNull()).groupBy(spec.key).agg(F.count(F.lit(1)).alias("_n"))


def scd2_merge(
    active: DataFrame,
    tombstones: DataFrame,
    changes: DataFrame,
    spec: DimensionSpec,
    max_group_rows: int = DEFAULT_MAX_GROUP_ROWS,
    materialize: bool = True,
    out_partitions: int | None = None,
    has_state: bool | None = None,
    stats: DataFrame | None = None,
) -> MergeResult:
    """Apply one batch of ``changes`` (silver rows) to a dimension state.

    ``active`` holds one open version per key, ``tombstones`` the deleted keys.
    Returns the new state plus the versions this batch closed and the late
    changes, as one tagged frame. Pure apart from ``materialize``, which
    checkpoints intermediate results into the session's checkpoint dir: the
    per-key batch statistics when there is state (the key match and the hot
    keys both read them) and, when hot keys exist, their shuffled row set,
    which the chunk summaries read again. The other keys' branches share one
    exchange (AQE reuses it), so nothing else is materialized.

    ``out_partitions``: rebalance the batch-sized outputs (new versions, late
    changes) by key into that many partitions, the bucket layout of a
    bucketed store, so a task writes one file per bucket; AQE splits a bucket
    made heavy by a hot key over several tasks (more files, no straggler).
    The untouched active rows keep the partitioning of their bucketed scan.

    ``has_state``: whether ``active``/``tombstones`` may hold rows (None: look,
    one row at most). Without state nothing can be late except changes
    without a time, so the boundary pass is left out.

    ``stats``: ``batch_stats(changes, spec)``, where the caller has it already
    (written down: several branches read it).
    """
    key, h, op, ts = spec.key, spec.hash_col, spec.op_col, "_ts"
    payload = spec.payload
    others = [c for c in payload if c != key]
    types = {f.name: f.dataType for f in spec.schema.fields}
    spark = changes.sparkSession

    chg = changes.select(*payload, F.col(spec.ts_col).cast("timestamp").alias(ts))
    if has_state is None:
        has_state = not (active.isEmpty() and tombstones.isEmpty())
    # A change without a usable time cannot be ordered, one without a key
    # belongs to no version: late, split off before the shuffle (a filter on
    # the scan).
    usable = F.col(ts).isNotNull() & F.col(key).isNotNull()
    untimed = chg.where(~usable).select(
        *payload, F.col(ts).alias(spec.ts_col), F.lit(None).cast("timestamp").alias("late_boundary_ts"))
    chg = chg.where(usable)

    given, stats = stats is not None, batch_stats(changes, spec) if stats is None else stats
    if materialize and has_state and not given:  # read by several branches (keys, hot keys)
        shared_root(spark)
        stats = stats.checkpoint(eager=True)
    keys = stats.select(key)
    over = stats.where(F.col("_n") > F.lit(max_group_rows)).select(key)
    found = over.limit(MAP_SIDE_KEYS + 1).collect()

    # One left join of the active set with the batch keys splits it into
    # touched and untouched rows. The active set, read as a bucketed scan in
    # the store, is not shuffled; Spark picks the join by the keys' size.
    matched = active.join(keys.withColumn("_touched", F.lit(True)), key, "left")
    touched = matched.where(F.col("_touched").isNotNull()).drop("_touched")
    untouched = matched.where(F.col("_touched").isNull()).drop("_touched")
    tomb_in = tombstones.join(keys, key, "left_semi")
    tomb_out = tombstones.join(keys, key, "left_anti")

    # Keys are merged independently of each other, so hot keys may go their own
    # way: only their rows are collapsed, cut, checkpointed and stitched.
    state = (touched, tomb_in)
    if not found:
        merged = [_merge_keys(chg, *state, spec, has_state)]
    elif len(found) > MAP_SIDE_KEYS:
        merged = [_merge_keys(chg, *state, spec, has_state, max_group_rows, materialize, stats)]
    else:
        hot = F.broadcast(spark.createDataFrame(found, over.schema))
        merged = [
            _merge_keys(*[df.join(hot, key, "left_semi") for df in (chg, *state)], spec, has_state, max_group_rows,
                        materialize),
            _merge_keys(*[df.join(hot, key, "left_anti") for df in (chg, *state)], spec, has_state)]
    from_kept = reduce(DataFrame.unionByName, [versions for versions, _ in merged])
    late = reduce(DataFrame.unionByName, [late for _, late in merged if late is not None], untimed)
    if found and materialize:
        free_shuffle_files(spark)

    from_kept, late = tag(from_kept, spec), tag(late, spec, "late")
    if out_partitions:
        from_kept = from_kept.hint("rebalance", out_partitions, key)
        late = late.hint("rebalance", out_partitions, key)
    out = (
        tag(untouched, spec, "active")
        .unionByName(from_kept)
        .unionByName(tag(tomb_out, spec, "tombstones"))
        .unionByName(late)
    )
    return MergeResult(out, spec)


def _merge_keys(
    chg: DataFrame,
    touched: DataFrame,
    tomb_in: DataFrame,
    spec: DimensionSpec,
    has_state: bool,
    max_group_rows: int | None = None,
    materialize: bool = True,
    stats: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame | None]:
    """The new versions and tombstones (tagged by ``part``) and the late changes
    (None: there can be none) of some keys: ``chg`` holds their changes,
    ``touched`` their open versions, ``tomb_in`` their tombstones.

    With ``max_group_rows``, keys of more rows are cut into chunks. ``stats``
    has the changes per key where there are more than MAP_SIDE_KEYS hot keys;
    without it, all keys are hot ones and few enough to be broadcast."""
    key, h, op, ts = spec.key, spec.hash_col, spec.op_col, "_ts"
    payload = spec.payload
    others = [c for c in payload if c != key]
    types = {f.name: f.dataType for f in spec.schema.fields}
    chunked, few = max_group_rows is not None, stats is None

    def as_rows(df: DataFrame, at: str, *kinds: int) -> DataFrame:
        """``df`` as rows of the merge's row set, one per kind (one scan)."""
        have = set(df.columns)
        cols = [f"`{c}`" if c in have else f"CAST(NULL AS {types[c].simpleString()}) AS `{c}`" for c in payload]
        kind = str(kinds[0]) if len(kinds) == 1 else f"explode(array({', '.join(map(str, kinds))}))"
        return df.selectExpr(*cols, f"`{at}` AS `{ts}`", f"{kind} AS _kind")

    order_fields = [h, *spec.type1_columns, *[c for c in others if c != h and c not in spec.type1_columns]]
    late = None
    if chunked:
        # Late changes leave first; the others collapse to one row per key and
        # time, by the tie rule, before any task sees a whole key.
        if has_state:
            bounds = (touched.select(key, F.col("record_start_ts").alias("_b"))
                      .unionByName(tomb_in.select(key, F.col("deleted_ts").alias("_b")))
                      .groupBy(key).agg(F.max("_b").alias("_b")))
            chg = (chg.join(F.broadcast(bounds), key, "left") if few
                   else with_bounds(chg, bounds, stats, key, max_group_rows))
            late = chg.where(F.col(ts) <= F.col("_b")).select(
                *payload, F.col(ts).alias(spec.ts_col), F.col("_b").alias("late_boundary_ts"))
            chg = chg.where(F.col("_b").isNull() | (F.col(ts) > F.col("_b")))
        # The tie rule names every column but the key; with the key from there
        # too, every reader of these rows needs the same exchange (reused).
        tie = F.struct(_op_rank(F.col(op)).alias("_rank"), *order_fields, key)
        chg = chg.groupBy(key, ts).agg(F.max(tie).alias("_row")).select(*[f"_row.{c}" for c in payload], ts)

    # One row set for the batch: its changes, the state of its keys as the
    # first events of their histories, and (unless late changes have left
    # already) the boundary markers of rule 8.
    rows = as_rows(chg, ts, _CHANGE)
    marked = has_state and not chunked
    if has_state:
        marker = (_MARKER,) if marked else ()
        rows = (rows.unionByName(as_rows(touched, "record_start_ts", _EXISTING, *marker))
                .unionByName(as_rows(tomb_in, "deleted_ts", _TOMB, *marker)))

    if chunked:
        # Chunk ids grow with time, so order across chunks is order in time.
        cuts = quantile_cuts(rows, key, ts, max_group_rows)
        cuts = F.broadcast(cuts) if few else cuts
        chunk = F.size(F.filter("_cuts", lambda c: c < F.unix_micros(ts)))
        rows = rows.join(cuts, key, "left").select(
            *payload, ts, "_kind", F.when(F.col("_cuts").isNull(), 0).otherwise(chunk).cast("long").alias("_chunk"),
            F.col("_cuts").isNotNull().alias("_hot"))
    else:
        rows = rows.withColumn("_chunk", F.lit(0).cast("long"))

    # The one shuffle of these rows: by (key, chunk). One sort serves every
    # window below: by time, then by the tie rule of rule 6 (op rank, hash,
    # type-1 values, remaining columns; all descending). The boundary, the
    # late split, the tie collapse and the later windows (ordered by time, a
    # prefix of this order) reuse its partitioning and order (a checkpoint
    # keeps both: it records the plan's output partitioning).
    rank = F.when(F.col("_kind") == _CHANGE, _op_rank(F.col(op))).otherwise(-1)
    rows = shuffled(rows, h, key, *(["_chunk"] if chunked else [])).withColumn("_rank", rank)
    tie_order = Window.partitionBy(key, "_chunk").orderBy(
        F.col(ts).asc_nulls_first(), F.col("_rank").desc(), *[F.col(c).desc() for c in order_fields])
    whole = tie_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    boundary = (F.max(F.when(F.col("_kind") == _MARKER, F.col(ts))).over(whole) if marked
                else F.lit(None).cast("timestamp"))
    rows = rows.select("*", boundary.alias("_boundary"), F.lag(ts).over(tie_order).alias("_prev_ts"))
    if chunked and materialize:
        rows = rows.checkpoint(eager=True)
    is_change = F.col("_kind") == _CHANGE
    is_late = is_change & F.col("_boundary").isNotNull() & (F.col(ts) <= F.col("_boundary"))
    if marked:
        late = rows.where(is_late).select(
            *payload, F.col(ts).alias(spec.ts_col), F.col("_boundary").alias("late_boundary_ts"))

    # Rule 6: one event per (key, ts), the first of its time in the tie order.
    # Applied changes are newer than the boundary, hence than every state and
    # marker row of their key, so a time's rows are adjacent and all applied.
    first_of_time = F.col("_prev_ts").isNull() | (F.col("_prev_ts") != F.col(ts))
    events = rows.where((is_change & ~is_late & first_of_time) | F.col("_kind").isin(_EXISTING, _TOMB)).select(
        *payload, ts, "_chunk", "_kind",
        ((F.col("_kind") == _TOMB) | ((F.col("_kind") == _CHANGE) & (F.col(op) == OP_DELETE))).alias("_del"),
        *(["_hot"] if chunked else []))
    w = Window.partitionBy(key, "_chunk").orderBy(ts)

    chunks = Window.partitionBy(key).orderBy("_chunk")
    state = F.struct(F.col("_del").alias("d"), F.col(h).alias("h"))
    ev = events.withColumn("_prev", F.lag(state).over(w))
    prev = F.col("_prev")
    if chunked:
        # Last event of the preceding chunk, for the first event of each chunk.
        chunk_prev = (
            events.where("_hot").groupBy(key, "_chunk").agg(F.max_by(state, F.col(ts)).alias("_last"))
            .select(key, "_chunk", F.lag("_last").over(chunks).alias("_chunk_prev"))
            .where(F.col("_chunk_prev").isNotNull())
        )
        ev = ev.join(chunk_prev, [key, "_chunk"], "left")
        prev = F.coalesce(F.col("_prev"), F.col("_chunk_prev"))
    # A tombstone is always kept: if nothing later is kept it is the key's
    # tombstone again; for the events after it, it acts as "no version".
    keep = (
        F.when(F.col("_kind") == _TOMB, F.lit(True))
        .when(F.col("_del"), prev.isNotNull() & ~prev["d"])
        .otherwise(prev.isNull() | prev["d"] | ~prev["h"].eqNullSafe(F.col(h)))
    )
    ev = ev.withColumn("_keep", keep).drop("_prev", "_chunk_prev")

    # Start of the next kept event = end of this version.
    kept = ev.where("_keep").withColumn("_next", F.lead(ts).over(w))
    if chunked:
        chunk_next = (
            kept.where("_hot").groupBy(key, "_chunk").agg(F.min(ts).alias("_first"))
            .select(key, "_chunk",
                    F.min("_first").over(chunks.rowsBetween(1, Window.unboundedFollowing)).alias("_chunk_next"))
            .where(F.col("_chunk_next").isNotNull())
        )
        kept = (kept.join(chunk_next, [key, "_chunk"], "left")
                .withColumn("_next", F.coalesce("_next", "_chunk_next")))

    if spec.type1_columns:
        kept = _apply_type1(ev, kept, spec, w, chunks if chunked else None)

    # One pass over the kept events yields versions (open or closed) and
    # tombstones; untouched active rows and tombstones, and late changes,
    # are the other branches of the tagged output.
    open_ = F.col("_next").isNull()
    part = (F.when(~F.col("_del") & open_, "active").when(~F.col("_del"), "closed")
            .when(open_, "tombstones"))
    from_kept = kept.select(
        *[
            F.col(ts).alias(c) if c == "record_start_ts"
            else F.coalesce(F.col("_next"), open_end()).alias(c) if c == "record_end_ts"
            else F.when(open_, 1).otherwise(0).alias(c) if c == "active_flag"
            else F.col(c)
            for c in spec.columns
        ],
        F.when(F.col("_del"), F.col(ts)).alias("deleted_ts"),
        part.alias("part"),
    ).where(F.col("part").isNotNull())
    return from_kept, late


def _apply_type1(ev: DataFrame, kept: DataFrame, spec: DimensionSpec, w: Window, chunks: Window | None) -> DataFrame:
    """Rule 7: each version takes the type-1 values of the last event of its
    run (from its start up to the next kept event)."""
    key, ts = spec.key, "_ts"
    t1 = list(spec.type1_columns)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    runs = ev.withColumn("_vstart", F.max(F.when(F.col("_keep"), F.col(ts))).over(upto))
    if chunks is not None:
        chunk_prior = (
            ev.where("_hot").groupBy(key, "_chunk").agg(F.max(F.when(F.col("_keep"), F.col(ts))).alias("_last_kept"))
            .select(key, "_chunk",
                    F.max("_last_kept").over(chunks.rowsBetween(Window.unboundedPreceding, -1)).alias("_prior"))
            .where(F.col("_prior").isNotNull())
        )
        runs = (runs.join(chunk_prior, [key, "_chunk"], "left")
                .withColumn("_vstart", F.coalesce("_vstart", "_prior")))
    runs = (
        runs.where(F.col("_vstart").isNotNull())
        .groupBy(key, "_vstart")
        .agg(F.max_by(F.struct(*t1), F.col(ts)).alias("_t1"))
    )
    out = kept.join(runs, (kept[key] == runs[key]) & (kept[ts] == runs["_vstart"]), "left").drop(runs[key])
    for c in t1:  # every kept event starts its own run, so the join always matches
        out = out.withColumn(c, F.col(f"_t1.{c}"))
    return out.drop("_t1", "_vstart")
