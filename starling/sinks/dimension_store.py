"""Versioned dimension on plain Parquet (no table format with MERGE needed).

Layout below ``root``::

    batches/batch_id=<n>/part=active/seg=<b>/       open versions of bucket b, as batch n left them
    batches/batch_id=<n>/part=tombstones/seg=<b>/   deleted keys of bucket b, as batch n left them
    batches/batch_id=<n>/part=closed/seg=-1/        versions closed by batch n
    batches/batch_id=<n>/part=late/seg=-1/          changes of batch n not applied
    history/<closed or late>/run=<id>/              several batches' parts, merged by ``compact``
    manifests/<n>.<revision>.json                   what the dimension consists of after batch n

A key's bucket is the hash that Spark buckets by. A batch reads the buckets
that can hold one of its keys, merges them (``scd2_merge``) and writes those
buckets, so its cost goes with the buckets it touches, not with the active set;
the other buckets stay in the folders of the batches that wrote them. The
manifest of a batch names the folder of every bucket and the parts of the
history; it appears by a rename and is the commit. A crash before it leaves the
previous state untouched; a replayed batch recomputes from the same base and
replaces its own folder, so applying a batch twice is harmless.

The state after batch n is declared as a catalog table partitioned by
(``part``, ``seg``) and **bucketed by the dimension key**, each partition at the
folder that the manifest names: pruning by ``seg`` leaves the touched buckets,
and the scan is bucketed, so the match shuffles only the batch keys, never the
dimension. The merge partitions its batch-sized outputs into the same buckets.
The bucket count only grows (a batch that needs more reads and rewrites all).

Closed versions and late changes are appended per batch and merged in size
tiers: ``compact_at`` runs whose bytes have the same magnitude become one run,
in files of the advisory size, committed as a new revision of the manifest. So
a row is rewritten a logarithmic number of times and the number of runs is
logarithmic too. Readers of an older revision keep their files until ``vacuum``.
One writer at a time: ``apply``, ``compact`` and ``vacuum`` of one store do not
run at once.
"""

from __future__ import annotations

import hashlib
import json
import math
import uuid
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from starling.operators.scd2 import (
    DEFAULT_MAX_GROUP_ROWS,
    DimensionSpec,
    MergeResult,
    batch_stats,
    empty_dimension,
    empty_frame,
    empty_tombstones,
    late_schema,
    row_schema,
    scd2_merge,
    tombstone_schema,
)
from starling.session import (
    conf_bytes,
    content_bytes,
    delete_path,
    list_dir_names,
    list_names,
    make_dirs,
    path_exists,
    read_text,
    shared_root,
    write_text,
)

#: Most buckets of a batch's table.
MAX_BUCKETS = 1 << 14
#: Parts that are kept per bucket, and parts that are appended per batch.
STATE_PARTS, HISTORY_PARTS = ("active", "tombstones"), ("closed", "late")
#: Runs of one magnitude that are merged into one.
COMPACT_AT = 8
#: Partitions named in one statement.
PARTITIONS_AT_ONCE = 500


@dataclass(frozen=True)
class Run:
    """Closed versions or late changes of the batches ``first`` to ``last``."""

    part: str
    path: str
    bytes: int
    first: int
    last: int


@dataclass(frozen=True)
class Manifest:
    """What the dimension consists of after ``batch``: the batch whose folder
    holds each bucket of the state (a bucket without rows is absent), the runs
    of the history, and the bytes of open versions that each batch wrote."""

    batch: int
    revision: int
    buckets: int
    segments: dict[str, dict[int, int]]
    runs: list[Run] = field(default_factory=list)
    written: dict[int, dict[str, int]] = field(default_factory=dict)

    def dumps(self) -> str:
        return json.dumps(asdict(self), sort_keys=True)

    @staticmethod
    def loads(text: str) -> "Manifest":
        d = json.loads(text)
        d["segments"] = {p: {int(b): int(n) for b, n in held.items()} for p, held in d["segments"].items()}
        d["written"] = {int(n): w for n, w in d["written"].items()}
        d["runs"] = [Run(**r) for r in d["runs"]]
        return Manifest(**d)

    def active_bytes(self) -> int:
        """About the stored bytes of the open versions: of each batch's, the
        share of its buckets that no later batch has rewritten."""
        held: dict[int, int] = {}
        for n in self.segments["active"].values():
            held[n] = held.get(n, 0) + 1
        return sum(self.written[n]["bytes"] * k // max(self.written[n]["segments"], 1) for n, k in held.items())


def bucket_of(spec: DimensionSpec, buckets: int) -> Column:
    """The bucket that Spark's bucketed writer gives a key (of the stored type)."""
    return F.pmod(F.hash(F.col(spec.key).cast(spec.schema[spec.key].dataType)), F.lit(buckets))


def magnitude(size: int, base: int) -> int:
    return int(math.log(max(size, 1), base))


def estimated_bytes(df: DataFrame) -> int:
    """Bytes of the scans below a frame, as the optimizer knows them (0 where
    it does not)."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size())]
    return sum(n for n in sizes if n < 1 << 62)


class RestartedBatchError(ValueError):
    """A batch id that is older than the newest commit, or the newest commit's
    id with another input: the stream's checkpoint was lost or reset."""


class DimensionStore:
    def __init__(self, spark: SparkSession, root: str, spec: DimensionSpec, buckets: int | None = None,
                 compact_at: int = COMPACT_AT):
        """``buckets`` fixes the bucket count; by default it follows the size
        of the active set (see ``bucket_count``). ``compact_at`` (2 or more):
        runs of one magnitude that are merged."""
        if compact_at < 2:
            raise ValueError("compact_at must be at least 2")
        self.spark, self.root, self.spec, self.compact_at = spark, root.rstrip("/"), spec, compact_at
        self.fixed_buckets = buckets
        self.buckets = buckets or self.bucket_count(None)
        self.row_schema = row_schema(spec)
        self.prefix = f"starling_{spec.name}_{hashlib.sha1(self.root.encode()).hexdigest()[:12]}"

    def bucket_count(self, base: Manifest | None, batch_bytes: int = 0) -> int:
        """Buckets for the next batch, from sizes that are known beforehand: the
        stored active set of the base batch plus the batch itself (the
        optimizer's sizes of its scans) over the advisory partition size
        (AQE's target task size), at least the default parallelism, rounded up
        to a power of two, and never fewer than the base has, so the
        count rarely changes (a batch that changes it rewrites every bucket)."""
        if self.fixed_buckets:
            return int(self.fixed_buckets)
        floor = max(1, self.spark.sparkContext.defaultParallelism)
        target = conf_bytes(self.spark, "spark.sql.adaptive.advisoryPartitionSizeInBytes", "64m")
        stored = batch_bytes + (base.active_bytes() if base else 0)
        n = min(max(floor, -(-stored // max(target, 1))), MAX_BUCKETS)
        return max(1 << (n - 1).bit_length(), base.buckets if base else 1)

    # ------------------------------------------------------------ tables
    def _layout(self, batch_id: int) -> int | None:
        """Bucket count a batch was (or is being) written with: recorded as a
        folder name ``layout/batch_id=<n>/buckets=<B>`` before its data."""
        for name in list_dir_names(self.spark, f"{self.root}/layout/batch_id={int(batch_id)}"):
            if name.startswith("buckets="):
                return int(name.split("=", 1)[1])
        return None

    def _folder(self, batch_id: int, part: str, seg: int) -> str:
        return f"{self.root}/batches/batch_id={int(batch_id)}/part={part}/seg={seg}"

    def _declare(self, table: str, location: str, buckets: int) -> None:
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString().upper()}" for f in self.row_schema.fields)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS `{table}` ({cols}, `part` STRING, `seg` INT) USING parquet "
            f"PARTITIONED BY (`part`, `seg`) CLUSTERED BY (`{self.spec.key}`) INTO {buckets} BUCKETS "
            f"LOCATION '{location}'"
        )

    def _write_table(self, batch_id: int) -> str:
        """The bucketed table over one batch's own folder (with the parts that
        a failed attempt left there, so that an overwrite removes them)."""
        table, location = f"{self.prefix}_w{int(batch_id)}", f"{self.root}/batches/batch_id={int(batch_id)}"
        buckets = self._layout(batch_id)
        if buckets is None:
            raise ValueError(f"batch {batch_id} of {self.root} has no recorded bucket layout")
        if not self.spark.catalog.tableExists(table):
            had_data = path_exists(self.spark, location)
            make_dirs(self.spark, location)
            self._declare(table, location, buckets)
            if had_data:
                self.spark.sql(f"ALTER TABLE `{table}` RECOVER PARTITIONS")
        return table

    def _state_table(self, state: Manifest, touched: list[int] | None) -> str:
        """The state after a batch as a bucketed table, its partitions (of the
        ``touched`` buckets) at the folders of the batches that wrote them."""
        table = f"{self.prefix}_b{state.batch}"
        location = f"{self.root}/state/batch_id={state.batch}"
        make_dirs(self.spark, location)
        self._declare(table, location, state.buckets)
        wanted = None if touched is None else set(touched)
        specs = [f"PARTITION (part='{part}', seg={b}) LOCATION '{self._folder(n, part, b)}'"
                 for part in STATE_PARTS for b, n in sorted(state.segments[part].items())
                 if wanted is None or b in wanted]
        for i in range(0, len(specs), PARTITIONS_AT_ONCE):
            self.spark.sql(f"ALTER TABLE `{table}` ADD IF NOT EXISTS {' '.join(specs[i:i + PARTITIONS_AT_ONCE])}")
        return table

    # ------------------------------------------------------------ manifests
    def _revisions(self) -> dict[int, int]:
        """Newest manifest revision of each committed batch (one listing)."""
        newest: dict[int, int] = {}
        for name in list_names(self.spark, f"{self.root}/manifests"):
            if name.endswith(".json") and not name.startswith((".", "_")):
                n, revision = map(int, name.split(".")[:2])
                newest[n] = max(revision, newest.get(n, -1))
        return newest

    def manifest(self, batch_id: int) -> Manifest:
        revisions = self._revisions()
        if batch_id not in revisions:
            raise ValueError(f"batch {batch_id} of {self.root} is not committed, or its state was vacuumed")
        return Manifest.loads(read_text(self.spark, f"{self.root}/manifests/{batch_id}.{revisions[batch_id]}.json"))

    def _commit(self, state: Manifest) -> Manifest:
        """Publish a manifest as the newest revision of its batch."""
        state = replace(state, revision=self._revisions().get(state.batch, -1) + 1)
        make_dirs(self.spark, f"{self.root}/manifests")
        write_text(self.spark, f"{self.root}/manifests/{state.batch}.{state.revision}.json", state.dumps())
        return state

    # ------------------------------------------------------------ reading
    def committed(self) -> list[int]:
        """Committed batch ids that were not vacuumed."""
        return sorted(self._revisions())

    def last_committed(self, below: int | None = None) -> int | None:
        """Newest committed batch id (optionally below ``below``)."""
        ids = [b for b in self.committed() if below is None or b < below]
        return ids[-1] if ids else None

    def state(self, batch_id: int | None, touched: list[int] | None = None) -> tuple[DataFrame, DataFrame]:
        """(active, tombstones) as of committed batch ``batch_id``, of all
        buckets or of the ``touched`` ones."""
        if batch_id is None or touched == []:
            return empty_dimension(self.spark, self.spec), empty_tombstones(self.spark, self.spec)
        held = self.manifest(batch_id)
        rows = self.spark.table(self._state_table(held, touched))
        if touched is not None and len(touched) < held.buckets:
            rows = rows.where(F.col("seg").isin(sorted(touched)))
        return (rows.where(F.col("part") == "active").select(*self.spec.columns),
                rows.where(F.col("part") == "tombstones").select(*tombstone_schema(self.spec).fieldNames()))

    def _rows(self, folders: list[str], cols: list[str]) -> DataFrame:
        if not folders:
            return empty_frame(self.spark, self.row_schema).select(*cols)
        return self.spark.read.schema(self.row_schema).parquet(*folders).select(*cols)

    def _history(self, held: Manifest, part: str) -> list[str]:
        return [f"{self.root}/{r.path}" for r in held.runs if r.part == part]

    def dimension(self, as_of: int | None = None) -> DataFrame:
        """All versions as of a committed batch (the newest): the buckets and
        runs that its manifest names."""
        n = self.last_committed() if as_of is None else as_of
        if n is None:
            return empty_dimension(self.spark, self.spec)
        held = self.manifest(n)
        buckets = [self._folder(b, "active", seg) for seg, b in sorted(held.segments["active"].items())]
        return self._rows(buckets + self._history(held, "closed"), self.spec.columns)

    def late(self, as_of: int | None = None) -> DataFrame:
        n = self.last_committed() if as_of is None else as_of
        folders = [] if n is None else self._history(self.manifest(n), "late")
        return self._rows(folders, late_schema(self.spec).fieldNames())

    # ------------------------------------------------------------ housekeeping
    def compact(self) -> list[Run]:
        """Merge ``compact_at`` or more runs of one part and magnitude into one,
        until there are fewer of each; publish them at once as a new revision
        of the newest manifest. The old runs stay for their readers until
        ``vacuum``. Returns the new runs that are in use."""
        n = self.last_committed()
        if n is None:
            return []
        held = self.manifest(n)
        runs, merged = list(held.runs), set()
        target = conf_bytes(self.spark, "spark.sql.adaptive.advisoryPartitionSizeInBytes", "64m")
        for part in HISTORY_PARTS:
            while True:
                tiers: dict[int, list[Run]] = {}
                for r in runs:
                    if r.part == part:
                        tiers.setdefault(magnitude(r.bytes, self.compact_at), []).append(r)
                full = [t for t in sorted(tiers) if len(tiers[t]) >= self.compact_at]
                if not full:
                    break
                group = tiers[full[0]]
                path = f"history/{part}/run={uuid.uuid4().hex}"
                files = max(1, -(-sum(r.bytes for r in group) // max(target, 1)))
                # whole files change hands: fewer scan tasks, no shuffle
                (self.spark.read.schema(self.row_schema).parquet(*[f"{self.root}/{r.path}" for r in group])
                 .coalesce(files).write.mode("overwrite").parquet(f"{self.root}/{path}"))
                run = Run(part, path, content_bytes(self.spark, f"{self.root}/{path}"),
                          min(r.first for r in group), max(r.last for r in group))
                runs = [r for r in runs if r not in group] + [run]
                merged.add(path)
        if not merged:
            return []
        self._commit(replace(held, runs=sorted(runs, key=lambda r: (r.part, r.first, r.last))))
        return [r for r in runs if r.path in merged]

    def vacuum(self, keep: int = 2) -> list[str]:
        """Delete what none of the newest ``keep`` committed batches consists
        of: buckets that were rewritten since, runs that were merged, runs of a
        compaction that failed, and the manifests of older batches. Returns
        the removed folders."""
        revisions = self._revisions()
        kept = sorted(revisions, reverse=True)[:max(keep, 1)]
        if not kept:
            return []
        held = [self.manifest(n) for n in kept]
        used = {self._folder(n, part, b) for m in held for part in STATE_PARTS for b, n in m.segments[part].items()}
        used |= {f"{self.root}/{r.path}" for m in held for r in m.runs}
        for name in list_names(self.spark, f"{self.root}/manifests"):  # first, so that no reader finds half a state
            n, revision = name.split(".")[:2] if name.endswith(".json") else ("", "")
            if n.isdigit() and (int(n) not in kept or int(revision) < revisions[int(n)]):
                delete_path(self.spark, f"{self.root}/manifests/{name}")
        parts = []
        for name in list_dir_names(self.spark, f"{self.root}/batches"):
            n = int(name.split("=", 1)[1])
            if n > kept[0]:
                continue  # being written
            if n not in kept:
                for table in (f"{self.prefix}_b{n}", f"{self.prefix}_w{n}"):
                    self.spark.sql(f"DROP TABLE IF EXISTS `{table}`")
            folder = f"{self.root}/batches/{name}"
            parts += [f"{folder}/{p}" for p in list_dir_names(self.spark, folder) if p.startswith("part=")]
        parts += [f"{self.root}/history/{p}" for p in list_dir_names(self.spark, f"{self.root}/history")]
        removed = []
        for path in parts:
            inside = [f"{path}/{name}" for name in list_dir_names(self.spark, path)]
            unused = [p for p in inside if p not in used]
            removed += [path] if inside and len(unused) == len(inside) else unused
        for path in removed:
            delete_path(self.spark, path)
        return removed

    # ------------------------------------------------------------ writing
    def check_order(self, batch_id: int, source: str | None) -> None:
        """Refuse a batch id that restarted. The newest committed batch may be
        applied again (a replay after a crash between its commit and the
        stream's), but only from the same source (stream checkpoint)."""
        newest = self.last_committed()
        if newest is None or batch_id > newest:
            return
        if batch_id < newest:
            raise RestartedBatchError(f"batch {batch_id} of {self.root} is older than its newest commit {newest}")
        known = self.commit_source(batch_id)
        if known and source and known != source:
            raise RestartedBatchError(f"batch {batch_id} of {self.root} was committed by {known}, not by {source}")

    def commit_source(self, batch_id: int) -> str | None:
        """The source recorded with a commit, as a folder name (no job)."""
        for name in list_dir_names(self.spark, f"{self.root}/layout/batch_id={int(batch_id)}"):
            if name.startswith("source="):
                return name.split("=", 1)[1]
        return None

    def apply(self, changes: DataFrame, batch_id: int, max_group_rows: int = DEFAULT_MAX_GROUP_ROWS,
              source: str | None = None) -> MergeResult:
        """Merge one batch of silver changes and commit it as ``batch_id``.
        ``source`` names where the batch ids come from (a stream's id)."""
        self.check_order(batch_id, source)
        base = self.last_committed(below=batch_id)
        held = None if base is None else self.manifest(base)
        # a replay keeps the layout of its first attempt
        self.buckets = self._layout(batch_id) or self.bucket_count(held, estimated_bytes(changes))
        if source:
            make_dirs(self.spark, f"{self.root}/layout/batch_id={int(batch_id)}/source={source}")
        make_dirs(self.spark, f"{self.root}/layout/batch_id={int(batch_id)}/buckets={self.buckets}")
        stats, touched = None, None
        if held:
            shared_root(self.spark)
            stats = batch_stats(changes, self.spec).checkpoint(eager=True)
            if held.buckets == self.buckets:  # at most MAX_BUCKETS numbers
                touched = [r[0] for r in stats.select(bucket_of(self.spec, self.buckets)).distinct().collect()]
        active, tombs = self.state(base, touched)
        result = scd2_merge(active, tombs, changes, self.spec, max_group_rows=max_group_rows,
                            out_partitions=self.buckets, has_state=base is not None, stats=stats)
        self.write(result, batch_id)
        self._commit(self._after(held, batch_id, touched))
        for table in (f"{self.prefix}_b{base}", f"{self.prefix}_b{batch_id}", f"{self.prefix}_w{batch_id}"):
            self.spark.sql(f"DROP TABLE IF EXISTS `{table}`")  # external: the definition goes, the files stay
        self.compact()
        return result

    def _after(self, held: Manifest | None, batch_id: int, touched: list[int] | None) -> Manifest:
        """The manifest after a written batch: its buckets in place of the
        touched ones (``None``: of all), its closed and late rows as runs."""
        folder = f"batches/batch_id={int(batch_id)}"
        segments = {}
        for part in STATE_PARTS:
            own = [int(n.split("=", 1)[1]) for n in list_dir_names(self.spark, f"{self.root}/{folder}/part={part}")]
            rewritten = set(touched or ())
            segments[part] = {b: n for b, n in held.segments[part].items() if b not in rewritten} \
                if held and touched is not None else {}
            segments[part].update({b: batch_id for b in own})
        runs = list(held.runs) if held else []
        for part in HISTORY_PARTS:
            path = f"{folder}/part={part}/seg=-1"
            if path_exists(self.spark, f"{self.root}/{path}"):
                runs.append(Run(part, path, content_bytes(self.spark, f"{self.root}/{path}"), batch_id, batch_id))
        live = set(segments["active"].values())
        written = {n: w for n, w in (held.written if held else {}).items() if n in live and n != batch_id}
        written[batch_id] = {"bytes": content_bytes(self.spark, f"{self.root}/{folder}/part=active"),
                             "segments": sum(n == batch_id for n in segments["active"].values())}
        return Manifest(batch_id, 0, self.buckets, segments, runs, written)

    def write(self, result: MergeResult, batch_id: int) -> None:
        """All parts of one batch in one job; replaces that batch's folder."""
        if self._layout(batch_id) is None:
            make_dirs(self.spark, f"{self.root}/layout/batch_id={int(batch_id)}/buckets={self.buckets}")
        table = self._write_table(batch_id)
        seg = F.when(F.col("part").isin(*STATE_PARTS), bucket_of(self.spec, self._layout(batch_id))).otherwise(-1)
        # static: parts that a failed attempt left behind go, whatever the session's mode
        (result.rows.select(*[f.name for f in self.row_schema.fields], "part", seg.cast("int").alias("seg")).write
         .option("partitionOverwriteMode", "static").insertInto(f"`{table}`", overwrite=True))
