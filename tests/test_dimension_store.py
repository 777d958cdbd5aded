"""Buckets that a batch does not touch, compaction of the history, vacuum."""

import pytest
from pyspark.sql import functions as F

from starling.operators.scd2 import CUSTOMER_DIM, batch_stats, scd2_merge
from starling.session import list_dir_names, list_names
from starling.sinks.dimension_store import DimensionStore, Manifest, bucket_of
from test_scd2 import changes_df, t

COLUMNS = ["customer_id", "hash_value", "record_start_ts", "record_end_ts", "active_flag"]


def rows_of(df):
    return sorted(map(tuple, df.select(*COLUMNS).collect()))


def segments(spark, root, batch, part="active"):
    return {int(n.split("=")[1]) for n in list_dir_names(spark, f"{root}/batches/batch_id={batch}/part={part}")}


def test_one_key_batch_reads_and_writes_one_bucket(spark, tmp_root):
    store = DimensionStore(spark, tmp_root, CUSTOMER_DIM, buckets=8)
    first = [("I", f"k{i}", "h1", t(1)) for i in range(200)]
    store.apply(changes_df(spark, first), 0)
    assert segments(spark, tmp_root, 0) == set(range(8))

    change = changes_df(spark, [("U", "k7", "h2", t(2))])
    bucket = change.select(bucket_of(CUSTOMER_DIM, 8)).first()[0]
    active, tombs = store.state(0, [bucket])
    merged = scd2_merge(active, tombs, change, CUSTOMER_DIM, out_partitions=8, has_state=True,
                        stats=batch_stats(change, CUSTOMER_DIM).checkpoint(eager=True))
    # the plan prunes the stored state to the bucket (that it is a bucketed scan: test_plans)
    plan = merged.rows._jdf.queryExecution().toString()
    scans = [line for line in plan.split("\n") if "FileScan" in line and f"{store.prefix}_b0" in line]
    assert scans and all("seg#" in line and f"= {bucket})" in line.split("PartitionFilters")[1] for line in scans), scans
    assert active.inputFiles() and all(f"seg={bucket}/" in f for f in active.inputFiles())
    assert active.count() < 60

    store.apply(change, 1)
    assert segments(spark, tmp_root, 1) == {bucket}
    held = store.manifest(1).segments["active"]
    assert held == {b: int(b == bucket) for b in range(8)}
    whole = DimensionStore(spark, tmp_root + "_whole", CUSTOMER_DIM)
    whole.apply(changes_df(spark, first + [("U", "k7", "h2", t(2))]), 0)
    assert rows_of(store.dimension()) == rows_of(whole.dimension())
    assert len(rows_of(store.dimension(as_of=0))) == 200


def test_bucket_without_open_versions_and_batch_without_keys(spark, tmp_root):
    store = DimensionStore(spark, tmp_root, CUSTOMER_DIM, buckets=4)
    store.apply(changes_df(spark, [("I", "a", "h", t(1))]), 0)
    store.apply(changes_df(spark, [("D", "a", "h", t(2))]), 1)
    assert store.manifest(1).segments["active"] == {} and len(store.manifest(1).segments["tombstones"]) == 1
    store.apply(changes_df(spark, [("U", None, "h", t(3))]), 2)  # no key: late, no bucket is touched
    assert store.manifest(2).segments == store.manifest(1).segments and store.late().count() == 1
    store.apply(changes_df(spark, [("I", "z", "h", t(1))]).where("false"), 3)
    assert store.manifest(3).segments == store.manifest(1).segments
    store.apply(changes_df(spark, [("U", "a", "h", t(2)), ("I", "a", "h", t(4))]), 4)  # the tombstone still bounds
    assert [(r.active_flag) for r in store.dimension().orderBy("record_start_ts").collect()] == [0, 1]
    assert store.late().count() == 2 and store.manifest(4).segments["tombstones"] == {}


def test_more_buckets_rewrite_all(spark, tmp_root):
    log = [("I", f"k{i}", "h1", t(1)) for i in range(50)]
    DimensionStore(spark, tmp_root, CUSTOMER_DIM, buckets=2).apply(changes_df(spark, log), 0)
    store = DimensionStore(spark, tmp_root, CUSTOMER_DIM, buckets=8)
    store.apply(changes_df(spark, [("U", "k1", "h2", t(2))]), 1)
    held = store.manifest(1)
    assert held.buckets == 8 and set(held.segments["active"].values()) == {1}
    assert store.dimension().count() == 51 and store.dimension().where("active_flag = 1").count() == 50


def test_history_of_many_batches_is_compacted(spark, tmp_root):
    """Fifty batches leave a bounded number of runs; readers of the old ones are undisturbed."""
    store = DimensionStore(spark, tmp_root, CUSTOMER_DIM, buckets=1, compact_at=4)
    log = [("U", f"k{i % 3}", f"h{i}", t(i + 1)) for i in range(50)]
    before = None
    for i, change in enumerate(log):
        if i == 20:
            store.compact_at = 1000  # collect runs, to compact them under an open reader
        store.apply(changes_df(spark, [change]), i)
        if i == 30:
            reader, files = store.dimension(), store.dimension().inputFiles()
            before, store.compact_at = rows_of(reader), 4
            merged = store.compact()
            assert merged and store.manifest(i).revision >= 1
            assert rows_of(reader) == before == rows_of(store.dimension())
            assert len(store.dimension().inputFiles()) < len(files)
    runs = [r for r in store.manifest(49).runs if r.part == "closed"]
    assert len(runs) <= 3 * 4 and sum(r.last - r.first + 1 for r in runs) >= 47
    assert sum("/closed/" in f or "part=closed" in f for f in store.dimension().inputFiles()) <= 3 * 4
    whole = DimensionStore(spark, tmp_root + "_whole", CUSTOMER_DIM)
    whole.apply(changes_df(spark, log), 0)
    assert rows_of(store.dimension()) == rows_of(whole.dimension())

    spark.range(1).select(F.lit(1).alias("x")).write.parquet(tmp_root + "/history/closed/run=failed")
    removed = store.vacuum(keep=1)
    assert tmp_root + "/history/closed/run=failed" in removed
    assert store.committed() == [49] and len(list_names(spark, tmp_root + "/manifests")) <= 2  # and its checksum
    assert rows_of(store.dimension()) == rows_of(whole.dimension())
    with pytest.raises(ValueError):
        store.dimension(as_of=30)
    store.apply(changes_df(spark, [("U", "k0", "new", t(55))]), 50)
    assert store.dimension().count() == whole.dimension().count() + 1


def test_manifest_text_round_trip(spark, tmp_root):
    store = DimensionStore(spark, tmp_root, CUSTOMER_DIM, buckets=4)
    store.apply(changes_df(spark, [("I", "a", "h", t(1)), ("U", "a", "g", t(2))]), 0)
    held = store.manifest(0)
    assert Manifest.loads(held.dumps()) == held and held.active_bytes() > 0
    with pytest.raises(ValueError):
        store.manifest(1)
    with pytest.raises(ValueError):
        DimensionStore(spark, tmp_root, CUSTOMER_DIM, compact_at=1)
