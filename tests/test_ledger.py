"""The fenced commit ledger: lost, reset, doubled and set-back checkpoints."""

import pytest
from pyspark.sql import functions as F

from starling.plans.jobs import FACT_JOBS, Lake, start_fact_job, start_silver_job
from starling.session import delete_path
from starling.sinks.ledger import CommitLedger, FencedError, RestartedBatchError, apply_once, with_file_column
from starling.sinks.parquet import read_partitioned, write_change_files
from starling.sinks.warehouse import Warehouse
from starling.schemas import SILVER_ORDERS
from starling.streaming.incremental import await_all

TS = "2024-01-05 00:00:00"


def drop(spark, lake, ids, by_folder=None):
    rows = spark.createDataFrame(
        [("I", str(i), "c", "1995-03-0%d 00:00:00" % (1 + i % 9), "card", "web", TS) for i in ids],
        "op string, orderid string, ordercustomerid string, orderdate string, paymentmethod string, orderplatform string, dms_timestamp string")
    write_change_files(rows.coalesce(1), lake.bronze("orders"))


def silver_ids(spark, lake):
    return sorted(int(r.order_id) for r in read_partitioned(spark, lake.silver("orders"), SILVER_ORDERS).collect())


def retention(spark, lake):
    delete_path(spark, lake.bronze("orders"))


@pytest.mark.parametrize("by_name", [False, True])
def test_silver_keeps_every_row_when_its_checkpoint_is_lost(spark, tmp_root, by_name):
    lake = Lake(tmp_root)
    run = lambda: await_all([start_silver_job(spark, lake, "orders", TS, by_name=by_name)])
    drop(spark, lake, range(0, 3))
    run()
    drop(spark, lake, range(10, 13))
    run()
    delete_path(spark, lake.checkpoint("silver", "orders"))
    drop(spark, lake, range(20, 23))  # the old files are still there
    run()
    assert silver_ids(spark, lake) == [0, 1, 2, 10, 11, 12, 20, 21, 22]
    delete_path(spark, lake.checkpoint("silver", "orders"))
    retention(spark, lake)
    drop(spark, lake, range(30, 33))  # the old files are gone
    run()
    run()
    assert silver_ids(spark, lake) == [0, 1, 2, 10, 11, 12, 20, 21, 22, 30, 31, 32]
    ledger = lake.silver_ledger(spark, "orders")
    files = ledger.files().collect()
    assert len(files) == 4 and len({r.file for r in files}) == 4 and len({r.stream_id for r in files}) == 3


def test_facts_load_every_file_once_when_their_checkpoint_is_lost(spark, tmp_root):
    lake, wh = Lake(tmp_root), Warehouse(spark, "ledger_facts", tmp_root + "/wh")
    fact = FACT_JOBS["orders"][0]

    def run():
        await_all([start_silver_job(spark, lake, "orders", TS)])
        await_all([start_fact_job(spark, lake, wh, "orders", max_files_per_trigger=1)])
        return sorted(int(r.order_id) for r in wh.table(fact).collect())

    drop(spark, lake, range(0, 3))
    drop(spark, lake, range(10, 13))
    assert run() == [0, 1, 2, 10, 11, 12]
    delete_path(spark, lake.checkpoint("fact", "orders"))
    drop(spark, lake, range(20, 23))
    assert run() == [0, 1, 2, 10, 11, 12, 20, 21, 22]
    delete_path(spark, lake.checkpoint("fact", "orders"))
    assert run() == [0, 1, 2, 10, 11, 12, 20, 21, 22]
    wh.drop_load(fact, wh.newest_load(fact))
    assert len(wh.table(fact).collect()) < 9
    spark.sql("DROP DATABASE ledger_facts CASCADE")


def test_fact_batch_replayed_after_the_table_was_read(spark, tmp_root):
    """The load runs in the stream's session, the statistics in the warehouse's."""
    wh = Warehouse(spark, "ledger_replay", tmp_root + "/wh")
    name, schema = FACT_JOBS["orders"]
    other = spark.newSession()
    rows = other.createDataFrame([("1", "c", None, "card", "web", 1995, 3, None)], schema)
    for _ in range(3):
        assert wh.load(rows, name, schema, mode="append", load_id=0).rows_written == 1
        assert wh.count(name) == 1 and other.table(wh.qualified(name)).count() == 1
    spark.sql("DROP DATABASE ledger_replay CASCADE")


class Target:
    """Batches as files of a folder; the batch frames as Parquet scans."""

    def __init__(self, spark, root):
        self.spark, self.root = spark, root
        self.ledger = CommitLedger(spark, root + "/ledger", lambda n: delete_path(spark, f"{root}/out/{n}"))

    def batch(self, *names):
        for n in names:
            self.spark.createDataFrame([(n,)], "v string").coalesce(1).write.mode("ignore").parquet(f"{self.root}/in/{n}")
        return with_file_column(self.spark.read.parquet(*[f"{self.root}/in/{n}" for n in names]))

    def apply(self, stream, batch_id, *names, fail=False):
        def write(rows, commit_id):
            files = [r[0] for r in rows.select("_source_file").distinct().collect()]
            rows.select("v").write.mode("overwrite").parquet(f"{self.root}/out/{commit_id}")
            if fail:
                raise RuntimeError("lost before the commit")
            return files

        return apply_once(self.ledger, self.batch(*names), stream, batch_id, write)

    def rows(self):
        return sorted(r.v for r in self.spark.read.parquet(f"{self.root}/out/*").collect())


def test_replay_is_written_once(spark, tmp_root):
    t = Target(spark, tmp_root)
    with pytest.raises(RuntimeError):
        t.apply("s1", 0, "a", "b", fail=True)
    assert t.apply("s1", 0, "a", "b").commit_id == 0
    assert t.apply("s1", 0, "a", "b") is None  # committed before
    assert t.apply("s1", 1, "c").commit_id == 1
    assert t.rows() == ["a", "b", "c"] and t.ledger.committed() == [0, 1]


def test_open_claim_of_a_lost_stream_is_rolled_back(spark, tmp_root):
    t = Target(spark, tmp_root)
    t.apply("s1", 0, "a")
    with pytest.raises(RuntimeError):
        t.apply("s1", 1, "b", fail=True)  # written, never committed, then the checkpoint is lost
    assert t.apply("s2", 0, "a", "b", "c").commit_id == 2
    assert t.rows() == ["a", "b", "c"]
    assert sorted(r.file.split("/in/")[1][0] for r in t.ledger.files().collect()) == ["a", "b", "c"]


def test_replaced_stream_is_fenced(spark, tmp_root):
    t = Target(spark, tmp_root)
    t.apply("s1", 0, "a")
    t.apply("s2", 0, "a", "b")
    with pytest.raises(FencedError):
        t.apply("s1", 1, "c")
    # replaced between its claim and its commit
    slot = t.ledger.begin("s2", 1)
    t.batch("d").select("v").write.parquet(f"{tmp_root}/out/{slot.commit_id}")
    t.apply("s3", 0, "a", "b", "d")
    with pytest.raises(FencedError):
        t.ledger.commit(slot, ["d"])
    assert t.rows() == ["a", "b", "d"]


def test_checkpoint_set_back_is_refused(spark, tmp_root):
    t = Target(spark, tmp_root)
    t.apply("s1", 0, "a")
    t.apply("s1", 1, "b")
    with pytest.raises(RestartedBatchError):
        t.apply("s1", 1, "c")  # the restored log gives id 1 to a file that came later
    assert t.apply("s2", 0, "a", "b", "c").commit_id == 2 and t.rows() == ["a", "b", "c"]


def test_target_filled_before_it_had_a_ledger(spark, tmp_root):
    lake = Lake(tmp_root)
    drop(spark, lake, range(3))
    await_all([start_silver_job(spark, lake, "orders", TS)])
    delete_path(spark, f"{tmp_root}/_ledger")
    drop(spark, lake, range(10, 13))
    await_all([start_silver_job(spark, lake, "orders", TS)])  # its checkpoint goes on with batch 1
    assert silver_ids(spark, lake) == [0, 1, 2, 10, 11, 12]
    delete_path(spark, f"{tmp_root}/_ledger")
    delete_path(spark, lake.checkpoint("silver", "orders"))
    with pytest.raises(Exception, match="no ledger tells"):
        await_all([start_silver_job(spark, lake, "orders", TS)])
    assert silver_ids(spark, lake) == [0, 1, 2, 10, 11, 12]


def test_files_are_named_as_the_scan_names_them(spark, tmp_root):
    spark.range(3).write.parquet(tmp_root + "/x y%z")
    names = with_file_column(spark.read.parquet(tmp_root + "/x y%z")).select(F.col("_source_file")).distinct().collect()
    assert names and all(n[0].startswith("file:") for n in names)
