"""The load journal: runs, loads, failures, several drivers, compaction; selected snapshots."""

import json

import pytest
from pyspark.sql import functions as F

from starling.plans.cli import main
from starling.plans.jobs import Lake, snapshot_tables
from starling.sinks.parquet import write_change_files
from starling.sinks.warehouse import LoadReport
from starling.sources.bronze import read_bronze
from starling.streaming.incremental import run_available_now
from starling.streaming.journal import Journal

REPORT = LoadReport("fact_orders", 5, 5, "append", "struct<a:int>", None, 2)


def stream(spark, root, *values):
    spark.createDataFrame([(v,) for v in values], "v string").coalesce(1).write.mode("append").parquet(root + "/in")
    return spark.readStream.schema("v string").option("maxFilesPerTrigger", 1).parquet(root + "/in")


def test_failed_run_is_followed_by_its_retry(spark, tmp_root):
    fail = [True]
    with Journal(spark, tmp_root + "/journal") as journal:
        def process(batch, batch_id):
            journal.load(REPORT, batch, batch_id)
            if fail.pop() if fail else False:
                raise RuntimeError("warehouse gone")

        s = stream(spark, tmp_root, "a")
        with pytest.raises(Exception, match="warehouse gone"):
            run_available_now(s, process, tmp_root + "/cp", "orders_job")
        journal.settle()
        assert [(r.batch_id, r.attempts, r.durable) for r in journal.loads().collect()] == [(0, 1, False)]
        stream(spark, tmp_root, "b")
        done = run_available_now(s, process, tmp_root + "/cp", "orders_job")
        journal.settle([done, None])
    runs = journal.runs().orderBy("run_number").collect()
    assert [(r.job, r.run_number, r.status, r.batches) for r in runs] == [("orders_job", 1, "failed", 0), ("orders_job", 2, "ended", 2)]
    assert "warehouse gone" in runs[0].error and runs[1].error is None and runs[0].stream_id == runs[1].stream_id
    loads = journal.loads().orderBy("batch_id").collect()
    assert [(r.batch_id, r.attempts, r.durable, r.rows_written, r.null_values) for r in loads] == [(0, 2, True, 5, 2), (1, 1, True, 5, 2)]
    assert loads[0].input_schema == "struct<a:int>"


def test_entries_of_several_drivers_outlive_compaction(spark, tmp_root):
    one, two = Journal(spark, tmp_root + "/j"), Journal(spark, tmp_root + "/j")
    assert one.entries().count() == 0 and one.runs().count() == 0 and one.loads().count() == 0 and one.compact() == 0
    for j, run in ((one, "r1"), (two, "r2")):
        j.append("started", job="silver_orders", stream_id="s", run_id=run)
    one.append("ended", job="silver_orders", stream_id="s", run_id="r1")
    rows = lambda: sorted((r.run_id, r.run_number, r.status) for r in two.runs().collect())
    assert rows() == [("r1", 1, "ended"), ("r2", 2, "open")]
    assert two.compact() == 3 and rows() == [("r1", 1, "ended"), ("r2", 2, "open")]
    two.append("failed", job="silver_orders", stream_id="s", run_id="r2", error="é lost\n\"x\"")
    assert rows() == [("r1", 1, "ended"), ("r2", 2, "failed")]
    # a compaction that died before it deleted: its entries are there twice
    two.entries().write.parquet(tmp_root + "/j/compacted/again")
    assert one.entries().count() == 4 and rows() == [("r1", 1, "ended"), ("r2", 2, "failed")]
    assert one.runs().where("run_id = 'r2'").first().error == "é lost\n\"x\""


def test_a_later_batch_makes_the_earlier_durable(spark, tmp_root):
    j = Journal(spark, tmp_root + "/j")
    for n in (0, 1):  # the driver died before the listener was told of either batch
        j.append("load", stream_id="s", batch_id=n, table_name="t", rows_written=n)
    assert {r.batch_id: r.durable for r in j.loads().collect()} == {0: True, 1: False}


def test_settle_gives_up(spark, tmp_root):
    j = Journal(spark, tmp_root + "/j")
    j.append("started", job="x", stream_id="s", run_id="never")
    with pytest.raises(TimeoutError, match="never"):
        j.settle(seconds=0.1)


def test_command_line_keeps_the_journal(spark, tmp_root, capsys):
    lake, wh = Lake(tmp_root), "wh_journal_" + tmp_root.rsplit("/", 1)[-1]
    cols = "op string, orderid string, ordercustomerid string, orderdate string, paymentmethod string, orderplatform string, dms_timestamp string"
    for n in range(3):
        rows = spark.createDataFrame([("I", str(n), "c", "1995-03-01 00:00:00", "card", "web", "2024-01-01 00:00:00")], cols)
        write_change_files(rows.coalesce(1), lake.bronze("orders"))
    assert main(["silver", "--root", tmp_root, "--table", "orders"], spark) == 0
    fact = ["fact", "--root", tmp_root, "--table", "orders", "--warehouse", wh, "--sketches", "--max-files", "1"]
    assert main(fact, spark) == 0
    assert main(["statistics", "--root", tmp_root, "--table", "orders", "--warehouse", wh], spark) == 0
    write_change_files(rows.drop("orderdate").coalesce(1), lake.bronze("orders"))
    assert main(["silver", "--root", tmp_root, "--table", "orders"], spark) == 1  # a file lacks a column
    assert main(["journal", "--root", tmp_root, "--compact"], spark) == 0
    out = [json.loads(x) for x in capsys.readouterr().out.strip().split("\n")]
    stats = {c["column_name"]: c for c in out[-2]["columns"]}
    assert (stats["order_id"]["rows"], stats["order_id"]["distinct_count"], stats["order_id"]["max_value"]) == (3, 3, "2")
    assert {(r["job"], r["status"]): r["count"] for r in out[-1]["runs"]} == {
        ("silver_orders", "ended"): 1, ("silver_orders", "failed"): 1, ("fact_orders", "ended"): 1}
    loads = Journal(spark, tmp_root + "/_journal").loads().collect()
    assert len(loads) >= 1 and sum(r.rows_written for r in loads) == 3 and all(r.durable for r in loads)
    spark.sql(f"DROP DATABASE `{wh}` CASCADE")


def test_snapshot_of_selected_tables(spark, tmp_root):
    lake, read = Lake(tmp_root), []

    def source(name):
        read.append(name)
        if name == "broken":
            raise RuntimeError("no such table")
        return spark.range(3).select(F.col("id").cast("string").alias("k"))

    names = ["orders", "order_details", "orderxdetails", "broken", "Customer"]
    assert sorted(snapshot_tables(lake, source, names, "order%")) == ["order_details", "orders", "orderxdetails"]
    assert snapshot_tables(lake, source, names, "ORDER!_details".replace("!", "")) == ["order_details", "orderxdetails"]
    assert read_bronze(spark, lake.bronze("order_details")).count() == 3
    assert "broken" not in read and "Customer" not in read
    with pytest.raises(ValueError, match="no source table"):
        snapshot_tables(lake, source, names, "none%")
    with pytest.raises(RuntimeError, match="no such table"):
        snapshot_tables(lake, source, ["broken", "Customer"])
    assert read_bronze(spark, lake.bronze("Customer")).count() == 3


def test_snapshot_arguments(spark, tmp_root):
    for args in (["--like", "x"], ["--table", "t"], ["--table", "t", "--like", "x", "--source-table", "t"], []):
        with pytest.raises(SystemExit):
            main(["snapshot", "--root", tmp_root, "--jdbc-url", "jdbc:none", *args], spark)
