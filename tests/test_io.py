"""Sources and sinks: change files, catalog registration, silver layout,
warehouse loads, incremental jobs and the pipeline."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from starling.plans.jobs import Lake, silver_read_schema, start_silver_job
from starling.schemas import FACT_ORDERS, STAGE_DIM_CUSTOMER
from starling.sinks.jdbc import text_key_predicates, writer_options
from starling.sinks.parquet import write_change_files, write_partitioned
from starling.sinks.warehouse import SchemaMismatchError, Warehouse, conform
from starling.sources.bronze import header_schema, read_bronze, register_raw_table, select_tables
from starling.streaming.incremental import await_all
from starling.sources.testtables import customer_changes, order_changes
from conftest import SF_SMALL


def test_change_files_round_trip_by_header(spark, tmp_root):
    src = customer_changes(spark, SF_SMALL)
    path = f"{tmp_root}/customer"
    write_change_files(src, path, mode="overwrite")
    assert header_schema(spark, path).fieldNames() == src.columns
    back = read_bronze(spark, path)
    assert back.count() == src.count()
    assert back.exceptAll(src).count() == 0
    name = register_raw_table(spark, "customer", path)
    assert spark.table(name).count() == src.count()


def test_header_drift_fails_the_scan(spark, tmp_root):
    path = f"{tmp_root}/drift"
    df = spark.createDataFrame(pd.DataFrame({"op": ["I"], "a": ["1"]}))
    write_change_files(df, path)
    write_change_files(df.select("a", "op"), path)  # second file: columns moved
    with pytest.raises(Exception):
        read_bronze(spark, path).collect()


def test_select_tables_like():
    assert select_tables(["Customer", "Orders", "orderDetails"], "order%") == ["Orders", "orderDetails"]
    assert select_tables(["a", "b"]) == ["a", "b"]


def test_partitioned_write_is_sorted_within_files(spark, tmp_root):
    from starling.operators.silver import silver_orders
    s = silver_orders(order_changes(spark, SF_SMALL), run_ts="2024-01-05 00:00:00")
    path = f"{tmp_root}/orders"
    write_partitioned(s, path, "order_year_pk", "order_date", mode="overwrite")
    back = spark.read.parquet(path)
    assert back.count() == s.count()
    per_file = back.withColumn("f", F.input_file_name()).groupBy("f").agg(
        F.collect_list("order_date").alias("d"), F.countDistinct("order_year_pk").alias("y"))
    for r in per_file.collect():
        assert r.y == 1 and r.d == sorted(r.d, reverse=True)


def test_warehouse_truncate_and_replay_safe_append(spark, tmp_root):
    wh = Warehouse(spark, "wh_test_" + tmp_root.rsplit("/", 1)[-1], f"{tmp_root}/wh")
    from starling.operators.silver import silver_orders
    s = silver_orders(order_changes(spark, SF_SMALL), run_ts="2024-01-05 00:00:00")
    n = s.count()
    r1 = wh.load(s, "fact_orders", FACT_ORDERS, mode="append", load_id=0)
    r2 = wh.load(s, "fact_orders", FACT_ORDERS, mode="append", load_id=0)   # replay
    assert (r1.rows_read, r2.rows_written) == (n, n)
    wh.load(s, "fact_orders", FACT_ORDERS, mode="append", load_id=1)         # next batch
    assert wh.count("fact_orders") == 2 * n
    assert wh.load(s, "fact_orders", FACT_ORDERS, mode="append", load_id=1).rows_written == n
    plain = wh.load(s, "fact_plain", FACT_ORDERS, mode="truncate_load", analyze="columns")
    plain = wh.load(s, "fact_plain", FACT_ORDERS, mode="truncate_load")
    assert plain.rows_written == n
    stats = spark.sql(f"DESCRIBE TABLE EXTENDED {wh.qualified('fact_plain')}").where("col_name = 'Statistics'")
    assert "rows" in stats.first().data_type
    wh.truncate("fact_plain")                                               # K6 on its own
    assert wh.count("fact_plain") == 0 and spark.catalog.tableExists(f"{wh.name}.fact_plain")


def test_conform_projects_by_name_and_rejects_missing(spark):
    df = spark.range(1).select(F.lit("x").alias("ORDER_ID"), F.lit(1).alias("extra"))
    with pytest.raises(SchemaMismatchError):
        conform(df, FACT_ORDERS)
    ok = spark.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in STAGE_DIM_CUSTOMER.fields],
                               F.lit(1).alias("extra"))
    assert conform(ok, STAGE_DIM_CUSTOMER).columns == STAGE_DIM_CUSTOMER.fieldNames()


def test_jdbc_writer_options():
    mode, opts = writer_options("jdbc:x://h/db", "sales.fact_orders", "truncate_load", "order_id VARCHAR(50)")
    assert mode == "overwrite" and opts["truncate"] == "true" and "createTableColumnTypes" in opts
    mode, opts = writer_options("jdbc:x://h/db", "sales.fact_orders", "append")
    assert mode == "append" and "truncate" not in opts


def test_incremental_job_reads_only_new_files(spark, tmp_root):
    lake = Lake(tmp_root)
    ch = customer_changes(spark, SF_SMALL)
    day = F.substring("dms_timestamp", 1, 10)
    first, second = ch.where(day <= "2024-01-02"), ch.where(day > "2024-01-02")
    write_change_files(first, lake.bronze("customer"))
    await_all([start_silver_job(spark, lake, "customer", "2024-01-05 00:00:00")])

    def silver():
        return spark.read.schema(silver_read_schema("customer")).parquet(lake.silver("customer"))
    n1 = silver().count()
    assert n1 == first.count()
    await_all([start_silver_job(spark, lake, "customer", "2024-01-05 00:00:00")])   # nothing new
    assert silver().count() == n1
    write_change_files(second, lake.bronze("customer"))
    await_all([start_silver_job(spark, lake, "customer", "2024-01-05 00:00:00")])
    assert silver().count() == ch.count()
    assert silver().select("batch_id").distinct().count() == 2


def test_failed_batch_is_retried_with_same_id(spark, tmp_root):
    """The position advances only when the batch succeeded."""
    from starling.operators.silver import silver_customer
    from starling.sinks.parquet import write_batch
    from starling.sources.bronze import stream_bronze
    from starling.streaming.incremental import run_available_now

    lake = Lake(tmp_root)
    write_change_files(customer_changes(spark, SF_SMALL), lake.bronze("customer"))
    schema = header_schema(spark, lake.bronze("customer"))
    seen = []

    def failing(batch, batch_id):
        seen.append(batch_id)
        write_batch(silver_customer(batch), lake.silver("customer"), batch_id, "ingestion_date")
        raise RuntimeError("executor lost after the write")

    with pytest.raises(Exception):
        run_available_now(stream_bronze(spark, lake.bronze("customer"), schema), failing,
                          lake.checkpoint("silver", "customer"))
    await_all([start_silver_job(spark, lake, "customer")])
    back = spark.read.schema(silver_read_schema("customer")).parquet(lake.silver("customer"))
    assert seen == [0]
    assert back.count() == customer_changes(spark, SF_SMALL).count()      # replay replaced, not doubled
    assert [r.batch_id for r in back.select("batch_id").distinct().collect()] == [0]


def test_date_range_reads_prune_year_partitions(spark, tmp_root):
    from starling.operators.silver import silver_orders
    from starling.operators.sort import orders_between
    from starling.schemas import SILVER_ORDERS
    s = silver_orders(order_changes(spark, SF_SMALL), run_ts="2024-01-05 00:00:00")
    path = f"{tmp_root}/orders"
    write_partitioned(s, path, "order_year_pk", "order_date", mode="overwrite")
    back = spark.read.schema(SILVER_ORDERS).parquet(path)
    q = orders_between(back, "1997-03-01", "1998-02-28")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_year_pk" in plan
    want = s.where(F.col("order_date").between(F.lit("1997-03-01").cast("date"), F.lit("1998-02-28").cast("date")))
    assert q.count() == want.count() > 0


def test_incremental_job_bounded_batches(spark, tmp_root):
    lake = Lake(tmp_root)
    ch = customer_changes(spark, SF_SMALL)
    for day in ("2024-01-01", "2024-01-02", "2024-01-03"):
        write_change_files(ch.where(F.substring("dms_timestamp", 1, 10) == day).coalesce(1), lake.bronze("customer"))
    await_all([start_silver_job(spark, lake, "customer", max_files_per_trigger=1)])
    back = spark.read.schema(silver_read_schema("customer")).parquet(lake.silver("customer"))
    assert back.select("batch_id").distinct().count() == 3
    assert back.count() == ch.where(F.substring("dms_timestamp", 1, 10) <= "2024-01-03").count()


def test_pipeline_stops_at_a_failed_stage(spark, tmp_root):
    """A silver job fails (a change file whose header moved), so the
    pipeline raises before any dimension or fact job starts."""
    from starling.plans.pipeline import run_pipeline
    from starling.sources.testtables import CHANGE_LOGS

    lake = Lake(tmp_root)
    wh = Warehouse(spark, "wh_fail_" + tmp_root.rsplit("/", 1)[-1], f"{tmp_root}/wh")
    for t, fn in CHANGE_LOGS.items():
        write_change_files(fn(spark, SF_SMALL), lake.bronze(t), mode="overwrite")
    bad = order_changes(spark, SF_SMALL).limit(5)
    write_change_files(bad.select(*reversed(bad.columns)), lake.bronze("orders"))  # header order drifted
    with pytest.raises(Exception):
        run_pipeline(spark, lake, wh, run_ts="2024-01-05 00:00:00")
    from starling.operators.scd2 import CUSTOMER_DIM
    assert lake.dimension(spark, CUSTOMER_DIM).last_committed() is None
    assert not spark.catalog.tableExists(f"{wh.name}.fact_orders")


def test_command_line_jobs(spark, tmp_root, capsys):
    """B1-B9 from the command line: silver for one table, then the pipeline."""
    import json
    from starling.plans.cli import main
    from starling.sources.testtables import CHANGE_LOGS

    lake = Lake(tmp_root)
    for t, fn in CHANGE_LOGS.items():
        write_change_files(fn(spark, SF_SMALL), lake.bronze(t), mode="overwrite")
    wh = "wh_cli_" + tmp_root.rsplit("/", 1)[-1]
    assert main(["silver", "--root", tmp_root, "--table", "orders", "--run-ts", "2024-01-05 00:00:00"], spark) == 0
    assert main(["register", "--root", tmp_root, "--like", "order%"], spark) == 0
    assert main(["pipeline", "--root", tmp_root, "--warehouse", wh, "--run-ts", "2024-01-05 00:00:00"], spark) == 0
    out = [json.loads(x) for x in capsys.readouterr().out.strip().split("\n")]
    counts = {(c["layer"], c["table_name"]): c["rows"] for c in out[-1]["counts"]}
    assert counts[("silver", "orders")] == counts[("bronze", "orders")] == counts[("fact", "fact_orders")]
    assert counts[("dimension_active", "dim_customer")] > 0
    assert main(["vacuum", "--root", tmp_root, "--table", "customer", "--keep", "1"], spark) == 0


def test_by_name_job_accepts_moved_and_added_columns(spark, tmp_root):
    """Header drift: a later drop has its columns in another order and one
    more column; read by name, both land in silver. A drop that lacks a
    required column fails the batch."""
    lake = Lake(tmp_root)
    ch = customer_changes(spark, SF_SMALL)
    day = F.substring("dms_timestamp", 1, 10)
    first, second = ch.where(day <= "2024-01-02"), ch.where(day > "2024-01-02")
    write_change_files(first, lake.bronze("customer"))
    await_all([start_silver_job(spark, lake, "customer", by_name=True)])
    drifted = second.select(*reversed(second.columns), F.lit("x").alias("loyaltytier"))
    write_change_files(drifted, lake.bronze("customer"))
    await_all([start_silver_job(spark, lake, "customer", by_name=True)])
    from starling.operators.silver import silver_customer
    back = spark.read.schema(silver_read_schema("customer")).parquet(lake.silver("customer")).drop("batch_id")
    want = silver_customer(ch)
    cols = ["customer_id", "cdc_operation", "hash_value", "cust_email", "dms_timestamp"]
    assert back.count() == ch.count()
    assert back.select(cols).exceptAll(want.select(cols)).count() == 0
    write_change_files(first.drop("phone").limit(3), lake.bronze("customer"))
    with pytest.raises(Exception):
        await_all([start_silver_job(spark, lake, "customer", by_name=True)])


def test_restarted_batch_id_is_refused(spark, tmp_root):
    import pytest

    from starling.operators.scd2 import CUSTOMER_DIM
    from starling.operators.silver import SILVER_FUNCTIONS
    from starling.sinks.dimension_store import DimensionStore, RestartedBatchError
    from starling.sources.testtables import CHANGE_LOGS

    s = SILVER_FUNCTIONS["customer"](CHANGE_LOGS["customer"](spark, "/root/testdata/sf0.001"), run_ts="2024-01-05 00:00:00")
    store = DimensionStore(spark, tmp_root + "/dim", CUSTOMER_DIM)
    store.apply(s.where("cdc_operation = 'I'"), 0, source="one")
    store.apply(s.where("cdc_operation <> 'I'"), 1, source="one")
    before = store.dimension().count()
    store.apply(s.where("cdc_operation <> 'I'"), 1, source="one")  # a replay
    assert store.dimension().count() == before
    with pytest.raises(RestartedBatchError):
        store.apply(s, 0, source="two")
    with pytest.raises(RestartedBatchError):
        store.apply(s, 1, source="two")
    assert store.dimension().count() == before


def test_no_local_folder_off_local_mode(monkeypatch):
    import pytest

    from starling import session

    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default=None):
            return default

    class Fake:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError):
        session.shared_root(Fake())


def test_truncate_load_of_a_partitioned_fact(spark, tmp_root):
    import pytest

    from starling.plans.jobs import FACT_JOBS
    from starling.sinks.warehouse import Warehouse

    table, schema = FACT_JOBS["orders"]
    rows = spark.range(10).selectExpr(*[f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema.fields])
    wh = Warehouse(spark, "wh_" + tmp_root.rsplit("/", 1)[-1], tmp_root + "/wh")
    for load_id in (0, 1):
        assert wh.load(rows, table, schema, mode="append", load_id=load_id).rows_written == 10
    with pytest.raises(ValueError):
        wh.load(rows, table, schema, mode="append")
    assert wh.load(rows, table, schema, mode="truncate_load").rows_written == 10 and wh.count(table) == 10


def test_text_key_predicates_take_each_key_once(spark):
    import uuid

    keys = [str(uuid.UUID(int=i * 997 ** 12 % 2**128)) for i in range(300)] + [None, "", "ffff", "zz", "0000", "Apple"]
    df = spark.createDataFrame([(k,) for k in keys], "id string")
    for n in (1, 2, 7, 16):
        counts = [df.where(p).count() for p in text_key_predicates("id", n)]
        assert len(counts) == n and sum(counts) == len(keys)
    assert max(counts) < 120


def test_change_files_of_several_tables_are_written_at_once(spark, tmp_root, monkeypatch):
    """A table of one task must not hold up the others; all end before an error is raised."""
    import threading

    from starling.sinks import parquet

    frames = {f"{tmp_root}/{t}": spark.createDataFrame(pd.DataFrame({"op": ["I"] * n, "a": [t] * n}))
              for n, t in enumerate(("one", "two", "three"), 1)}
    together, write = threading.Barrier(len(frames), timeout=60), parquet.write_change_files
    monkeypatch.setattr(parquet, "write_change_files", lambda *a: (together.wait(), write(*a)))
    parquet.write_all_change_files(frames, mode="overwrite")
    assert [read_bronze(spark, p).count() for p in frames] == [1, 2, 3]
    with pytest.raises(Exception):
        parquet.write_all_change_files(frames, mode="errorifexists")
