"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads the driver's test tables through ``sources.testtables`` and
runs the library functions over the whole tables. Queries that exercise a sink
or a stream write below the shared folder (``spark.checkpoint.dir``) in a
fresh directory per call and read their result back.
"""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starling.functions.hashing import change_hash
from starling.functions.rescue import RESCUED, with_rescued
from starling.functions.text import name_token, price_text
from starling.operators.rename import CUSTOMER_RENAMES, PRODUCT_RENAMES, rename_columns
from starling.operators.scd2 import (
    CUSTOMER_DIM,
    PRODUCT_DIM,
    DimensionSpec,
    MergeResult,
    empty_dimension,
    empty_tombstones,
    scd2_merge,
)
from starling.operators.silver import CUSTOMER_HASHED, SILVER_FUNCTIONS, SILVER_PARTITION
from starling.operators.silver import silver_product as silver_product_fn
from starling.operators.sort import sort_for_query
from starling.plans.jobs import DIMENSION_JOBS, FACT_JOBS, SILVER_SCHEMAS, SOURCE_TABLES, Lake, snapshot_tables, start_fact_job, start_silver_job, stream_silver
from starling.plans.oracle_format import time_as_text
from starling.plans.pipeline import layer_counts, run_pipeline
from starling.schemas import SILVER_CUSTOMER, SILVER_ORDERS
from starling.session import delete_path, path_exists, shared_path
from starling.sinks.dimension_store import DimensionStore
from starling.sinks.parquet import read_partitioned, write_all_change_files, write_batch, write_change_files, write_partitioned
from starling.sinks.statistics import DISTINCT_ERROR, RANK_ERROR
from starling.sinks.warehouse import Warehouse
from starling.sources.bronze import (
    header_schema,
    read_bronze,
    read_registered,
    register_raw_table,
    snapshot_to_bronze,
    stream_bronze,
)
from starling.sources.crawl import crawl
from starling.sources.testtables import CHANGE_LOGS, load_table, product_price_feed
from starling.streaming.incremental import await_all, run_available_now
from starling.streaming.journal import Journal

# Fixed run time of the registered queries, so their audit columns are repeatable.
RUN_TS = "2024-01-05 00:00:00"


def bronze(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return CHANGE_LOGS[table](spark, sf_dir)


def silver(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return SILVER_FUNCTIONS[table](bronze(spark, sf_dir, table), run_ts=RUN_TS)


def merge_once(spark: SparkSession, sf_dir: str, table: str, spec: DimensionSpec) -> MergeResult:
    """The whole change log of ``table`` as one batch on an empty dimension."""
    return scd2_merge(empty_dimension(spark, spec), empty_tombstones(spark, spec), silver(spark, sf_dir, table), spec)


# ------------------------------------------------------------------ bronze
def q_bronze_customer_changes(spark, sf_dir):
    return bronze(spark, sf_dir, "customer")


def q_bronze_product_changes(spark, sf_dir):
    return bronze(spark, sf_dir, "product")


# ------------------------------------------------------------------ silver
def q_silver_customer(spark, sf_dir):
    return time_as_text(silver(spark, sf_dir, "customer"))


def q_silver_product(spark, sf_dir):
    return time_as_text(silver(spark, sf_dir, "product"))


def q_silver_orders(spark, sf_dir):
    return time_as_text(silver(spark, sf_dir, "orders"))


def q_silver_order_details(spark, sf_dir):
    return time_as_text(silver(spark, sf_dir, "orderdetails"))


# ------------------------------------------------------------------ functions F1-F4, O1
def q_customer_hash(spark, sf_dir):
    """the compatible hash and the unambiguous variant (separator, NULL marker)."""
    r = rename_columns(bronze(spark, sf_dir, "customer"), CUSTOMER_RENAMES)
    return r.select(
        "customer_id",
        F.date_format(F.col("dms_timestamp").try_cast("timestamp"), "yyyy-MM-dd HH:mm:ss").alias("dms_timestamp"),
        change_hash(*CUSTOMER_HASHED).alias("hash_value"),
        change_hash(*CUSTOMER_HASHED, sep="\x1f", null_marker="\\N").alias("hash_value_sep"),
    )


def q_product_hash(spark, sf_dir):
    r = rename_columns(bronze(spark, sf_dir, "product"), PRODUCT_RENAMES)
    return r.select(
        "product_id",
        F.date_format(F.col("dms_timestamp").try_cast("timestamp"), "yyyy-MM-dd HH:mm:ss").alias("dms_timestamp"),
        change_hash("product_name", "brand_name", "product_description",
                    price_text("product_price"), "product_category").alias("hash_value"),
    )


def q_customer_names(spark, sf_dir):
    """F3, F4 on one-token names (last name NULL) and four-token names (tokens after the second are lost)."""
    c = load_table(spark, sf_dir, "customer")
    titled = F.concat_ws(" ", F.col("c_mktsegment"), F.col("c_name"), F.lit("Jr."))
    return c.select(
        F.col("c_custkey").alias("customer_key"),
        F.col("c_name").alias("full_name"),
        name_token("c_name", 0).alias("first_name"),
        name_token("c_name", 1).alias("last_name"),
        titled.alias("titled_name"),
        name_token(titled, 0).alias("titled_first_name"),
        name_token(titled, 1).alias("titled_last_name"),
    )


def q_orders_sorted(spark, sf_dir):
    """O1 in query form: silver orders, newest order date first."""
    return time_as_text(sort_for_query(silver(spark, sf_dir, "orders"), "order_date", tiebreak="order_id"))


# ------------------------------------------------------------------ dimension merge M1, M2
def q_dim_customer_scd2(spark, sf_dir):
    return time_as_text(merge_once(spark, sf_dir, "customer", CUSTOMER_DIM).dimension())


def q_dim_product_scd2(spark, sf_dir):
    return time_as_text(merge_once(spark, sf_dir, "product", PRODUCT_DIM).dimension())


def q_dim_product_price_history(spark, sf_dir):
    """M2 on a heavy feed: every line item is a price observation of its
    product (many changes per key, same-day ties collapse by rule 6)."""
    changes = silver_product_fn(product_price_feed(spark, sf_dir), run_ts=RUN_TS)
    r = scd2_merge(empty_dimension(spark, PRODUCT_DIM), empty_tombstones(spark, PRODUCT_DIM), changes, PRODUCT_DIM)
    return time_as_text(r.dimension())


def q_dim_customer_active(spark, sf_dir):
    return time_as_text(merge_once(spark, sf_dir, "customer", CUSTOMER_DIM).active)


def q_dim_customer_type1(spark, sf_dir):
    """Rule 7: email as a type-1 column."""
    spec = CUSTOMER_DIM.with_type1("cust_email")
    return time_as_text(merge_once(spark, sf_dir, "customer", spec).dimension())


def delayed_inserts(df: DataFrame) -> "F.Column":
    """The 2024-01-01 inserts of keys ending in 2: the out-of-order arrivals
    of the late-change scenario (false where a part of it is unknown)."""
    return F.coalesce(
        (F.col("cdc_operation") == "I")
        & (F.col("dms_timestamp") == F.lit("2024-01-01 00:00:00").cast("timestamp"))
        & (F.col("customer_id").try_cast("long") % 10 == 2), F.lit(False))


def q_dim_customer_type1_chunked(spark, sf_dir):
    """Rule 7 under chunking: keys of more than one change are cut."""
    spec = CUSTOMER_DIM.with_type1("cust_email")
    r = scd2_merge(empty_dimension(spark, spec), empty_tombstones(spark, spec), silver(spark, sf_dir, "customer"), spec,
                   max_group_rows=1)
    return time_as_text(r.dimension())


def q_dim_product_hot_key(spark, sf_dir):
    """M2 with a hot key: every line item is a price change, those of a third
    of the orders on one product; one change lies years before the others, many
    share a time, and a key is cut after 500 changes."""
    feed = product_price_feed(spark, sf_dir)
    bucket = F.pmod(F.col("productId").cast("long"), F.lit(3)) == 0
    hot = feed.withColumn("productId", F.when(bucket, F.lit("3")).otherwise(F.col("productId")))
    early = feed.where("productId = '3'").orderBy("dms_timestamp", "price").limit(1).withColumn(
        "dms_timestamp", F.lit("1901-01-01 00:00:00"))
    changes = silver_product_fn(hot.unionByName(early), run_ts=RUN_TS)
    r = scd2_merge(empty_dimension(spark, PRODUCT_DIM), empty_tombstones(spark, PRODUCT_DIM), changes, PRODUCT_DIM,
                   max_group_rows=500)
    return time_as_text(r.dimension())


def q_late_changes(spark, sf_dir):
    """Rule 8: the rest of the log first, then the delayed inserts, which are
    older than their keys' versions and therefore only reported. The two
    batches go through the dimension store, whose written state cuts the
    lineage between them."""
    s = silver(spark, sf_dir, "customer")
    store = DimensionStore(spark, shared_path(spark, "late_changes", unique=True), CUSTOMER_DIM)
    store.apply(s.where(~delayed_inserts(s)), 0)
    store.apply(s.where(delayed_inserts(s)), 1)
    return time_as_text(store.late())


# The change dates of the customer log, one batch each.
CHANGE_DAYS = ("2024-01-01", "2024-01-02", "2024-01-03", "2024-01-04")


def q_dim_customer_scd2_incremental(spark, sf_dir):
    """The customer log merged day by day through the dimension store
    gives the same dimension as one batch."""
    s = silver(spark, sf_dir, "customer")
    store = DimensionStore(spark, shared_path(spark, "dim_customer_incremental", unique=True), CUSTOMER_DIM)
    day = F.coalesce(F.to_date("dms_timestamp").cast("string"), F.lit(""))
    for n, d in enumerate(CHANGE_DAYS):
        store.apply(s.where(day == d), n)
    store.apply(s.where(~day.isin(*CHANGE_DAYS)), len(CHANGE_DAYS))  # any other day, and no time at all
    return time_as_text(store.dimension())


def q_dim_customer_compacted(spark, sf_dir):
    """The customer log merged day by day, the closed versions of two
    batches of like size merged into one run each time, and everything that
    the newest batch does not consist of removed: the same dimension."""
    s = silver(spark, sf_dir, "customer")
    store = DimensionStore(spark, shared_path(spark, "dim_customer_compacted", unique=True), CUSTOMER_DIM, compact_at=2)
    day = F.coalesce(F.to_date("dms_timestamp").cast("string"), F.lit(""))
    for n, d in enumerate(CHANGE_DAYS):
        store.apply(s.where(day == d), n)
    store.apply(s.where(~day.isin(*CHANGE_DAYS)), len(CHANGE_DAYS))
    store.vacuum(keep=1)
    return time_as_text(store.dimension())


# ------------------------------------------------------------------ sources and sinks
def q_bronze_csv_roundtrip(spark, sf_dir):
    """K1 + S5/S6 + S8: the customer log written as gzip CSV change files,
    registered as raw_data_customer from its header and scanned through the
    catalog."""
    path = shared_path(spark, "bronze_csv", unique=True) + "/customer"
    write_change_files(bronze(spark, sf_dir, "customer"), path, mode="overwrite")
    return read_registered(spark, register_raw_table(spark, "customer", path))


def q_incremental_customer(spark, sf_dir):
    """Two drops of change files; each job run takes only the new
    files, a third run without new files takes nothing."""
    lake = Lake(shared_path(spark, "incremental_customer", unique=True))
    changes = bronze(spark, sf_dir, "customer")
    early = F.coalesce(F.substring("dms_timestamp", 1, 10) <= F.lit("2024-01-02"), F.lit(False))
    write_change_files(changes.where(early), lake.bronze("customer"))
    await_all([start_silver_job(spark, lake, "customer", RUN_TS)])
    write_change_files(changes.where(~early), lake.bronze("customer"))
    await_all([start_silver_job(spark, lake, "customer", RUN_TS)])
    await_all([start_silver_job(spark, lake, "customer", RUN_TS)])
    out = read_partitioned(spark, lake.silver("customer"), SILVER_CUSTOMER)
    return time_as_text(out.drop("batch_id"))


def q_silver_orders_partitions(spark, sf_dir):
    """K2 + P10: silver orders written partitioned by order_year_pk, read back,
    rows and date range per partition."""
    path = shared_path(spark, "silver_orders", unique=True)
    write_partitioned(silver(spark, sf_dir, "orders"), path, "order_year_pk", "order_date", mode="overwrite")
    back = spark.read.schema(SILVER_ORDERS).parquet(path)
    return back.groupBy("order_year_pk").agg(
        F.count(F.lit(1)).alias("rows"),
        F.date_format(F.min("order_date"), "yyyy-MM-dd").alias("first_order_date"),
        F.date_format(F.max("order_date"), "yyyy-MM-dd").alias("last_order_date"),
    )


def _warehouse(spark) -> Warehouse:
    loc = shared_path(spark, "warehouse", unique=True)
    return Warehouse(spark, "wh_" + loc.rsplit("/", 1)[-1], loc)


def _stage(spark, sf_dir, table):
    """K5, K6, K9: create-if-absent, then truncate-load twice: the table
    holds one copy."""
    wh = _warehouse(spark)
    stage_table, schema, _spec = DIMENSION_JOBS[table]
    rows = silver(spark, sf_dir, table)
    for _ in range(2):
        wh.load(rows, stage_table, schema, mode="truncate_load", analyze="columns")
    return time_as_text(wh.table(stage_table))


def q_stage_customer(spark, sf_dir):
    return _stage(spark, sf_dir, "customer")


def q_stage_product(spark, sf_dir):
    return _stage(spark, sf_dir, "product")


def _fact(spark, sf_dir, table):
    """Append into the batch's own partition; the same batch
    applied twice (a replay) still gives one copy."""
    wh = _warehouse(spark)
    fact_table, schema = FACT_JOBS[table]
    rows = silver(spark, sf_dir, table)
    for _ in range(2):
        wh.load(rows, fact_table, schema, mode="append", analyze="table", load_id=0)
    return time_as_text(wh.table(fact_table).drop("load_id"))


def q_fact_orders(spark, sf_dir):
    return _fact(spark, sf_dir, "orders")


def q_fact_orders_truncate_load(spark, sf_dir):
    """K6: a truncate-load of a fact table that loads were appended to before
    empties all of it: one copy."""
    wh = _warehouse(spark)
    fact_table, schema = FACT_JOBS["orders"]
    rows = silver(spark, sf_dir, "orders")
    for load_id in (0, 1):
        wh.load(rows, fact_table, schema, mode="append", load_id=load_id)
    wh.load(rows, fact_table, schema, mode="truncate_load")
    return time_as_text(wh.table(fact_table).drop("load_id"))


def q_table_statistics(spark, sf_dir):
    """K8: row count and, for the stage tables, distinct values of the key, as
    the catalog has them after the loads' ANALYZE."""
    wh, out = _warehouse(spark), []
    for table, (stage_table, schema, spec) in DIMENSION_JOBS.items():
        wh.load(silver(spark, sf_dir, table), stage_table, schema, mode="truncate_load", analyze="columns")
        out.append((stage_table, wh.statistics(stage_table), spec.key, wh.column_has_statistics(stage_table, spec.key)))
    for table, (fact_table, schema) in FACT_JOBS.items():
        wh.load(silver(spark, sf_dir, table), fact_table, schema, mode="truncate_load", analyze="table")
        out.append((fact_table, wh.statistics(fact_table), None, False))
    return spark.createDataFrame(out, "table_name string, rows long, column_name string, has_column_statistics boolean")


def q_fact_column_statistics(spark, sf_dir):
    """K8: each fact loaded in two appends; its column statistics merged from
    the two loads' sketches. ``distinct_within`` and ``quantiles_within`` hold
    them against the table itself: the distinct count within four standard
    errors, the quartiles' ranks within twice the 99 % error (the sketch is
    random); ``none`` where a column has no quantiles."""
    wh, out, quartiles = _warehouse(spark), [], (0.25, 0.5, 0.75)
    for table, (fact_table, schema) in FACT_JOBS.items():
        rows = silver(spark, sf_dir, table)
        third = F.coalesce(F.col("order_id").try_cast("long") % 3 == 0, F.lit(False))
        for load_id, part in enumerate((rows.where(third), rows.where(~third))):
            wh.load(part, fact_table, schema, mode="append", load_id=load_id, analyze="sketches")
        stats = wh.column_statistics(fact_table, quartiles)
        found = {r.column_name: r.quantiles for r in stats.collect()}  # a row per column
        exact = wh.table(fact_table)
        ranks = exact.agg(*[F.struct(F.count_distinct(c).alias("distinct_values"), (
            F.lit(None).cast("boolean") if found[c] is None else reduce(lambda a, b: a & b, [
                (F.count_if(F.col(c) < F.lit(q).cast(schema[c].dataType)) <= (p + 2 * RANK_ERROR) * F.count(c))
                & (F.count_if(F.col(c) <= F.lit(q).cast(schema[c].dataType)) >= (p - 2 * RANK_ERROR) * F.count(c))
                for p, q in zip(quartiles, found[c], strict=True)])).alias("quantiles_within")).alias(c) for c in schema.names])
        checks = ranks.select(F.explode(F.create_map(*[x for c in schema.names for x in (F.lit(c), F.col(c))])).alias(
            "column_name", "check")).select("column_name", "check.*")
        within = F.abs(F.col("distinct_count") - F.col("distinct_values")) <= 4 * DISTINCT_ERROR * F.col("distinct_values")
        out.append(stats.join(checks, "column_name").select(
            F.lit(fact_table).alias("table_name"), "column_name", "rows", "nulls", "min_value", "max_value",
            "distinct_values", within.alias("distinct_within"),
            F.coalesce(F.col("quantiles_within").cast("string"), F.lit("none")).alias("quantiles_within")))
    return reduce(DataFrame.unionByName, out)


class _LostAfterLoad(Warehouse):
    """A warehouse whose connection is lost once, after the load was written."""

    lost = False

    def load(self, *args, **kwargs):
        report = super().load(*args, **kwargs)
        if self.lost:
            self.lost = False
            raise RuntimeError("lost after the load")
        return report


def q_load_journal(spark, sf_dir):
    """A2, A3: orders through the silver and the fact job in two drops; the
    second fact run fails after its load and is run again. The journal's runs
    (status, durable batches) and its loads (rows, NULLs of parsed columns);
    0 where a column does not apply."""
    root = shared_path(spark, "journal", unique=True)
    wh = _LostAfterLoad(spark, "wh_" + root.rsplit("/", 1)[-1], root + "/warehouse")
    rows = bronze(spark, sf_dir, "orders")
    late = F.coalesce(F.col("orderid").try_cast("long") % 3 == 0, F.lit(False))
    rows = rows.withColumn("orderdate", F.when(F.col("orderid").try_cast("long") % 7 == 0, "31.02.1995").otherwise(F.col("orderdate")))
    with Journal(spark, root + "/journal") as journal:
        lake, runs = Lake(root, journal=journal), []
        for n, drop in enumerate((~late, late)):
            write_change_files(rows.where(drop), lake.bronze("orders"))
            runs.append(start_silver_job(spark, lake, "orders", RUN_TS))
            await_all(runs[-1:])
            wh.lost = n == 1
            for _ in range(n + 1):
                runs.append(start_fact_job(spark, lake, wh, "orders"))
                try:
                    await_all(runs[-1:])
                except Exception:  # noqa: BLE001 - the second fact run is meant to fail
                    if wh.lost or n == 0:
                        raise
        journal.settle(runs)
    out = journal.runs().select(
        F.lit("run").alias("kind"), F.col("job").alias("name"), F.col("run_number").cast("long").alias("number"), "status",
        "batches", F.lit(0).cast("long").alias("rows_written"), F.lit(0).cast("long").alias("null_values"))
    loads = journal.loads().select(
        F.lit("load").alias("kind"), F.col("table_name").alias("name"), F.col("batch_id").alias("number"),
        F.when(F.col("durable"), "durable").otherwise("open").alias("status"), F.lit(0).cast("long").alias("batches"),
        "rows_written", "null_values")
    return out.unionByName(loads)


def q_load_schemas(spark, sf_dir):
    """A3: the input columns of each load, as reported by it."""
    wh, out = _warehouse(spark), []
    jobs = [(t, j[0], j[1]) for t, j in DIMENSION_JOBS.items()] + [(t, *j) for t, j in FACT_JOBS.items()]
    for table, target, schema in jobs:
        report = wh.load(silver(spark, sf_dir, table), target, schema, mode="truncate_load", analyze=None)
        out += [(target, i, f.name, f.dataType.simpleString()) for i, f in enumerate(report.input_schema.fields)]
    return spark.createDataFrame(out, "table_name string, position int, column_name string, data_type string")


def q_silver_product_prices(spark, sf_dir):
    """F8, F2: prices of five decimals and above 10^8 from every part, rounded
    to two; two prices that differ in the fifth decimal hash differently."""
    p = load_table(spark, sf_dir, "part")
    cents = F.round(F.col("p_retailprice") * 100).cast("long")
    whole = (F.floor(cents / 100) + (F.col("p_partkey") % 3) * 100_000_000).cast("long")
    text = F.concat(whole.cast("string"), F.lit("."), F.lpad((cents % 100).cast("string"), 2, "0"),
                    F.lpad((F.col("p_partkey") % 1000).cast("string"), 3, "0"))
    raw = p.select(
        F.lit("I").alias("Op"), F.col("p_partkey").cast("string").alias("productId"), F.col("p_name").alias("productName"),
        F.col("p_brand").alias("brandName"), F.col("p_type").alias("productDescription"), text.alias("price"),
        F.col("p_type").alias("productCategory"), F.lit(RUN_TS).alias("dms_timestamp"))
    return silver_product_fn(raw, run_ts=RUN_TS).select("product_id", "product_price", "hash_value")


def q_fact_order_details(spark, sf_dir):
    return _fact(spark, sf_dir, "orderdetails")


def q_load_report(spark, sf_dir):
    """Rows read and written (observed during the write) and values
    that could not be parsed, for each of the four loads; every seventh order
    has a date that is none."""
    wh = _warehouse(spark)
    reports = []
    for table, (stage_table, schema, _spec) in DIMENSION_JOBS.items():
        reports.append(wh.load(silver(spark, sf_dir, table), stage_table, schema, mode="truncate_load"))
    for table, (fact_table, schema) in FACT_JOBS.items():
        raw = bronze(spark, sf_dir, table)
        if table == "orders":
            bad = F.col("orderid").cast("long") % 7 == 0
            raw = raw.withColumn("orderdate", F.when(bad, F.lit("31.02.1995")).otherwise(F.col("orderdate")))
        reports.append(wh.load(SILVER_FUNCTIONS[table](raw, run_ts=RUN_TS), fact_table, schema, mode="append", load_id=0))
    return spark.createDataFrame(
        pd.DataFrame([(r.table, r.rows_read, r.rows_written, r.mode, r.null_values) for r in reports],
                     columns=["table_name", "rows_read", "rows_written", "load_mode", "null_values"]),
        "table_name string, rows_read long, rows_written long, load_mode string, null_values long",
    )


def q_retry_after_failure(spark, sf_dir):
    """T4: a batch fails after its write; the next run takes the same files
    again and replaces the batch: one copy."""
    lake = Lake(shared_path(spark, "retry", unique=True))
    write_change_files(bronze(spark, sf_dir, "customer"), lake.bronze("customer"))
    failed = []

    def process(rows, batch_id):
        write_batch(SILVER_FUNCTIONS["customer"](rows, run_ts=RUN_TS), lake.silver("customer"), batch_id,
                    SILVER_PARTITION["customer"])
        if not failed:
            failed.append(batch_id)
            raise RuntimeError("lost after the write")

    for _ in range(2):
        stream = stream_bronze(spark, lake.bronze("customer"), header_schema(spark, lake.bronze("customer")))
        try:
            run_available_now(stream, process, lake.checkpoint("silver", "customer"))
        except Exception:  # noqa: BLE001 - the first run is meant to fail
            if len(failed) != 1:
                raise
    return time_as_text(read_partitioned(spark, lake.silver("customer"), SILVER_CUSTOMER).drop("batch_id"))


def q_silver_after_lost_checkpoint(spark, sf_dir):
    """The silver job's checkpoint is lost between two runs. Its files are
    still listed, its batches count from 0 again: nothing is overwritten and
    nothing loaded twice."""
    lake = Lake(shared_path(spark, "lost_checkpoint", unique=True))
    changes = bronze(spark, sf_dir, "customer")
    day = F.coalesce(F.substring("dms_timestamp", 1, 10), F.lit(""))
    for n, drop in enumerate((day <= "2024-01-01", day == "2024-01-02", day > "2024-01-02")):
        write_change_files(changes.where(drop), lake.bronze("customer"))
        await_all([start_silver_job(spark, lake, "customer", RUN_TS)])
        if n == 1:
            delete_path(spark, lake.checkpoint("silver", "customer"))
    return time_as_text(read_partitioned(spark, lake.silver("customer"), SILVER_CUSTOMER).drop("batch_id"))


def q_fact_after_lost_checkpoint(spark, sf_dir):
    """The checkpoints of the silver and the fact job are lost between
    loads; the fact table still holds every order once."""
    root = shared_path(spark, "fact_lost", unique=True)
    lake = Lake(root)
    wh = Warehouse(spark, "wh_" + root.rsplit("/", 1)[-1], root + "/warehouse")
    rows = bronze(spark, sf_dir, "orders")
    late = F.coalesce(F.col("orderid").try_cast("long") % 3 == 0, F.lit(False))
    for drop in (~late, late):
        write_change_files(rows.where(drop), lake.bronze("orders"))
        await_all([start_silver_job(spark, lake, "orders", RUN_TS)])
        await_all([start_fact_job(spark, lake, wh, "orders")])
        for job in ("silver", "fact"):
            delete_path(spark, lake.checkpoint(job, "orders"))
    await_all([start_silver_job(spark, lake, "orders", RUN_TS)])
    await_all([start_fact_job(spark, lake, wh, "orders")])
    return time_as_text(wh.table(FACT_JOBS["orders"][0]).drop("load_id"))


def q_fact_replay_after_read(spark, sf_dir):
    """T4, K7: a fact batch fails after its load, once the table has been read
    in the session; the next run takes the batch again and replaces the load."""
    root = shared_path(spark, "fact_replay", unique=True)
    lake, failed = Lake(root), []
    wh = Warehouse(spark, "wh_" + root.rsplit("/", 1)[-1], root + "/warehouse")
    write_change_files(bronze(spark, sf_dir, "orders"), lake.bronze("orders"))
    await_all([start_silver_job(spark, lake, "orders", RUN_TS)])
    fact_table, schema = FACT_JOBS["orders"]

    def process(rows, batch_id):
        wh.load(rows, fact_table, schema, mode="append", load_id=batch_id)
        if not failed:
            failed.append(wh.count(fact_table))
            raise RuntimeError("lost after the load")

    for _ in range(2):
        try:
            run_available_now(stream_silver(spark, lake, "orders"), process, lake.checkpoint("fact", "orders"))
        except Exception:  # noqa: BLE001 - the first run is meant to fail
            if len(failed) != 1:
                raise
    return time_as_text(wh.table(fact_table).drop("load_id"))


def q_silver_three_headers(spark, sf_dir):
    """Product change files of three headers (as agreed, columns moved,
    a column added) with prices that are none, taken by name in one batch. What
    silver has no place for is in its VARIANT column, as JSON here."""
    lake = Lake(shared_path(spark, "three_headers", unique=True))
    rows = bronze(spark, sf_dir, "product")
    key = F.coalesce(F.col("productid").try_cast("long"), F.lit(0))
    rows = rows.withColumn("price", F.when(key % 7 == 0, F.concat(F.lit("about "), "price")).otherwise(F.col("price")))
    names = rows.columns
    write_change_files(rows.where(key % 3 == 0), lake.bronze("product"))
    write_change_files(rows.where(key % 3 == 1).select(*reversed(names)), lake.bronze("product"))
    write_change_files(rows.where(key % 3 == 2).select(
        *names[:3], F.concat(F.lit("c"), (key % 5).cast("string")).alias("colour"), *names[3:]), lake.bronze("product"))
    await_all([start_silver_job(spark, lake, "product", RUN_TS, by_name=True, rescue=True)])
    silver_rows = read_partitioned(spark, lake.silver("product"), with_rescued(SILVER_SCHEMAS["product"]))
    return time_as_text(silver_rows.withColumn("rescued", F.to_json(RESCUED)).drop(RESCUED, "batch_id"))


def q_schema_crawl(spark, sf_dir):
    """The four folders of change files crawled: type, nullability and
    rows of each column."""
    lake, out = Lake(shared_path(spark, "crawl", unique=True)), []
    write_all_change_files({lake.bronze(t): bronze(spark, sf_dir, t) for t in SOURCE_TABLES})
    for t in SOURCE_TABLES:
        found = crawl(spark, lake.bronze(t))
        out.append(found.select(F.lit(t).alias("table_name"), "position", "column_name", "data_type", "nullable", "rows", "missing"))
    return reduce(DataFrame.unionByName, out)


def q_pipeline_stops(spark, sf_dir):
    """Change files of orders lack a column, so their silver job fails;
    the other silver jobs are done, and nothing behind the stage has begun."""
    root = shared_path(spark, "pipeline_stops", unique=True)
    lake, out = Lake(root), []
    wh = Warehouse(spark, "stop_" + root.rsplit("/", 1)[-1], root + "/warehouse")
    rows = {t: bronze(spark, sf_dir, t) for t in SOURCE_TABLES}
    rows["orders"] = rows["orders"].drop("orderdate")
    write_all_change_files({lake.bronze(t): rows[t] for t in SOURCE_TABLES}, mode="overwrite")
    stopped = False
    try:
        run_pipeline(spark, lake, wh, run_ts=RUN_TS)
    except Exception:  # noqa: BLE001 - it is meant to fail
        stopped = True
    for t in SOURCE_TABLES:
        done = path_exists(spark, lake.silver(t))
        rows = read_partitioned(spark, lake.silver(t), SILVER_SCHEMAS[t]).count() if done else 0
        out.append(("silver", t, rows, stopped))
    for name in [j[0] for j in (*DIMENSION_JOBS.values(), *FACT_JOBS.values())]:
        known = spark.catalog.tableExists(f"{wh.name}.{name}")
        out.append(("warehouse", name, wh.count(name) if known else 0, stopped))
    return spark.createDataFrame(out, "layer string, table_name string, rows long, stopped boolean")


def q_snapshot_export_product(spark, sf_dir):
    """S1 + S4 + K1 + S7: a full-load export of the product source table into
    change files (op I on every row, load time as dms_timestamp, replacing an
    earlier snapshot), read back by header."""
    p = load_table(spark, sf_dir, "part")
    source = p.select(
        F.col("p_partkey").cast("string").alias("productId"),
        F.col("p_name").alias("productName"),
        F.col("p_brand").alias("brandName"),
        F.concat(F.col("p_type"), F.lit(" desc")).alias("productDescription"),
        F.col("p_retailprice").cast("decimal(12,2)").cast("string").alias("price"),
        F.col("p_type").alias("productCategory"),
    )
    path = shared_path(spark, "snapshot", unique=True) + "/product"
    snapshot_to_bronze(source, path, change_ts=RUN_TS)
    snapshot_to_bronze(source, path, change_ts=RUN_TS)  # a second full load replaces the first
    return read_bronze(spark, path)


def q_snapshot_tables_like(spark, sf_dir):
    """S3: the source tables whose names match a LIKE pattern, exported as
    change files; rows and least key of each, read back by header."""
    lake = Lake(shared_path(spark, "snapshot_like", unique=True))
    names = ["customer", "lineitem", "nation", "orders", "part", "region", "supplier"]
    done = snapshot_tables(lake, lambda t: load_table(spark, sf_dir, t), names, "%er%", change_ts=RUN_TS)
    out = []
    for t in done:
        rows = read_bronze(spark, lake.bronze(t))
        key = next(c for c in rows.columns if c.endswith("key"))
        out.append(rows.groupBy("op", "dms_timestamp").agg(
            F.count(F.lit(1)).alias("rows"), F.min(F.col(key).cast("long")).alias("least_key")).select(
            F.lit(t).alias("table_name"), "op", "dms_timestamp", "rows", "least_key"))
    return reduce(DataFrame.unionByName, out)


def q_layer_counts(spark, sf_dir):
    """Change files of all four tables through silver, stage, dimensions
    and facts; rows per layer and table."""
    root = shared_path(spark, "pipeline", unique=True)
    lake = Lake(root)
    wh = Warehouse(spark, "sales_" + root.rsplit("/", 1)[-1], root + "/warehouse")
    write_all_change_files({lake.bronze(t): bronze(spark, sf_dir, t) for t in SOURCE_TABLES}, mode="overwrite")
    run_pipeline(spark, lake, wh, run_ts=RUN_TS)
    return layer_counts(spark, lake, wh)


QUERIES = {
    "bronze_customer_changes": q_bronze_customer_changes,
    "bronze_product_changes": q_bronze_product_changes,
    "silver_customer": q_silver_customer,
    "silver_product": q_silver_product,
    "silver_orders": q_silver_orders,
    "silver_order_details": q_silver_order_details,
    "customer_hash": q_customer_hash,
    "product_hash": q_product_hash,
    "customer_names": q_customer_names,
    "orders_sorted": q_orders_sorted,
    "dim_customer_scd2": q_dim_customer_scd2,
    "dim_product_scd2": q_dim_product_scd2,
    "dim_product_price_history": q_dim_product_price_history,
    "dim_customer_active": q_dim_customer_active,
    "dim_customer_type1": q_dim_customer_type1,
    "late_changes": q_late_changes,
    "dim_customer_scd2_incremental": q_dim_customer_scd2_incremental,
    "dim_customer_compacted": q_dim_customer_compacted,
    "bronze_csv_roundtrip": q_bronze_csv_roundtrip,
    "incremental_customer": q_incremental_customer,
    "silver_orders_partitions": q_silver_orders_partitions,
    "stage_customer": q_stage_customer,
    "stage_product": q_stage_product,
    "fact_orders": q_fact_orders,
    "fact_order_details": q_fact_order_details,
    "load_report": q_load_report,
    "retry_after_failure": q_retry_after_failure,
    "silver_after_lost_checkpoint": q_silver_after_lost_checkpoint,
    "fact_after_lost_checkpoint": q_fact_after_lost_checkpoint,
    "fact_replay_after_read": q_fact_replay_after_read,
    "silver_three_headers": q_silver_three_headers,
    "schema_crawl": q_schema_crawl,
    "pipeline_stops": q_pipeline_stops,
    "dim_customer_type1_chunked": q_dim_customer_type1_chunked,
    "dim_product_hot_key": q_dim_product_hot_key,
    "fact_orders_truncate_load": q_fact_orders_truncate_load,
    "table_statistics": q_table_statistics,
    "fact_column_statistics": q_fact_column_statistics,
    "load_journal": q_load_journal,
    "load_schemas": q_load_schemas,
    "silver_product_prices": q_silver_product_prices,
    "snapshot_export_product": q_snapshot_export_product,
    "snapshot_tables_like": q_snapshot_tables_like,
    "layer_counts": q_layer_counts,
}
