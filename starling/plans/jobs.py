"""The eight jobs of the pipeline as incremental Spark queries.

* silver jobs (B1-B4): new change files -> silver transform -> partitioned
  Parquet, one replay-safe directory per commit of the target's ledger;
* dimension jobs (B5, B6 + M1, M2): new silver files -> stage table
  (truncate-load, column statistics) -> SCD2 merge into the dimension store;
* fact jobs (B7, B8): new silver files -> fact table, appended per commit of
  its ledger into its own ``load_id`` partition (replay-safe; the source jobs truncated facts
  while reading only new files, which left only the last increment).

Each job is a file-source stream with ``availableNow``: a run takes exactly
the files no earlier successful run took. Silver and fact targets keep a fenced
ledger of the files in them (``sinks.ledger``), so that a lost, reset or
doubled checkpoint neither overwrites nor doubles what is loaded; a dimension
store refuses restarted batch ids itself.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from starling.operators.scd2 import CUSTOMER_DIM, PRODUCT_DIM, DimensionSpec
from starling.operators.silver import SILVER_FUNCTIONS, SILVER_PARTITION, silver_rescued
from starling.schemas import (
    BRONZE_COLUMNS,
    FACT_ORDER_DETAILS,
    FACT_ORDERS,
    SILVER_CUSTOMER,
    SILVER_ORDER_DETAILS,
    SILVER_ORDERS,
    SILVER_PRODUCT,
    STAGE_DIM_CUSTOMER,
    STAGE_DIM_PRODUCT,
)
from starling.session import delete_path, list_dir_names, modified, path_exists
from starling.sinks.dimension_store import DimensionStore
from starling.sinks.ledger import FILE_COLUMN, CommitLedger, apply_once, observing_files, with_file_column
from starling.sinks.parquet import bronze_path, silver_path, write_batch
from starling.sinks.warehouse import LoadReport, Warehouse
from starling.sources.bronze import (
    header_schema,
    read_bronze_by_name,
    select_tables,
    snapshot_to_bronze,
    stream_bronze,
    stream_file_names,
)
from starling.streaming.incremental import non_empty, start_available_now
from starling.streaming.journal import Journal

SOURCE_TABLES = ("customer", "product", "orders", "orderdetails")

SILVER_SCHEMAS = {
    "customer": SILVER_CUSTOMER,
    "product": SILVER_PRODUCT,
    "orders": SILVER_ORDERS,
    "orderdetails": SILVER_ORDER_DETAILS,
}
SILVER_ORDER_COL = {"orders": "order_date"}
# Files per micro-batch when change files are read by name (their paths are
# listed on the driver, so a backlog is taken in bounded batches).
BY_NAME_MAX_FILES = 1000

# table -> (stage table, stage schema, dimension)
DIMENSION_JOBS: dict[str, tuple[str, StructType, DimensionSpec]] = {
    "customer": ("stage_dim_customer", STAGE_DIM_CUSTOMER, CUSTOMER_DIM),
    "product": ("stage_dim_product", STAGE_DIM_PRODUCT, PRODUCT_DIM),
}
# table -> (fact table, fact schema)
FACT_JOBS: dict[str, tuple[str, StructType]] = {
    "orders": ("fact_orders", FACT_ORDERS),
    "orderdetails": ("fact_order_details", FACT_ORDER_DETAILS),
}


@dataclass
class Lake:
    """Folder layout of one pipeline below a shared root."""

    root: str
    db_name: str = "salesdb"
    reports: list[LoadReport] = field(default_factory=list)
    journal: Journal | None = None

    def report(self, load: LoadReport, batch: DataFrame, batch_id: int) -> None:
        """Keep a load's report, and write it to the journal where one is open."""
        self.reports.append(load)
        if self.journal is not None:
            self.journal.load(load, batch, batch_id)

    def bronze(self, table: str) -> str:
        return bronze_path(self.root, self.db_name, table)

    def silver(self, table: str) -> str:
        return silver_path(self.root, self.db_name, table)

    def checkpoint(self, job: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/_checkpoints/{job}/{table}"

    def silver_ledger(self, spark: SparkSession, table: str) -> CommitLedger:
        target = self.silver(table)

        def newest() -> tuple[int, int] | None:
            batches = [int(n.split("=", 1)[1]) for n in list_dir_names(spark, target) if n.startswith("batch_id=")]
            return (max(batches), modified(spark, f"{target}/batch_id={max(batches)}")) if batches else None

        return CommitLedger(spark, f"{self.root.rstrip('/')}/_ledger/silver/{table}",
                            lambda n: delete_path(spark, f"{target}/batch_id={n}"), newest,
                            lambda: modified(spark, f"{self.checkpoint('silver', table)}/metadata"))

    def fact_ledger(self, spark: SparkSession, warehouse: Warehouse, table: str) -> CommitLedger:
        def newest() -> tuple[int, int] | None:
            load = warehouse.newest_load(FACT_JOBS[table][0])
            path = f"{warehouse.location}/{FACT_JOBS[table][0]}/load_id={load}"
            return None if load is None else (load, modified(spark, path) or 0)

        return CommitLedger(spark, f"{self.root.rstrip('/')}/_ledger/fact/{table}",
                            lambda n: warehouse.drop_load(FACT_JOBS[table][0], n), newest,
                            lambda: modified(spark, f"{self.checkpoint('fact', table)}/metadata"))

    def dimension(self, spark: SparkSession, spec: DimensionSpec) -> DimensionStore:
        return DimensionStore(spark, f"{self.root.rstrip('/')}/dimensions/{spec.name}", spec)


def snapshot_tables(lake: Lake, read: Callable[[str], DataFrame], names: Sequence[str], like: str = "%",
                    change_ts: str | None = None, parallel: int = 8) -> list[str]:
    """Full-load export of every source table whose name matches
    the ``LIKE`` pattern, ``parallel`` tables at a time, each replacing its
    earlier snapshot; returns their names. ``read(name)`` gives a table's rows.
    All carry one load time. A table that fails leaves the others to finish;
    the first error is raised then. No matching table is an error."""
    chosen = select_tables(list(names), like)
    if not chosen:
        raise ValueError(f"no source table matches {like!r}")
    change_ts = change_ts or datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
    with ThreadPoolExecutor(parallel) as pool:
        exports = [pool.submit(lambda n: snapshot_to_bronze(read(n), lake.bronze(n), change_ts), n) for n in chosen]
    for export in exports:  # all have ended
        export.result()
    return chosen


def silver_read_schema(table: str) -> StructType:
    return StructType(list(SILVER_SCHEMAS[table].fields) + [StructField("batch_id", LongType(), True)])


def stream_silver(spark: SparkSession, lake: Lake, table: str, max_files: int | None = None) -> DataFrame:
    """S11 as a stream: only silver files no earlier run of the job took."""
    reader = spark.readStream.schema(silver_read_schema(table))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", int(max_files))
    return reader.parquet(lake.silver(table))


def stream_id(batch: DataFrame) -> str | None:
    """Id of the stream that runs this micro-batch: kept by its checkpoint, so
    a lost or reset checkpoint is a new one."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")


def start_silver_job(spark: SparkSession, lake: Lake, table: str, run_ts: str | None = None,
                     max_files_per_trigger: int | None = None, by_name: bool = False,
                     rescue: bool = False) -> StreamingQuery | None:
    """B1-B4. Returns None when no change file exists yet.
    ``max_files_per_trigger`` bounds a micro-batch (a backlog is then taken
    in several batches, each replay-safe). ``by_name`` reads each batch's
    files by header name, so files with added or moved columns are accepted
    (one job reads all headers); otherwise every file must carry the header
    of the first one. With ``rescue``, silver has a VARIANT column of added
    columns and of texts that its types cannot hold."""
    src = lake.bronze(table)
    if not path_exists(spark, src):
        return None
    transform = functools.partial(silver_rescued, table) if rescue else SILVER_FUNCTIONS[table]
    target, pk, order = lake.silver(table), SILVER_PARTITION[table], SILVER_ORDER_COL.get(table)
    ledger = lake.silver_ledger(spark, table)

    def write(rows: DataFrame, commit_id: int) -> list[str]:
        rows, files = observing_files(rows)
        write_batch(transform(rows, run_ts=run_ts), target, commit_id, pk, order)
        return files()

    def write_by_name(names: DataFrame, commit_id: int) -> list[str]:
        paths = [r[FILE_COLUMN] for r in names.collect()]  # this batch's file names (bounded by the trigger)
        rows = read_bronze_by_name(spark, paths, BRONZE_COLUMNS[table], rescue=rescue)
        if non_empty(rows):
            write_batch(transform(rows, run_ts=run_ts), target, commit_id, pk, order)
        return paths

    if by_name:
        # the batch's file names go to the driver: bound them per batch
        stream = stream_file_names(spark, src, max_files_per_trigger or BY_NAME_MAX_FILES).withColumnRenamed(
            "path", FILE_COLUMN)
    else:
        stream = with_file_column(stream_bronze(spark, src, header_schema(spark, src), max_files_per_trigger))

    def process(batch: DataFrame, batch_id: int) -> None:
        apply_once(ledger, batch, stream_id(batch), batch_id, write_by_name if by_name else write)

    return start_available_now(stream, process, lake.checkpoint("silver", table), name=f"silver_{table}")


def start_dimension_job(spark: SparkSession, lake: Lake, warehouse: Warehouse, table: str,
                        max_group_rows: int | None = None,
                        max_files_per_trigger: int | None = None) -> StreamingQuery | None:
    """B5/B6 then M1/M2: stage truncate-load of the increment, then merge.
    ``max_files_per_trigger`` bounds a micro-batch; the stage table then holds
    the run's last one."""
    if not path_exists(spark, lake.silver(table)):
        return None
    stage_table, stage_schema, spec = DIMENSION_JOBS[table]
    store = lake.dimension(spark, spec)

    def process(batch: DataFrame, batch_id: int) -> None:
        if not non_empty(batch):
            return
        lake.report(warehouse.load(batch, stage_table, stage_schema, mode="truncate_load", analyze="columns"),
                    batch, batch_id)
        kwargs = {"max_group_rows": max_group_rows} if max_group_rows else {}
        store.apply(batch, batch_id, source=stream_id(batch), **kwargs)

    stream = stream_silver(spark, lake, table, max_files_per_trigger)
    return start_available_now(stream, process, lake.checkpoint("dimension", table),
                               name=f"dimension_{table}")


def start_fact_job(spark: SparkSession, lake: Lake, warehouse: Warehouse, table: str,
                   mode: str = "append", max_files_per_trigger: int | None = None,
                   analyze: str = "table") -> StreamingQuery | None:
    """``append`` loads each silver file once, a commit of the ledger
    being a load; ``truncate_load`` keeps the source jobs' literal behaviour.
    ``analyze="sketches"`` keeps mergeable column statistics as well."""
    if not path_exists(spark, lake.silver(table)):
        return None
    fact_table, fact_schema = FACT_JOBS[table]
    ledger = lake.fact_ledger(spark, warehouse, table)

    def process(batch: DataFrame, batch_id: int) -> None:
        def load(rows: DataFrame, load_id: int | None) -> list[str]:
            rows, files = observing_files(rows)
            lake.report(warehouse.load(rows, fact_table, fact_schema, mode=mode, analyze=analyze, load_id=load_id),
                        batch, batch_id)
            return files()

        if mode == "append":
            apply_once(ledger, batch, stream_id(batch), batch_id, load)
        elif non_empty(batch):
            load(batch, None)

    stream = with_file_column(stream_silver(spark, lake, table, max_files_per_trigger))
    return start_available_now(stream, process, lake.checkpoint("fact", table),
                               name=f"fact_{table}")
