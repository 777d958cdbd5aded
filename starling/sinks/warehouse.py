"""Warehouse table sink (K4-K9, A2, A3).

A ``Warehouse`` is a catalog database whose tables are Parquet files below a
shared location. Loads follow the source jobs' contract: create the table
if absent with the fixed DDL, empty it (truncate-load) or append, write,
then compute statistics. Rows read are counted by an ``Observation`` during
the write itself, so the load is one pass over the input.

Facts can be loaded replay-safe: ``load(..., load_id=n)`` writes into the
static partition ``load_id=n`` with overwrite, so an increment applied twice
replaces itself instead of doubling (plain append is still available).
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from starling.sinks.statistics import SketchStore, describe

#: Columns that the silver jobs parse from text.
PARSED_COLUMNS = ("order_date", "product_price", "product_quantity")
#: Partition that a truncate-load writes in a table partitioned by load_id.
TRUNCATED_LOAD = -1


class SchemaMismatchError(ValueError):
    pass


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """K9: project to the target columns, by name, cast to the target types.

    Extra input columns are dropped; a missing target column is an error.
    """
    have = {c.lower(): c for c in df.columns}
    missing = [f.name for f in schema.fields if f.name.lower() not in have]
    if missing:
        raise SchemaMismatchError(f"input lacks target columns {missing}")
    return df.select(*[F.col(f"`{have[f.name.lower()]}`").cast(f.dataType).alias(f.name) for f in schema.fields])


def ddl(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString().upper()}" for f in schema.fields)


@dataclass
class LoadReport:
    """A2/A3: rows read from the input and rows the load wrote (observed
    during the write: a projection neither adds nor drops rows), and the input
    schema. ``null_values`` counts NULLs in the table's typed columns (F5):
    dates, prices and quantities that could not be parsed, or were absent."""

    table: str
    rows_read: int
    rows_written: int
    mode: str
    schema: str = ""
    input_schema: StructType | None = None
    null_values: int = 0


class Warehouse:
    """Catalog database ``name`` at ``location`` (a shared folder)."""

    def __init__(self, spark: SparkSession, name: str, location: str):
        self.spark, self.name, self.location = spark, name, location.rstrip("/")
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}` LOCATION '{self.location}'")

    def qualified(self, table: str) -> str:
        return f"`{self.name}`.`{table}`"

    def create_table(self, table: str, schema: StructType, partitioned_by_load: bool = False) -> None:
        """K5: create-if-absent with the fixed DDL."""
        cols = ddl(schema) + (", `load_id` BIGINT" if partitioned_by_load else "")
        part = " PARTITIONED BY (`load_id`)" if partitioned_by_load else ""
        # a managed table of the database, whose location is the shared folder
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.qualified(table)} ({cols}) USING parquet{part}")

    def load(self, df: DataFrame, table: str, schema: StructType, mode: str = "truncate_load",
             analyze: str | None = "table", load_id: int | None = None) -> LoadReport:
        """K4 + K6/K7 + K8. ``mode``: ``truncate_load`` (empty, then load) or
        ``append``. With ``load_id`` the table is partitioned by it and the
        load replaces only that partition (replay-safe append). A truncate-load
        of such a table without a ``load_id`` replaces all its partitions by
        one, TRUNCATED_LOAD; a plain append to it is an error."""
        if mode not in ("truncate_load", "append"):
            raise ValueError(f"unknown load mode {mode!r}")
        self.create_table(table, schema, partitioned_by_load=load_id is not None)
        obs = Observation(f"load_{table}")
        rows = conform(df, schema)
        parsed = [F.count_if(F.col(c).isNull()) for c in PARSED_COLUMNS if c in rows.columns]
        rows = rows.observe(obs, F.count(F.lit(1)).alias("rows"), sum(parsed, F.lit(0)).cast("long").alias("nulls"))
        target = self.qualified(table)
        partitioned = "load_id" in self.table(table).columns
        if load_id is None and partitioned and mode == "append":
            raise ValueError(f"{table} is partitioned by load_id: an append needs one")
        if load_id is None and mode == "append" and analyze == "sketches":
            raise ValueError(f"{table}: sketches of an append need a load_id")
        # what the load makes stale goes first, so that a load that fails half
        # way leaves no sketch that is wrong (an append by itself makes all stale)
        self.sketches(table).drop(load_id)
        if load_id is not None:
            # the frame may belong to a stream's session (foreachBatch), and
            # several loads may run at once: a unique view in that session
            session, view = rows.sparkSession, f"_starling_load_{uuid.uuid4().hex}"
            rows.createOrReplaceTempView(view)
            try:
                session.sql(f"INSERT OVERWRITE {target} PARTITION (load_id = {int(load_id)}) SELECT * FROM {view}")
            finally:
                session.catalog.dropTempView(view)
        else:
            if partitioned:
                rows = rows.withColumn("load_id", F.lit(TRUNCATED_LOAD).cast("long"))
            (rows.write.option("partitionOverwriteMode", "static")
             .insertInto(target, overwrite=(mode == "truncate_load")))
        for session in {rows.sparkSession, self.spark}:  # either may hold the file list of an earlier read
            session.catalog.refreshTable(target)
        if analyze == "sketches":
            loaded = self.table(table) if load_id is None else self.table(table).where(F.col("load_id") == int(load_id))
            self.sketches(table).write(TRUNCATED_LOAD if load_id is None else load_id, loaded.select(*schema.names))
        self.analyze(table, analyze, load_id)
        n = int(obs.get.get("rows", 0))
        return LoadReport(table, n, n, mode, df.schema.simpleString(), df.schema, int(obs.get.get("nulls", 0)))

    def analyze(self, table: str, level: str | None = "table", load_id: int | None = None) -> None:
        """K8: ``table`` = size and row count (Parquet footers only);
        ``columns`` = column statistics too (a full scan: for stage tables,
        whose size is one increment). With ``load_id`` only that partition is
        analyzed, so an append costs its own rows, not the table's history.
        ``sketches`` = size and row count, and mergeable column statistics of
        the load (``column_statistics``)."""
        target = self.qualified(table) + (f" PARTITION (load_id = {int(load_id)})" if load_id is not None else "")
        if level in ("table", "sketches"):
            self.spark.sql(f"ANALYZE TABLE {target} COMPUTE STATISTICS")
        elif level == "columns":
            self.spark.sql(f"ANALYZE TABLE {target} COMPUTE STATISTICS FOR ALL COLUMNS")

    def sketches(self, table: str) -> SketchStore:
        """K8: the column sketches of the table's loads, each made from the
        load's own partition."""
        return SketchStore(self.spark, f"{self.location}/_statistics/{table}")

    def column_statistics(self, table: str, probabilities: tuple[float, ...] = (0.25, 0.5, 0.75)) -> DataFrame:
        """K8: rows, nulls, bounds, distinct count and quantiles of each column,
        merged from the loads' sketches: no row of the table is read. A load
        without sketches would be missing silently, so that is an error."""
        store = self.sketches(table)
        known = set(store.loads())
        if "load_id" in self.table(table).columns:
            parts = self.spark.sql(f"SHOW PARTITIONS {self.qualified(table)}").collect()
            missing = sorted({int(r[0].split("=", 1)[1]) for r in parts} - known)
        else:
            missing = [] if known else [TRUNCATED_LOAD]
        if missing:
            raise ValueError(f"{table}: loads {missing} have no sketches")
        return describe(store.read(), probabilities)

    def _described(self, table: str, column: str = "") -> dict[str, str]:
        rows = self.spark.sql(f"DESCRIBE EXTENDED {self.qualified(table)} {column}").collect()
        return {r[0]: r[1] for r in rows}

    def statistics(self, table: str) -> int | None:
        """K8: the row count in the catalog (None if not analyzed)."""
        found = [w for w in self._described(table).get("Statistics", "").split(", ") if w.endswith(" rows")]
        return int(found[0].split()[0]) if found else None

    def column_has_statistics(self, table: str, column: str) -> bool:
        """K8: whether the catalog has a distinct count for the column."""
        return self._described(table, f"`{column}`").get("distinct_count", "NULL") != "NULL"

    def newest_load(self, table: str) -> int | None:
        """The largest ``load_id`` of a table partitioned by it (None without)."""
        if not self.spark.catalog.tableExists(f"{self.name}.{table}") or "load_id" not in self.table(table).columns:
            return None
        parts = self.spark.sql(f"SHOW PARTITIONS {self.qualified(table)}").collect()
        return max((int(r[0].split("=", 1)[1]) for r in parts), default=None)

    def drop_load(self, table: str, load_id: int) -> None:
        """Remove one load of a table partitioned by ``load_id``, files too."""
        self.sketches(table).drop(load_id)
        if self.newest_load(table) is not None:
            self.spark.sql(f"ALTER TABLE {self.qualified(table)} DROP IF EXISTS PARTITION (load_id = {int(load_id)})")
            self.spark.catalog.refreshTable(self.qualified(table))

    def table(self, table: str) -> DataFrame:
        return self.spark.table(self.qualified(table))

    def count(self, table: str) -> int:
        return self.table(table).count()

    def truncate(self, table: str) -> None:
        self.sketches(table).drop()
        self.spark.sql(f"TRUNCATE TABLE {self.qualified(table)}")
