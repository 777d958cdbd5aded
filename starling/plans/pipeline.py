"""The whole pipeline in dependency order.

silver x4 (concurrent) -> dimensions x2 (stage load, merge; concurrent) ->
facts x2 (concurrent). Each stage starts its streams and waits for all of
them; a failed batch raises, so later stages never start on a half-done
stage and the failed job's position does not advance.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starling.plans.jobs import (
    DIMENSION_JOBS,
    FACT_JOBS,
    SILVER_SCHEMAS,
    SOURCE_TABLES,
    Lake,
    start_dimension_job,
    start_fact_job,
    start_silver_job,
)
from starling.sinks.parquet import read_partitioned
from starling.sinks.warehouse import Warehouse
from starling.sources.bronze import read_bronze
from starling.streaming.incremental import await_all


def run_pipeline(spark: SparkSession, lake: Lake, warehouse: Warehouse, run_ts: str | None = None,
                 max_group_rows: int | None = None, max_files_per_trigger: int | None = None) -> Lake:
    await_all([q for t in SOURCE_TABLES
               if (q := start_silver_job(spark, lake, t, run_ts, max_files_per_trigger)) is not None])
    await_all([q for t in DIMENSION_JOBS
               if (q := start_dimension_job(spark, lake, warehouse, t, max_group_rows,
                                            max_files_per_trigger)) is not None])
    await_all([q for t in FACT_JOBS
               if (q := start_fact_job(spark, lake, warehouse, t,
                                       max_files_per_trigger=max_files_per_trigger)) is not None])
    return lake


def _count(df: DataFrame, layer: str, table: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(layer).alias("layer"), F.lit(table).alias("table_name"), "rows")


def layer_counts(spark: SparkSession, lake: Lake, warehouse: Warehouse) -> DataFrame:
    """Rows per layer and table, as one union of Spark aggregates."""
    parts = []
    for t in SOURCE_TABLES:
        parts.append(_count(read_bronze(spark, lake.bronze(t)), "bronze", t))
        parts.append(_count(read_partitioned(spark, lake.silver(t), SILVER_SCHEMAS[t]), "silver", t))
    for t, (stage_table, _schema, spec) in DIMENSION_JOBS.items():
        parts.append(_count(warehouse.table(stage_table), "stage", stage_table))
        dim = lake.dimension(spark, spec).dimension()
        parts.append(_count(dim, "dimension", spec.name))
        parts.append(_count(dim.where(F.col("active_flag") == 1), "dimension_active", spec.name))
    for t, (fact_table, _schema) in FACT_JOBS.items():
        parts.append(_count(warehouse.table(fact_table), "fact", fact_table))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
