"""Silver Parquet sink (K2, K3) and change-file CSV sink (K1)."""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import LongType, StructField, StructType

from starling.operators.sort import layout_for_write

# Folder names of the lake layout.
SILVER_FOLDER = "silver-data"
BRONZE_FOLDER = "bronze-data"


def silver_path(root: str, db_name: str, table: str) -> str:
    """K3: ``<root>/silver-data/<db>/<table>``."""
    return f"{root.rstrip('/')}/{SILVER_FOLDER}/{db_name}/{table}"


def bronze_path(root: str, db_name: str, table: str) -> str:
    return f"{root.rstrip('/')}/{BRONZE_FOLDER}/{db_name}/{table}"


def write_partitioned(df: DataFrame, path: str, partition_col: str, order_col: str | None = None,
                      mode: str = "append") -> None:
    """K2: Parquet partitioned by ``partition_col``.

    ``layout_for_write`` rebalances on the partition key (AQE splits a hot
    value into several files) and sorts inside each task, key first, so the
    writer does not sort again and every file is ordered by ``order_col``.
    """
    layout_for_write(df, partition_col, order_col).write.mode(mode).partitionBy(partition_col).parquet(path)


def write_batch(df: DataFrame, path: str, batch_id: int, partition_col: str, order_col: str | None = None) -> str:
    """Replay-safe append: batch ``n`` owns ``<path>/batch_id=<n>/`` and a
    replay overwrites exactly that directory, even if its run date (hence the
    partition values inside) differs from the first attempt."""
    target = f"{path.rstrip('/')}/batch_id={int(batch_id)}"
    write_partitioned(df, target, partition_col, order_col, mode="overwrite")
    return target


def read_partitioned(spark: SparkSession, path: str, schema: StructType, with_batch_id: bool = True) -> DataFrame:
    """Read a silver dataset with an explicit schema (an empty or
    half-written dataset must not need inference)."""
    fields = list(schema.fields)
    if with_batch_id and "batch_id" not in schema.fieldNames():
        fields.append(StructField("batch_id", LongType(), True))
    return spark.read.schema(StructType(fields)).option("basePath", path).parquet(path)


def write_change_files(df: DataFrame, path: str, mode: str = "append") -> None:
    """K1: gzip CSV with header, ``,`` separator and ``\\n`` line ends, at the
    fastest level: half the time of the default one, files a quarter larger."""
    (df.write.mode(mode).option("header", True).option("sep", ",").option("lineSep", "\n")
     .option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").csv(path))


def write_all_change_files(frames: Mapping[str, DataFrame], mode: str = "append", parallel: int = 8) -> None:
    """K1 for several tables (rows by folder), ``parallel`` at a time, so that
    a table of few tasks does not hold up the others. All have ended when the
    first error is raised."""
    with ThreadPoolExecutor(parallel) as pool:
        writes = [pool.submit(write_change_files, rows, path, mode) for path, rows in frames.items()]
    for write in writes:
        write.result()
