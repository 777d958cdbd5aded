"""Bronze change files: export, discovery, registration and scans.

Change files are gzip CSV with a header. Columns are matched by **name**: the
header of the files decides the all-string schema, in header order, and the
reader checks every file's header against it (``enforceSchema=false``), so
a file whose columns moved or vanished fails the scan instead of being read
by position.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from starling.functions.audit import run_timestamp
from starling.functions.rescue import rescue_columns
from starling.schemas import OP_INSERT, text_schema
from starling.operators.rename import MissingColumnsError
from starling.sinks.parquet import write_change_files
from starling.sources.headers import header_groups


def snapshot_to_bronze(df: DataFrame, path: str, change_ts: str | None = None, mode: str = "overwrite") -> None:
    """S1 + S4: full-load export of a source table: op ``I`` on every row and
    the load time as ``dms_timestamp``; ``overwrite`` replaces an earlier
    snapshot (drop-and-create)."""
    ts = F.date_format(run_timestamp(change_ts), "yyyy-MM-dd HH:mm:ss")
    out = df.select(F.lit(OP_INSERT).alias("op"), *[F.col(f"`{c}`") for c in df.columns],
                    ts.alias("dms_timestamp"))
    write_change_files(out, path, mode=mode)


def select_tables(names: list[str], like: str = "%") -> list[str]:
    """S3: source tables matching a SQL ``LIKE`` pattern (``%`` and ``_``)."""
    rx = re.compile("^" + "".join(".*" if ch == "%" else "." if ch == "_" else re.escape(ch) for ch in like) + "$",
                    re.IGNORECASE)
    return [n for n in names if rx.match(n)]


def header_schema(spark: SparkSession, path: str, lower: bool = True) -> StructType:
    """All-string schema from the header line (no data is scanned: without
    ``inferSchema`` Spark reads just the first line)."""
    cols = spark.read.option("header", True).csv(path).columns
    return text_schema([c.lower() if lower else c for c in cols])


def read_bronze(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Batch scan of change files, columns by name."""
    schema = schema or header_schema(spark, path)
    return (spark.read.schema(schema).option("header", True).option("enforceSchema", False)
            .option("mode", "FAILFAST").csv(path))


def stream_bronze(spark: SparkSession, path: str, schema: StructType, max_files_per_trigger: int | None = None
                  ) -> DataFrame:
    """The new change files only; which files were read is kept in the
    checkpoint of the query that consumes this stream."""
    r = (spark.readStream.schema(schema).option("header", True).option("enforceSchema", False)
         .option("mode", "FAILFAST"))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.csv(path)


def read_bronze_by_name(spark: SparkSession, paths: list[str], required: list[str], rescue: bool = False) -> DataFrame:
    """Change files whose headers may differ (a source column added, columns
    moved): one job reads the first lines of all files and groups them by
    header (``sources.headers``), each group is read with its own header and
    the groups are put together by column **name**. Columns beyond
    ``required`` are dropped, or kept in a VARIANT column with ``rescue``
    (``functions.rescue``); a file lacking a required column fails the read."""
    frames = []
    for header, group in header_groups(spark, paths).items() if paths else ():
        missing = [c for c in required if c not in header]
        if missing:
            raise MissingColumnsError(f"change files {group[:3]} lack required columns {missing}")
        df = (spark.read.schema(text_schema(list(header))).option("header", True).option("enforceSchema", False)
              .option("mode", "FAILFAST").csv(group))
        frames.append(rescue_columns(df, required) if rescue else df.select(*required))
    if not frames:
        empty = spark.range(0).select(*[F.lit(None).cast("string").alias(c) for c in required])
        return rescue_columns(empty, required) if rescue else empty
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


# Fixed value: the schema of Spark's binaryFile source.
BINARY_FILE_SCHEMA = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"


def stream_file_names(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """S10 for files read by name: a stream of the new files' paths only (the
    content column is pruned, so no file is read here)."""
    r = spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path).select("path")


def register_raw_table(spark: SparkSession, table: str, path: str, schema: StructType | None = None,
                       database: str | None = None) -> str:
    """(re)register ``raw_data_<table>`` over the change files.

    The definition is rebuilt from the current header each time (drop and
    create), then the file listing is refreshed.
    """
    schema = schema or header_schema(spark, path)
    name = f"raw_data_{table.lower()}"
    qualified = f"`{database}`.`{name}`" if database else f"`{name}`"
    cols = ", ".join(f"`{f.name}` STRING" for f in schema.fields)
    spark.sql(f"DROP TABLE IF EXISTS {qualified}")
    spark.sql(
        f"CREATE TABLE {qualified} ({cols}) USING csv "
        f"OPTIONS (header 'true', enforceSchema 'false', mode 'FAILFAST') LOCATION '{path}'"
    )
    spark.sql(f"REFRESH TABLE {qualified}")
    return qualified


def read_registered(spark: SparkSession, qualified: str) -> DataFrame:
    """Scan through the catalog definition."""
    return spark.table(qualified)
