"""JDBC warehouse sink (K4-K6 over JDBC) and source reads.

Not exercised against a live database in this repository: no database may be
started in the build environment, and an embedded in-memory one is visible
to its own JVM only, so it would not model a cluster. The option sets below
are what ``DataFrameWriter.format("jdbc")`` documents.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StringType

from starling.sinks.warehouse import conform
from starling.sources.keyranges import balanced_predicates, check_splittable, range_predicates
from starling.schemas import JDBC_COLUMN_TYPES, TABLE_SCHEMAS


def writer_options(url: str, table: str, mode: str = "truncate_load", column_types: str | None = None,
                   batchsize: int = 10_000, properties: dict[str, str] | None = None) -> tuple[str, dict[str, str]]:
    """Spark save mode and options for a JDBC load.

    ``truncate_load`` = overwrite with ``truncate=true`` (the table and its
    DDL stay, rows are removed); ``append`` keeps rows. ``createTableColumnTypes``
    applies the fixed text lengths when Spark has to create the table.
    """
    opts = {"url": url, "dbtable": table, "batchsize": str(batchsize), **(properties or {})}
    if column_types:
        opts["createTableColumnTypes"] = column_types
    if mode == "truncate_load":
        opts["truncate"] = "true"
        return "overwrite", opts
    if mode == "append":
        return "append", opts
    raise ValueError(f"unknown load mode {mode!r}")


def text_key_predicates(column: str, n: int) -> list[str]:
    """``n`` conditions of which every row meets exactly one, for parallel
    reads of a table whose key is text (UUIDs): ranges between evenly spaced
    hexadecimal prefixes. Keys of another kind make the ranges uneven, never
    incomplete; rows without a key are in the first."""
    cuts = [f"{i * 65536 // n:04x}" for i in range(1, n)]
    if not cuts:
        return ["1 = 1"]
    inner = [f"{column} >= '{a}' AND {column} < '{b}'" for a, b in zip(cuts, cuts[1:])]
    return [f"({column} < '{cuts[0]}' OR {column} IS NULL)", *inner, f"{column} >= '{cuts[-1]}'"]


def write_table(df: DataFrame, url: str, schema_name: str, table: str, mode: str = "truncate_load",
                max_connections: int = 8, properties: dict[str, str] | None = None) -> None:
    """Load ``df`` into ``schema_name.table`` over JDBC; at most
    ``max_connections`` tasks write concurrently (a repartition, so that what
    comes before keeps its own parallelism)."""
    target = TABLE_SCHEMAS.get(table)
    out = conform(df, target) if target is not None else df
    save_mode, opts = writer_options(url, f"{schema_name}.{table}", mode, JDBC_COLUMN_TYPES.get(table),
                                     properties=properties)
    out.repartition(max_connections).write.format("jdbc").mode(save_mode).options(**opts).save()


def read_by_ranges(read: Callable[..., DataFrame], table: str, columns: Sequence[str], num_partitions: int = 8) -> DataFrame:
    """The whole table in ``num_partitions`` parallel range reads of like
    size. ``read(table, columns=None, predicates=None)`` reads it (or some of
    its columns), one task for each predicate. The types of the key columns come
    from the table's own schema; the bounds from a sample of the keys, which is
    itself read in parallel: a number between its least and largest value, text
    by evenly spaced prefixes, other keys in one piece."""
    keys = read(table, columns=list(columns))
    first = check_splittable(keys.schema, columns)[0]
    if isinstance(first, StringType):
        keys = read(table, columns=list(columns), predicates=text_key_predicates(columns[0], num_partitions))
    elif isinstance(first, IntegralType):
        low, high = keys.agg(F.min(columns[0]), F.max(columns[0])).first()
        if low is not None and high > low:
            step = (high - low) / num_partitions
            cuts = sorted({int(low + step * k) for k in range(1, num_partitions)} - {low})
            keys = read(table, columns=list(columns), predicates=range_predicates(columns, [(c,) for c in cuts]))
    return read(table, predicates=balanced_predicates(keys, columns, num_partitions))


def read_table(spark: SparkSession, url: str, table: str, partition_column: str | None = None,
               lower_bound: int | None = None, upper_bound: int | None = None, num_partitions: int = 8,
               fetchsize: int = 10_000, properties: dict[str, str] | None = None) -> DataFrame:
    """Snapshot read of a source table, ``num_partitions`` parallel
    range reads: evenly spaced on a numeric ``partition_column`` that is given
    with its bounds; without bounds, by quantiles of a sample of the key (a
    comma-separated list of columns cuts values that many rows share)."""
    if partition_column is not None and lower_bound is None:
        keys = [c.strip() for c in partition_column.split(",")]

        def read(name, columns=None, predicates=None):
            source = f"(SELECT {', '.join(columns)} FROM {name}) AS keys" if columns else name
            options = {"fetchsize": str(fetchsize), **(properties or {})}
            if predicates:
                return spark.read.jdbc(url, source, predicates=predicates, properties=options)
            return spark.read.jdbc(url, source, properties=options)

        return read_by_ranges(read, table, keys, num_partitions)
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table).option("fetchsize", str(fetchsize))
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    if partition_column is not None:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", str(lower_bound))
             .option("upperBound", str(upper_bound)).option("numPartitions", str(num_partitions)))
    return r.load()
