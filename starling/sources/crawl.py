"""Distributed schema crawl of change files.

Every value of every file is classed by what it can be read as, and the classes
are folded into one type per column along the lattice

    (no value) < long < decimal < double < text
    (no value) < date < timestamp < text

A class is a bit, so a column's classes in a partition are one OR; with the
most integer digits, the most decimals, the number of rows and of missing
values they are all that is needed of it. Each task folds its rows into one
partial row per column and file, and these are merged into one schema: data
is read once, nothing but the partial rows is shuffled, and merging is
associative, so a crawl of new files can be merged with the stored result of
an earlier one (``merge``).

Files may differ in header; their groups are read by name
(``headers.header_groups``). A value that is empty counts as missing, as the
change files write no other null.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starling.schemas import text_schema
from starling.sources.headers import header_groups

#: One bit for each class of values.
LONG, DECIMAL, DOUBLE, DATE, TIMESTAMP, TEXT = 1, 2, 4, 8, 16, 32
#: Digits that a decimal type holds.
DECIMAL_DIGITS = 38

FOLDED = ["position", "column_name", "file", "classes", "whole_digits", "decimals", "rows", "missing"]


def value_class(value: Column) -> Column:
    """The bit of the narrowest class that holds a text; 0 for none or empty."""
    v = F.trim(value)
    number = v.rlike(r"^[+-]?\d+$")
    return (F.when(value.isNull() | (v == ""), 0)
            .when(number & v.try_cast("long").isNotNull(), LONG)
            .when(v.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)$") & (F.length(F.regexp_replace(v, "[^0-9]", "")) <= DECIMAL_DIGITS), DECIMAL)
            .when(v.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), DOUBLE)
            .when(v.rlike(r"^\d{4}-\d{2}-\d{2}$") & v.try_cast("date").isNotNull(), DATE)
            .when(v.rlike(r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?$") & v.try_cast("timestamp_ntz").isNotNull(),
                  TIMESTAMP)
            .otherwise(TEXT))


def fold(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row (FOLDED) per column and file of a scan with column ``file``."""
    parts = []
    for k, c in enumerate(columns):
        v = F.col(f"`{c}`")
        bits = value_class(v)
        number = bits.isin(LONG, DECIMAL)
        whole = F.length(F.regexp_extract(F.trim(v), r"^[+-]?0*(\d*)", 1))
        after = F.length(F.regexp_extract(F.trim(v), r"\.(\d*)$", 1))
        parts.append(F.struct(
            F.bit_or(bits).alias("classes"), F.max(F.when(number, whole)).alias("whole_digits"),
            F.max(F.when(number, after)).alias("decimals"), F.count(F.lit(1)).alias("rows"),
            F.count_if(bits == 0).alias("missing"), F.lit(k).alias("position"), F.lit(c).alias("column_name")))
    folded = rows.groupBy("file").agg(F.array(*parts).alias("parts"))
    return folded.select("file", F.explode("parts").alias("p")).select("file", "p.*").select(*FOLDED)


def crawl_files(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """FOLDED rows of the files, read by name in one scan per distinct header."""
    folds = []
    for header, files in header_groups(spark, paths).items():
        scan = (spark.read.schema(text_schema(list(header))).option("header", True).option("enforceSchema", False)
                .option("mode", "FAILFAST").csv(files))
        columns = [F.col(f"`{c}`") for c in header]
        folds.append(fold(scan.select(*columns, F.col("_metadata.file_path").alias("file")), header))
    if not folds:
        raise FileNotFoundError(f"no file with a header in {paths}")
    return reduce(DataFrame.unionByName, folds)


def type_name(classes: Column, whole: Column, decimals: Column) -> Column:
    """The least type above all classes of a column."""
    has = lambda *bits: classes.bitwiseAND(sum(bits)) != 0
    digits = F.coalesce(whole, F.lit(0)) + F.coalesce(decimals, F.lit(0))
    numbers, times = has(LONG, DECIMAL, DOUBLE), has(DATE, TIMESTAMP)
    return (F.when(classes == 0, "void").when(has(TEXT) | (numbers & times), "string")
            .when(has(DOUBLE) | (has(DECIMAL) & (digits > DECIMAL_DIGITS)), "double")
            .when(has(DECIMAL), F.concat(F.lit("decimal("), F.greatest(digits, F.lit(1)).cast("string"), F.lit(","),
                                         F.coalesce(decimals, F.lit(0)).cast("string"), F.lit(")")))
            .when(numbers, "bigint").when(has(TIMESTAMP), "timestamp").otherwise("date"))


def merge(folded: DataFrame) -> DataFrame:
    """One row per column of FOLDED rows, in the order in which columns stand in
    the files: position, column_name, data_type, nullable (a value is missing,
    or a file lacks the column), files (that hold it), rows, missing."""
    total = folded.agg(F.count_distinct("file").alias("all_files"))
    columns = folded.groupBy("column_name").agg(
        F.min("position").alias("position"), F.bit_or("classes").alias("classes"), F.max("whole_digits").alias("whole"),
        F.max("decimals").alias("decimals"), F.count_distinct("file").alias("files"), F.sum("rows").alias("rows"),
        F.sum("missing").alias("missing"))
    kind = type_name(F.col("classes"), F.col("whole"), F.col("decimals"))
    return columns.join(F.broadcast(total)).select(  # one row
        "position", "column_name", kind.alias("data_type"),
        ((F.col("missing") > 0) | (F.col("files") < F.col("all_files"))).alias("nullable"), "files", "rows", "missing")


def crawl(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """The schema of all files below ``paths``."""
    return merge(crawl_files(spark, paths))


def register_typed_view(spark: SparkSession, name: str, raw: DataFrame, schema: DataFrame) -> None:
    """A temporary view of raw text rows cast to the crawled types (S6: made
    anew at every crawl). Values that the cast cannot read do not occur, since
    the type holds every value that was seen."""
    types = {r.column_name: r.data_type for r in schema.collect()}  # one row per column
    cast = lambda c: F.nullif(F.trim(F.col(f"`{c}`")), F.lit("")).cast(
        "string" if types.get(c, "string") == "void" else types.get(c, "string"))
    raw.select(*[(F.col(f"`{c}`") if types.get(c, "string") == "string" else cast(c)).alias(c) for c in raw.columns]
               ).createOrReplaceTempView(name)
