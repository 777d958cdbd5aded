"""Header lines of many change files in one distributed pass.

Change files of one batch may carry different headers: a column was added at
the source, two were moved. Reading them by name needs every file's header,
which is its first line alone. One job reads the first lines of all files: a
file is one partition whatever its size, and its task takes one row and ends,
so that neither the rest of a large file nor the driver is involved. What comes
back is one row per *distinct* header with its files.
"""

from __future__ import annotations

import csv
from collections.abc import Sequence
from itertools import islice

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

HEADER_SCHEMA = "file string, columns array<string>"


def first_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(file, columns) of each file: the names in its first line, lower case;
    files without a line are left out."""
    # a session of its own, so that the split settings reach this scan alone
    alone = spark.newSession()
    alone.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 50))
    alone.conf.set("spark.sql.files.openCostInBytes", str(1 << 50))
    lines = alone.read.text(paths if isinstance(paths, str) else list(paths)).select(
        F.col("_metadata.file_path").alias("file"), "value")

    def header(rows):
        for r in islice(rows, 1):  # the task ends here
            names = next(csv.reader([r.value.lstrip("﻿")]), [])
            yield r.file, [n.strip().lower() for n in names]

    return spark.createDataFrame(lines.rdd.mapPartitions(header), HEADER_SCHEMA)


def header_groups(spark: SparkSession, paths: str | Sequence[str]) -> dict[tuple[str, ...], list[str]]:
    """The distinct headers and their files. The names of the files are those
    of one micro-batch, bounded by the trigger that chose them."""
    rows = first_lines(spark, paths).groupBy("columns").agg(F.sort_array(F.collect_list("file")).alias("files")).collect()
    return {tuple(r["columns"]): list(r["files"]) for r in sorted(rows, key=lambda r: r["files"][0])}
