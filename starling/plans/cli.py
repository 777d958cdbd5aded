"""Command-line jobs (B1-B10 with named arguments), for spark-submit or
``python -m starling.plans.cli``.

    silver    --root R --table customer|product|orders|orderdetails [--run-ts T] [--max-files N] [--by-name]
    dimension --root R --table customer|product --warehouse DB [--max-group-rows N] [--max-files N]
    fact      --root R --table orders|orderdetails --warehouse DB [--mode append|truncate_load] [--max-files N] [--sketches]
    pipeline  --root R --warehouse DB [--run-ts T] [--max-files N]
    statistics --root R --table orders|orderdetails --warehouse DB
    journal   --root R [--compact]
    snapshot  --root R --table NAME --jdbc-url URL --source-table T [--partition-column C --lower L --upper U]
    snapshot  --root R --like PATTERN --jdbc-url URL --source-schema S
    register  --root R [--like PATTERN]
    vacuum    --root R --table customer|product [--keep N]

``--root`` is the lake root (a shared folder); the warehouse database is
created at ``<root>/warehouse`` when absent. Each command ends with a non-zero
status when a batch failed; the job's position then stays where it was. The
runs and loads of silver, dimension, fact and pipeline are kept in the
journal at ``<root>/_journal``.
"""

from __future__ import annotations

import argparse
import json
import sys
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

from starling.plans.jobs import (
    DIMENSION_JOBS,
    FACT_JOBS,
    SOURCE_TABLES,
    Lake,
    snapshot_tables,
    start_dimension_job,
    start_fact_job,
    start_silver_job,
)
from starling.plans.pipeline import layer_counts, run_pipeline
from starling.sinks.jdbc import read_table
from starling.sinks.warehouse import Warehouse
from starling.sources.bronze import register_raw_table, select_tables, snapshot_to_bronze
from starling.streaming.incremental import await_all
from starling.streaming.journal import Journal


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="starling")
    sub = p.add_subparsers(dest="command", required=True)

    def add(name: str) -> argparse.ArgumentParser:
        sp = sub.add_parser(name)
        sp.add_argument("--root", required=True, help="lake root (shared folder)")
        sp.add_argument("--db-name", default="salesdb")
        return sp

    s = add("silver")
    s.add_argument("--table", required=True, choices=SOURCE_TABLES)
    s.add_argument("--run-ts")
    s.add_argument("--max-files", type=int)
    s.add_argument("--by-name", action="store_true", help="read each file by its header names")
    d = add("dimension")
    d.add_argument("--table", required=True, choices=list(DIMENSION_JOBS))
    d.add_argument("--warehouse", default="sales")
    d.add_argument("--max-group-rows", type=int)
    d.add_argument("--max-files", type=int)
    f = add("fact")
    f.add_argument("--table", required=True, choices=list(FACT_JOBS))
    f.add_argument("--warehouse", default="sales")
    f.add_argument("--mode", default="append", choices=["append", "truncate_load"])
    f.add_argument("--max-files", type=int)
    f.add_argument("--sketches", action="store_true", help="keep mergeable column statistics of each load")
    st = add("statistics")
    st.add_argument("--table", required=True, choices=list(FACT_JOBS))
    st.add_argument("--warehouse", default="sales")
    j = add("journal")
    j.add_argument("--compact", action="store_true", help="first move the single entries into a Parquet folder")
    pl = add("pipeline")
    pl.add_argument("--max-files", type=int)
    pl.add_argument("--warehouse", default="sales")
    pl.add_argument("--run-ts")
    sn = add("snapshot")
    one = sn.add_mutually_exclusive_group(required=True)
    one.add_argument("--table")
    one.add_argument("--like", help="every table of --source-schema that matches")
    sn.add_argument("--jdbc-url", required=True)
    sn.add_argument("--source-table")
    sn.add_argument("--source-schema")
    sn.add_argument("--partition-column")
    sn.add_argument("--lower", type=int)
    sn.add_argument("--upper", type=int)
    sn.add_argument("--run-ts")
    r = add("register")
    r.add_argument("--like", default="%")
    v = add("vacuum")
    v.add_argument("--table", required=True, choices=list(DIMENSION_JOBS))
    v.add_argument("--keep", type=int, default=2)
    return p


@contextmanager
def journalled(spark: SparkSession, lake: Lake) -> Iterator[None]:
    """Keep the runs of the streams started meanwhile in the lake's journal,
    those that fail too."""
    with Journal(spark, f"{lake.root.rstrip('/')}/_journal") as lake.journal:
        try:
            yield
        finally:
            try:
                lake.journal.settle()
            except TimeoutError as late:  # the job's outcome stands without its last entry
                print(json.dumps({"journal": str(late)}), file=sys.stderr)


def run(args: argparse.Namespace, spark: SparkSession) -> dict:
    lake = Lake(args.root, db_name=args.db_name)
    if args.command in ("silver", "dimension", "fact", "pipeline"):
        with journalled(spark, lake):
            return run_job(args, spark, lake)
    return run_job(args, spark, lake)


def run_job(args: argparse.Namespace, spark: SparkSession, lake: Lake) -> dict:

    def warehouse() -> Warehouse:
        return Warehouse(spark, args.warehouse, f"{args.root.rstrip('/')}/warehouse")

    if args.command == "silver":
        await_all([q for q in [start_silver_job(spark, lake, args.table, args.run_ts, args.max_files,
                                                args.by_name)] if q])
        return {"job": "silver", "table": args.table}
    if args.command == "dimension":
        await_all([q for q in [start_dimension_job(spark, lake, warehouse(), args.table, args.max_group_rows,
                                                   args.max_files)] if q])
        return {"job": "dimension", "table": args.table, "loads": [r.__dict__ for r in lake.reports]}
    if args.command == "fact":
        await_all([q for q in [start_fact_job(spark, lake, warehouse(), args.table, args.mode, args.max_files,
                                              "sketches" if args.sketches else "table")] if q])
        return {"job": "fact", "table": args.table, "loads": [r.__dict__ for r in lake.reports]}
    if args.command == "pipeline":
        wh = warehouse()
        run_pipeline(spark, lake, wh, run_ts=args.run_ts, max_files_per_trigger=args.max_files)
        counts = [r.asDict() for r in layer_counts(spark, lake, wh).collect()]  # a few dozen count rows
        return {"job": "pipeline", "counts": counts}
    if args.command == "statistics":
        stats = warehouse().column_statistics(FACT_JOBS[args.table][0])
        return {"job": "statistics", "columns": [r.asDict() for r in stats.collect()]}  # a row per column
    if args.command == "journal":
        journal = Journal(spark, f"{lake.root.rstrip('/')}/_journal")
        moved = journal.compact() if args.compact else 0
        by_status = journal.runs().groupBy("job", "status").count()
        return {"job": "journal", "compacted": moved, "runs": [r.asDict() for r in by_status.collect()]}
    if args.command == "snapshot" and args.like:
        schema = "'" + args.source_schema.replace("'", "''") + "'"
        names = read_table(spark, args.jdbc_url, "(SELECT table_name AS name FROM information_schema.tables "
                           f"WHERE table_schema = {schema}) AS t").collect()  # the schema's table names
        done = snapshot_tables(lake, lambda n: read_table(spark, args.jdbc_url, f"{args.source_schema}.{n}"),
                               [r[0] for r in names], args.like, args.run_ts)
        return {"job": "snapshot", "tables": done}
    if args.command == "snapshot":
        src = read_table(spark, args.jdbc_url, args.source_table, args.partition_column, args.lower, args.upper)
        snapshot_to_bronze(src, lake.bronze(args.table), change_ts=args.run_ts)
        return {"job": "snapshot", "table": args.table}
    if args.command == "register":
        names = select_tables(list(SOURCE_TABLES), args.like)
        return {"job": "register", "tables": [register_raw_table(spark, t, lake.bronze(t)) for t in names]}
    if args.command == "vacuum":
        store = lake.dimension(spark, DIMENSION_JOBS[args.table][2])
        return {"job": "vacuum", "table": args.table, "removed": store.vacuum(keep=args.keep)}
    raise ValueError(args.command)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    p = parser()
    args = p.parse_args(argv)
    if args.command == "snapshot" and not (args.source_schema if args.like else args.source_table):
        p.error("snapshot needs --source-schema with --like, --source-table with --table")
    if spark is None:
        from starling.session import build_session
        spark = build_session(app_name=f"starling-{args.command}")
    try:
        print(json.dumps(run(args, spark), default=str))
    except Exception as e:  # noqa: BLE001 - reported as the job status
        print(json.dumps({"job": args.command, "error": repr(e)[:2000]}), file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
