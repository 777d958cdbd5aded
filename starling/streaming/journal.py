"""Load journal (A2, A3): what every job run did, in an append-only table.

Reports of a run live in the driver's memory and end with it. The journal is a
folder of JSON lines in the shared folder; an entry is written once, under a
name of its own, and never changed, so any number of drivers may append. Entries:

* ``started``, ``ended``, ``failed``: a run of a stream, from Spark's listener
  (``failed`` carries the line of its innermost cause);
* ``batch``: a micro-batch whose position is durable, from the listener (the
  rows are in the loads: Spark counts a micro-batch's input once per action);
* ``load``: a warehouse load inside a micro-batch, from the job itself: table,
  mode, rows read and written, NULLs of parsed columns, input schema.

A load counts once its batch is durable: a batch that failed after its load is
taken again, and its first load was replaced by the second. ``loads()`` keeps,
of a batch's loads of one table, the last, and says whether the batch is
durable; ``runs()`` gives a row per run.

The listener is told of events a little later than they happen; ``settle``
waits until the ends of the given runs are written.

``compact`` rewrites the entries written so far as Parquet files, since a journal of
single entries would be a table of small files.

Defined cases: an empty journal gives no rows; a driver that dies leaves runs
without an end, status ``open``, and perhaps a batch that was made durable just
before it and is not marked so until the stream goes on; entries of one instant are ordered by their sequence
number within their driver. A driver's clock orders entries of different drivers.
"""

from __future__ import annotations

import json
import threading
import time
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from starling.session import delete_path, list_dir_names, list_names, make_dirs, write_text
from starling.sinks.warehouse import LoadReport

ENTRY_SCHEMA = (
    "at_ms long, writer string, seq long, event string, job string, stream_id string, run_id string, batch_id long, "
    "table_name string, load_mode string, rows_read long, rows_written long, null_values long, "
    "input_schema string, error string")


class _Listener(StreamingQueryListener):
    def __init__(self, journal: Journal):
        self.journal, self.jobs = journal, {}

    def onQueryStarted(self, event) -> None:
        self.jobs[str(event.runId)] = event.name
        self.journal.append("started", job=event.name, stream_id=str(event.id), run_id=str(event.runId))

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.journal.append("batch", job=p.name, stream_id=str(p.id), run_id=str(p.runId), batch_id=int(p.batchId))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        run = str(event.runId)
        # stack frames are indented; the innermost cause is the last line that is not
        lines = [x for x in (event.exception or "").splitlines() if x.strip() and not x[0].isspace()]
        self.journal.append("failed" if event.exception else "ended", job=self.jobs.pop(run, None),
                            stream_id=str(event.id), run_id=run, error=lines[-1][:1000] if lines else None)


class Journal:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.writer = spark, path.rstrip("/"), uuid.uuid4().hex
        self._seq, self._begun, self._ends, self._lock = 0, set(), set(), threading.Condition()
        self._listener: _Listener | None = None
        make_dirs(spark, self.path + "/entries")

    # ------------------------------------------------------------ writing
    def append(self, event: str, **fields) -> None:
        with self._lock:
            self._seq += 1
            seq = self._seq
        entry = {"at_ms": int(time.time() * 1000), "writer": self.writer, "seq": seq, "event": event, **fields}
        write_text(self.spark, f"{self.path}/entries/{entry['at_ms']}-{self.writer}-{seq}.json", json.dumps(entry) + "\n")
        if event in ("started", "ended", "failed"):
            with self._lock:
                (self._begun if event == "started" else self._ends).add(fields["run_id"])
                self._lock.notify_all()

    def load(self, report: LoadReport, batch: DataFrame, batch_id: int) -> None:
        """Record a load that was done for a micro-batch."""
        get = batch.sparkSession.sparkContext.getLocalProperty
        self.append("load", stream_id=get("sql.streaming.queryId"), batch_id=int(batch_id),
                    table_name=report.table, load_mode=report.mode, rows_read=report.rows_read,
                    rows_written=report.rows_written, null_values=report.null_values, input_schema=report.schema)

    def __enter__(self) -> Journal:
        """Listen to the streams of the session until the block ends."""
        self._listener = _Listener(self)
        self.spark.streams.addListener(self._listener)
        return self

    def __exit__(self, *_exc) -> None:
        self.spark.streams.removeListener(self._listener)
        self._listener = None

    def settle(self, queries: Iterable[StreamingQuery | None] | None = None, seconds: float = 60) -> None:
        """Wait until the ends of these (terminated) runs are written; without
        ``queries``, those of all runs that began while listening."""
        runs = self._begun if queries is None else {str(q.runId) for q in queries if q is not None}
        with self._lock:
            if not self._lock.wait_for(lambda: runs <= self._ends, timeout=seconds):
                raise TimeoutError(f"{self.path}: no end of runs {sorted(runs - self._ends)} within {seconds} s")

    def compact(self) -> int:
        """Move the single entries into one Parquet folder; returns how many.
        A crash between its commit and the deletion leaves entries twice,
        which ``entries()`` reads once. One driver at a time may compact."""
        names = [n for n in list_names(self.spark, self.path + "/entries") if n.endswith(".json")]
        if not names:
            return 0
        rows = self.spark.read.schema(ENTRY_SCHEMA).json([f"{self.path}/entries/{n}" for n in names])
        rows.coalesce(1).write.parquet(f"{self.path}/compacted/{uuid.uuid4().hex}")
        for n in names:
            delete_path(self.spark, f"{self.path}/entries/{n}")
        return len(names)

    # ------------------------------------------------------------ reading
    def entries(self) -> DataFrame:
        rows = self.spark.read.schema(ENTRY_SCHEMA).json(self.path + "/entries")
        old = [f"{self.path}/compacted/{n}" for n in list_dir_names(self.spark, self.path + "/compacted", "_SUCCESS")]
        if old:
            rows = rows.unionByName(self.spark.read.schema(ENTRY_SCHEMA).parquet(*old))
        return rows.dropDuplicates(["writer", "seq"])

    def runs(self) -> DataFrame:
        """A row per run: job, stream_id, run_id, run_number (of its job, by
        start), status (``ended``, ``failed``, ``open``), error, batches
        made durable."""
        e = self.entries().where(F.col("run_id").isNotNull())
        runs = e.groupBy("stream_id", "run_id").agg(
            F.max("job").alias("job"), F.min(F.struct("at_ms", "writer", "seq")).alias("_first"),
            F.coalesce(F.max(F.when(F.col("event").isin("ended", "failed"), F.col("event"))), F.lit("open")).alias("status"),
            F.max("error").alias("error"),
            F.count_distinct(F.when(F.col("event") == "batch", F.col("batch_id"))).alias("batches"))
        number = F.row_number().over(Window.partitionBy("job").orderBy("_first"))
        return runs.select("job", "stream_id", "run_id", number.alias("run_number"), "status", "error", "batches")

    def loads(self) -> DataFrame:
        """A row per (stream_id, batch_id, table_name): the last load of it,
        ``attempts`` and whether the batch is ``durable``: the listener saw its
        end, or the stream has gone on to a later batch, which it does only then."""
        e = self.entries()
        durable = e.groupBy("stream_id").agg(F.max(
            F.when(F.col("event") == "batch", F.col("batch_id")).when(F.col("event") == "load", F.col("batch_id") - 1)).alias("_upto"))
        what = ["load_mode", "rows_read", "rows_written", "null_values", "input_schema"]
        last = e.where("event = 'load'").groupBy("stream_id", "batch_id", "table_name").agg(
            F.max_by(F.struct(*what), F.struct("at_ms", "writer", "seq")).alias("_last"),
            F.count(F.lit(1)).alias("attempts"))
        return last.join(durable, "stream_id").select(
            "stream_id", "batch_id", "table_name", "_last.*", "attempts", (F.col("batch_id") <= F.col("_upto")).alias("durable"))
