"""Fenced commit ledger of one target (T2, K7): what was loaded, by whom.

A file-source stream knows which files it took from its checkpoint alone. If
that is lost or reset, the next run takes all files again and counts its
batches from 0 again: without a ledger it would overwrite the first batches
or load their files twice. The ledger is kept beside the target, apart from
any checkpoint, and only ever grows::

    epochs/<k>, epochs/<k>.<stream>        writers in the order of their arrival
    claims/<n>, claims/<n>.<stream>.<batch>  who may write commit n, taken before
    files/commit_id=<n>/                   Parquet: the input files of commit n
    done/<n>                               commit n counts: created last
    aborted/<n>                            a claim whose output was rolled back

All but ``files`` are empty files, so that one listing of a flat folder tells
the state; the first of each pair is created only if absent and decides races.

*Commit ids* belong to the target, not to a stream: the n-th commit writes the
target's n-th batch folder or load partition, whatever the stream calls its
batch. A replayed batch (same stream, same batch id) gets its old commit id
back; if it is committed already, there is nothing to do.

*Files*: while one stream has written all commits, its checkpoint says what is
new and the ledger is only appended to. Under a new stream the files of a
batch are looked up in the ledger, and those that another commit holds are
left out, so nothing is loaded twice; the rest gets a new commit id, so nothing
is overwritten.

*Fencing*: the newest epoch owns the target. A stream that arrives for the
first time opens a new epoch and rolls back claims that others left without a
commit; a stream of an older epoch that wakes up again is refused before it
writes and again before it commits.

A target that was filled before it had a ledger is continued behind its newest
batch, or with that batch again if the stream's checkpoint is older than the
batch's folder (a replay). A stream that begins at an older batch there, or
whose checkpoint came after the batch, is refused: nothing tells what it loaded.

A checkpoint that was set back to an older copy keeps its stream id but gives
old batch ids to other files; that is refused (``RestartedBatchError``), since
its own log can no longer be trusted: start it with a fresh checkpoint, which
the ledger then fits to what is loaded.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from starling.session import create_if_absent, delete_path, list_names

#: Column of a batch that names the file of each row.
FILE_COLUMN = "_source_file"
COMMIT_SCHEMA = "file string, stream_id string, batch_id long, commit_id long"


class RestartedBatchError(ValueError):
    """A batch id given out again for another input: the stream's checkpoint
    was lost, reset or set back."""


class FencedError(RuntimeError):
    """Another stream has taken over the target."""


@dataclass(frozen=True)
class Slot:
    """The right to write one commit."""

    stream: str
    batch_id: int
    commit_id: int
    committed: bool


def with_file_column(stream: DataFrame) -> DataFrame:
    """Rows of a file scan (batch or stream) with the file each came from."""
    return stream.select("*", F.col("_metadata.file_path").alias(FILE_COLUMN))


class CommitLedger:
    def __init__(self, spark: SparkSession, path: str, rollback: Callable[[int], None] | None = None,
                 newest: Callable[[], tuple[int, int] | None] | None = None,
                 started: Callable[[], int | None] | None = None):
        """``rollback(commit_id)`` removes what an abandoned claim has written;
        ``newest()`` gives the newest batch of a target that has no ledger yet
        and when it was written, ``started()`` when the stream's checkpoint began."""
        self.spark, self.path, self.rollback = spark, path.rstrip("/"), rollback
        self.newest, self.started = newest, started

    # ------------------------------------------------------------ reading
    def _entries(self, folder: str) -> dict[int, str]:
        """Number and name of the entries of a flat folder ("" while only the
        number is taken)."""
        out: dict[int, str] = {}
        for entry in list_names(self.spark, f"{self.path}/{folder}"):
            number, _, name = entry.partition(".")
            if number.isdigit():  # checksum files are hidden
                out[int(number)] = name or out.get(int(number), "")
        return out

    def committed(self) -> list[int]:
        return sorted(self._entries("done"))

    def files(self) -> DataFrame:
        """The files of every commit: file, stream_id, batch_id, commit_id."""
        done = self.committed()
        if not done:
            return self.spark.createDataFrame([], COMMIT_SCHEMA)
        known = self.spark.createDataFrame([(n,) for n in done], "commit_id long")
        return self.spark.read.schema(COMMIT_SCHEMA).parquet(f"{self.path}/files").join(known, "commit_id").select(
            "file", "stream_id", "batch_id", "commit_id")

    def owner(self) -> str | None:
        epochs = self._entries("epochs")
        return epochs[max(epochs)] if epochs else None

    # ------------------------------------------------------------ writing
    def begin(self, stream: str, batch_id: int) -> Slot:
        """Take the target over or make sure it is still held, and claim the
        commit of this batch."""
        first = self._own(stream, int(batch_id))
        claims, gone, name = self._entries("claims"), self._entries("aborted"), f"{stream}.{int(batch_id)}"
        mine = [n for n, who in claims.items() if who == name and n not in gone]
        if mine:
            return Slot(stream, int(batch_id), max(mine), max(mine) in self._entries("done"))
        n = max(max(claims, default=-1) + 1, first)
        while not create_if_absent(self.spark, f"{self.path}/claims/{n}"):
            n += 1  # a writer that is about to be fenced was quicker
        create_if_absent(self.spark, f"{self.path}/claims/{n}.{name}")
        return Slot(stream, int(batch_id), n, False)

    def _own(self, stream: str, batch_id: int) -> int:
        """Open an epoch for a stream that is new; refuse one that was replaced.
        Returns the least commit id that may be given out."""
        epochs = self._entries("epochs")
        newest = max(epochs, default=-1)
        filled = self.newest() if self.newest and not self._entries("claims") else None
        if epochs.get(newest) != stream:
            if stream in epochs.values():
                raise FencedError(f"{self.path}: stream {stream} was replaced by {epochs[newest]}")
            replay = filled is not None and batch_id == filled[0] and (
                began := self.started() if self.started else None) is not None and began <= filled[1]
            if filled is not None and not epochs and batch_id <= filled[0] and not replay:
                raise RestartedBatchError(
                    f"{self.path}: the target holds batches up to {filled[0]} and no ledger tells their files; "
                    f"stream {stream} begins at batch {batch_id}")
            if not create_if_absent(self.spark, f"{self.path}/epochs/{newest + 1}"):
                raise FencedError(f"{self.path}: another stream arrived together with {stream}")
            create_if_absent(self.spark, f"{self.path}/epochs/{newest + 1}.{stream}")
            self._abort_open_claims()
            if replay:
                return batch_id
        return 0 if filled is None else filled[0] + 1

    def _abort_open_claims(self) -> None:
        """Roll back what earlier owners claimed and did not commit."""
        for n in sorted(set(self._entries("claims")) - set(self._entries("done")) - set(self._entries("aborted"))):
            if self.rollback:
                self.rollback(n)
            delete_path(self.spark, f"{self.path}/files/commit_id={n}")
            create_if_absent(self.spark, f"{self.path}/aborted/{n}")

    def unseen(self, batch: DataFrame, slot: Slot) -> tuple[DataFrame, int]:
        """The rows of ``batch`` whose files no other commit holds, and the
        number of files left out. Costs nothing while one stream has written
        all commits."""
        if len(self._entries("epochs")) <= 1:
            return batch, 0
        names = batch.select(F.col(FILE_COLUMN).alias("file")).distinct()
        loaded = names.join(self.files().where(F.col("commit_id") != slot.commit_id).select("file").distinct(), "file")
        # names of one micro-batch, which the stream's source holds on the driver anyway
        known = [r.file for r in loaded.collect()]
        return (batch.where(~F.col(FILE_COLUMN).isin(known)) if known else batch), len(known)

    def check_same(self, batch: DataFrame, slot: Slot) -> None:
        """A batch that is committed already must hold no file that no commit holds."""
        names = batch.select(F.col(FILE_COLUMN).alias("file")).distinct()
        if not names.join(self.files().select("file").distinct(), "file", "left_anti").isEmpty():
            raise RestartedBatchError(
                f"{self.path}: batch {slot.batch_id} of {slot.stream} is committed, with other files: its checkpoint was set back")

    def commit(self, slot: Slot, files: list[str]) -> None:
        """Record the files of a written commit; from here on it counts."""
        if self.owner() != slot.stream:
            if self.rollback:
                self.rollback(slot.commit_id)
            raise FencedError(f"{self.path}: stream {slot.stream} was replaced by {self.owner()} while it wrote")
        rows = self.spark.createDataFrame([(f, slot.stream, slot.batch_id, slot.commit_id) for f in files], COMMIT_SCHEMA)
        rows.drop("commit_id").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/files/commit_id={slot.commit_id}")
        create_if_absent(self.spark, f"{self.path}/done/{slot.commit_id}")


def observing_files(rows: DataFrame) -> tuple[DataFrame, Callable[[], list[str]]]:
    """The rows without FILE_COLUMN, and a function that gives the names of the
    files they came from once an action has read them (observed on the way; a
    micro-batch's names are on the driver in its source, too)."""
    seen = Observation()
    observed = rows.observe(seen, F.collect_set(FILE_COLUMN).alias("files")).drop(FILE_COLUMN)
    return observed, lambda: list(seen.get["files"] or [])


def apply_once(ledger: CommitLedger, batch: DataFrame, stream: str, batch_id: int,
               write: Callable[[DataFrame, int], list[str]]) -> Slot | None:
    """Write one micro-batch (rows with FILE_COLUMN) exactly once:
    ``write(rows, commit_id)`` gets the rows of files that are not loaded yet,
    must replace whatever an earlier attempt left under that commit id, and
    returns the names of their files. Returns None where nothing was written."""
    if batch.isEmpty():
        return None
    slot = ledger.begin(stream, batch_id)
    if slot.committed:
        ledger.check_same(batch, slot)
        return None
    rows, left_out = ledger.unseen(batch, slot)
    if left_out and rows.isEmpty():
        ledger.commit(slot, [])
        return None
    ledger.commit(slot, write(rows, slot.commit_id))
    return slot
