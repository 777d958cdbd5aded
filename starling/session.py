"""Session construction and the shared working folder.

On a cluster the folder named by ``spark.checkpoint.dir`` is shared by the
driver and all executors, so every intermediate table, stream checkpoint and
dimension version lives below it. Only in local mode (tests, a laptop) do we
create one ourselves where it is unset.
"""

from __future__ import annotations

import gc
import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def build_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "starling",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session with the settings the jobs are designed around.

    AQE re-plans joins and coalesces/splits shuffle partitions at run time;
    skew-join splitting covers hot keys in the merge joins. The session time
    zone is UTC so audit timestamps are independent of the host.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "static",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The shared folder of the cluster (``spark.checkpoint.dir``).

    Read from the session. Where it is unset, a folder is created (and
    registered as the checkpoint dir) only if driver and executors are one
    local process; elsewhere a folder of the driver's machine would be lost
    with it, so that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that all machines of {master} share")
        root = tempfile.mkdtemp(prefix="starling-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def free_shuffle_files(spark: SparkSession) -> None:
    """Let go of the shuffle files of frames that nothing refers to any more:
    Spark deletes them once the driver's JVM has collected the frames."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def shared_path(spark: SparkSession, *parts: str, unique: bool = False) -> str:
    """A path below the shared folder; ``unique`` appends a fresh run id."""
    segs = ["starling", *parts]
    if unique:
        segs.append(uuid.uuid4().hex[:12])
    return shared_root(spark) + "/" + "/".join(s.strip("/") for s in segs)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop file system of the session (the
    shared folder may be HDFS, an object store or a local path)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return bool(hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hpath))


def make_dirs(spark: SparkSession, path: str) -> None:
    """Create a folder (and parents) through the Hadoop file system."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(hpath)


def create_if_absent(spark: SparkSession, path: str) -> bool:
    """Create an empty file unless it exists; False if it did. Of several
    callers at most one gets True, as far as the file system creates files
    atomically (HDFS, local disks, object stores with conditional writes)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    try:
        fs.create(hpath, False).close()
        return True
    except Py4JJavaError:
        if fs.exists(hpath):
            return False
        raise


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small new file: under a hidden name first, then renamed, so that
    a reader of the folder sees all of it or nothing."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    hidden = jvm.org.apache.hadoop.fs.Path(hpath.getParent(), f"_{uuid.uuid4().hex}")
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = fs.create(hidden, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if not fs.rename(hidden, hpath):
        raise OSError(f"{path}: could not be written")


def read_text(spark: SparkSession, path: str) -> str:
    """A small file as text, through the Hadoop file system."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    stream = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(hpath)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of all files and folders in ``path`` (one listing); none if absent."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [st.getPath().getName() for st in fs.listStatus(hpath)] if fs.exists(hpath) else []


def delete_path(spark: SparkSession, path: str) -> bool:
    """Recursive delete through the Hadoop file system; True if it existed."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath)) and bool(fs.delete(hpath, True))


def list_dir_names(spark: SparkSession, path: str, require: str | None = None) -> list[str]:
    """Names of the sub-folders of ``path`` (metadata only, no job); with
    ``require``, only those that contain that file (e.g. ``_SUCCESS``)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(hpath):
        return []
    names = []
    for st in fs.listStatus(hpath):
        if st.isDirectory():
            sub = st.getPath()
            if require is None or fs.exists(jvm.org.apache.hadoop.fs.Path(sub, require)):
                names.append(sub.getName())
    return names


def modified(spark: SparkSession, path: str) -> int | None:
    """When a file or folder was last changed (ms); None if absent."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return int(fs.getFileStatus(hpath).getModificationTime()) if fs.exists(hpath) else None


def content_bytes(spark: SparkSession, path: str) -> int:
    """Bytes stored below ``path`` (file-system metadata, no job); 0 if absent."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return int(fs.getContentSummary(hpath).getLength()) if fs.exists(hpath) else 0


def conf_bytes(spark: SparkSession, key: str, default: str) -> int:
    """A size setting such as ``64MB`` or ``67108864b`` in bytes."""
    text = str(spark.conf.get(key, default)).strip().lower().rstrip("b")
    units = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}
    return int(float(text[:-1]) * units[text[-1]]) if text and text[-1] in units else int(float(text))
