"""Session construction and the shared scratch location.

Everything that must outlive a task (fixture tables, stream checkpoints,
incremental outputs written by tests) goes under the directory the cluster
names in ``spark.checkpoint.dir``. Only when that is unset (local runs, tests)
do we create one of our own.
"""

from __future__ import annotations

import datetime as _dt
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A day holding a large share of the trips is split across writer tasks
    # by the REBALANCE before every partitioned write.
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Only matters for tiny shuffles: keep several writer tasks when a small
    # batch fans out into many day folders (large partitions are sized by
    # spark.sql.adaptive.advisoryPartitionSizeInBytes as usual).
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    # The JVM does not compile methods beyond 8,000 bytes; the curated layer's 38 expressions
    # in one method are longer, and are evaluated in several ones under this limit.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = "local[*]", app: str = "tripspark",
                  shuffle_partitions: int | None = 8,
                  conf: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings every layer relies on.

    ``spark.sql.session.timeZone=UTC`` matters for correctness: raw timestamps
    without a zone are cast with the session zone (SURVEY §1.4-12).
    """
    b = SparkSession.builder.appName(app)
    if master:  # None: keep what spark-submit / the cluster configured
        b = b.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for k, v in settings.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@contextmanager
def session_settings(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Settings for the jobs that are started inside; the session's own ones come back afterwards."""
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _configured_checkpoint_dir(spark: SparkSession) -> str | None:
    value = spark.conf.get("spark.checkpoint.dir", None)
    if value:
        return value
    value = spark.sparkContext._conf.get("spark.checkpoint.dir", None)
    if value:
        return value
    try:
        return spark.sparkContext.getCheckpointDir()
    except Exception:  # pragma: no cover - older API
        return None


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for materialised intermediate tables and checkpoints.

    Reads ``spark.checkpoint.dir`` from the session. If it is unset and the
    master is local (tests), a private directory is created and registered as
    the checkpoint dir; on a cluster an unset value is an error, because a
    machine-local folder is not visible to other executors.
    """
    root = _configured_checkpoint_dir(spark)
    if root:
        return root.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tripspark-ckpt-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")  # as the next call finds it


def new_scratch_dir(spark: SparkSession, kind: str) -> str:
    """A fresh, never reused sub folder of the scratch root."""
    return f"{scratch_root(spark)}/{kind}-{uuid.uuid4().hex[:12]}"


def _hadoop_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, p


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop FileSystem (works for any scheme)."""
    fs, p = _hadoop_path(spark, path)
    return bool(fs.exists(p))


def path_stamp(spark: SparkSession, path: str) -> tuple[int, int]:
    """(bytes, modification time) of a file or folder, through the Hadoop FileSystem."""
    fs, p = _hadoop_path(spark, path)
    newest = max([fs.getFileStatus(p).getModificationTime()]
                 + [f.getModificationTime() for f in fs.listStatus(p)])
    return int(fs.getContentSummary(p).getLength()), int(newest)


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a file or folder if it is there."""
    fs, p = _hadoop_path(spark, path)
    fs.delete(p, True)


def set_modification_time(spark: SparkSession, path: str, when: _dt.datetime) -> None:
    fs, p = _hadoop_path(spark, path)
    fs.setTimes(p, int(when.timestamp() * 1000), -1)


def read_text(spark: SparkSession, path: str) -> str | None:
    """Contents of a small text file; None if it is not there."""
    fs, p = _hadoop_path(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text file, replacing it."""
    fs, p = _hadoop_path(spark, path)
    stream = fs.create(p, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def publish(spark: SparkSession, source: str, target: str) -> None:
    """Put a complete folder or file in the place of ``target`` by renaming it; readers see the old
    one, none, or the new one, but never a part. Both must be in one file system."""
    fs, there = _hadoop_path(spark, target)
    fs.delete(there, True)
    fs.mkdirs(there.getParent())
    if not fs.rename(_hadoop_path(spark, source)[1], there):
        raise OSError(f"{source} could not be renamed to {target}")


def same_file_system(spark: SparkSession, a: str, b: str) -> bool:
    return str(_hadoop_path(spark, a)[0].getUri().toString()) == str(_hadoop_path(spark, b)[0].getUri().toString())


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none if it is not there."""
    fs, p = _hadoop_path(spark, path)
    return sorted(str(s.getPath().getName()) for s in fs.listStatus(p)) if fs.exists(p) else []


def same_path(spark: SparkSession, path: str) -> str:
    """One spelling of a path: scheme and authority added, no trailing slash."""
    fs, p = _hadoop_path(spark, path)
    return str(fs.makeQualified(p).toString()).rstrip("/")


def list_partitions(spark: SparkSession, path: str, keys: tuple[str, ...], inside: str = "") -> list[tuple[int, ...]]:
    """Values of integer partition folders ``k1=v1/k2=v2/...`` under ``path`` (those that
    hold a folder ``inside``, if given), from a directory listing on the driver: no file is
    opened. Bounded by the calendar."""
    fs, p = _hadoop_path(spark, "/".join([path, *[f"{k}=*" for k in keys], *([inside] if inside else [])]))
    out = set()
    for status in fs.globStatus(p) or []:
        parts = str(status.getPath().toString()).split("/")
        parts = parts[:-1] if inside else parts
        out.add(tuple(int(x.split("=", 1)[1]) for x in parts[-len(keys):]))
    return sorted(out)


def list_files(spark: SparkSession, path: str, keys: tuple[str, ...],
               only: set[tuple[int, ...]] | None = None) -> list[tuple[tuple[int, ...], str, int]]:
    """(partition values, file path, bytes) of the data files in integer partition
    folders, all of them or those whose values are in ``only``."""
    fs, p = _hadoop_path(spark, "/".join([path, *[f"{k}=*" for k in keys]]))
    out = []
    for folder in fs.globStatus(p) or []:
        parts = str(folder.getPath().toString()).split("/")[-len(keys):]
        values = tuple(int(x.split("=", 1)[1]) for x in parts)
        if only is not None and values not in only:
            continue
        for status in fs.listStatus(folder.getPath()):
            name = str(status.getPath().getName())
            if status.isFile() and not name.startswith(("_", ".")):
                out.append((values, str(status.getPath().toString()), int(status.getLen())))
    return sorted(out)
