"""Parquet sinks of every layer.

File layout: before a partitioned write the rows are *rebalanced* on the
partition columns (``REBALANCE`` hint). AQE then sizes the write tasks by bytes:
it splits a hot day into several tasks (no single task holds a skewed day)
and merges small days, so each task writes few, reasonably sized files instead
of one file per (task × day).

Rows that are read from month folders are by month already: each task holds a few
months, and to be written by month again they need no shuffle (``rebalance=False``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripspark.operators.quality import OUTCOME, REJECTED, VALID
from tripspark.session import delete_path, path_exists, publish, same_file_system, session_settings

#: Timestamps of trips are written as 64-bit microseconds: Spark's default, 96-bit values, take longer and have no statistics.
MICROS = {"spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS"}

#: Bytes of files that a task takes where its rows are sorted as they are read, without a shuffle: few enough
#: for the sort to stay in memory.
SPLIT = {"spark.sql.files.maxPartitionBytes": "32m"}

CURATED_PARTITIONS = ("year", "month", "day")
BOROUGH_PARTITIONS = ("year", "month")
ZONE_PARTITIONS = ("year", "month", "day")
SERVICE_PARTITIONS = ("year", "month")


def write_partitioned(df: DataFrame, path: str, partitions: tuple[str, ...] | list[str],
                      dynamic: bool = False, rebalance: bool = True, order: tuple[str, ...] = ()) -> None:
    """Overwrite ``path`` with ``df`` laid out as ``k=v/`` directories.

    ``dynamic=True`` replaces only the partitions present in ``df`` (per-write
    option, not a session setting); otherwise the whole table is replaced, like
    the reference's batch jobs. ``order`` sorts the rows within each file.
    """
    out = df.hint("rebalance", *partitions) if rebalance else df
    if order:
        out = out.sortWithinPartitions(*partitions, *order)
    w = out.write.mode("overwrite").partitionBy(*partitions)
    if dynamic:
        w = w.option("partitionOverwriteMode", "dynamic")
    with session_settings(df.sparkSession, {} if rebalance else SPLIT):
        w.parquet(path)


def write_curated(df: DataFrame, path: str, dynamic: bool = False, rebalance: bool = True) -> None:
    """K1: curated trips by year/month/day.

    ``rebalance=False`` skips the shuffle before the write (each task then
    writes one file per day it holds: cheaper job, more small files unless the
    rows come from month folders).
    """
    write_partitioned(df, path, CURATED_PARTITIONS, dynamic=dynamic, rebalance=rebalance)


def write_outcomes(outcomes: DataFrame, curated_path: str, rejects_path: str, rebalance: bool = True) -> None:
    """K1 and the quarantine of F3 by one write: rows are dealt by their outcome to a staging
    folder beside the curated table, whose two folders then take the tables' places.

    Valid rows carry a NULL ``failed_rules`` in the files, which the curated schema leaves out."""
    spark = outcomes.sparkSession
    if not same_file_system(spark, curated_path, rejects_path):
        raise ValueError("curated and rejected rows must go to one file system")
    parent, _, name = curated_path.rstrip("/").rpartition("/")
    staging = f"{parent}/_staging_{name}"
    write_partitioned(outcomes, staging, (OUTCOME, *CURATED_PARTITIONS), rebalance=rebalance)
    for outcome, path in ((VALID, curated_path), (REJECTED, rejects_path)):
        folder = f"{staging}/{OUTCOME}={outcome}"
        if path_exists(spark, folder):
            publish(spark, folder, path)
        else:  # no such rows: an empty table
            outcomes.drop(OUTCOME).limit(0).write.mode("overwrite").parquet(path)
    delete_path(spark, staging)


def write_batch(df: DataFrame, table: str, folder: str, partitions: tuple[str, ...], order: tuple[str, ...],
                rebalance: bool = True) -> None:
    """One new folder of a table (``batch_id=5``), replaced as a whole if the batch is written
    again. Files are by ``partitions`` and sorted within by ``order``, so that Parquet's
    statistics prune on those columns without folders of their own. ``rebalance=False`` if
    each task holds few of the ``partitions`` already."""
    out = (df.hint("rebalance", *partitions) if rebalance else df).sortWithinPartitions(*partitions, *order)
    with session_settings(df.sparkSession, MICROS if rebalance else MICROS | SPLIT):
        out.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*partitions).parquet(f"{table}/{folder}")


def write_daily_borough(df: DataFrame, path: str, dynamic: bool = False) -> None:
    """K2: borough mart by year/month."""
    write_partitioned(df, path, BOROUGH_PARTITIONS, dynamic=dynamic)


def write_daily_zone(df: DataFrame, path: str, dynamic: bool = False) -> None:
    """K3: zone mart by year/month/day."""
    write_partitioned(df, path, ZONE_PARTITIONS, dynamic=dynamic)


def write_daily_service(df: DataFrame, path: str, dynamic: bool = False) -> None:
    """K4: service mart by year/month."""
    write_partitioned(df, path, SERVICE_PARTITIONS, dynamic=dynamic)


#: Lets a task have the files of a few months open at once, so that its rows need not be sorted by month first.
OPEN_MONTHS = {"spark.sql.maxConcurrentOutputFileWriters": "16"}


def land(raw: DataFrame, path: str, mode: str = "overwrite", dynamic: bool = True, rebalance: bool = True) -> None:
    """Place raw trips under ``year=YYYY/month=MM`` (two-digit month).

    By default existing months are kept (dynamic overwrite): landing a month
    again replaces only that month, like refreshing one monthly file.
    ``dynamic=False`` replaces the whole folder (a first, complete landing).
    ``rebalance=False`` is for rows that come from month folders: each task writes its
    few months side by side, without a shuffle or a sort (with more than 16 of them
    Spark sorts what is left).
    """
    out = raw.withColumn("month", F.lpad(F.col("month").cast("string"), 2, "0"))
    w = (out.hint("rebalance", "year", "month") if rebalance else out).write.mode(mode)
    if dynamic:
        w = w.option("partitionOverwriteMode", "dynamic")
    with session_settings(raw.sparkSession, MICROS if rebalance else MICROS | OPEN_MONTHS):
        w.partitionBy("year", "month").parquet(path)
