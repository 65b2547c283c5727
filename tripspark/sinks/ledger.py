"""Landing with a ledger (L5-L7): files that are landed already are skipped and
counted, and a month is published as a whole.

A source folder holds Parquet files of raw trips, each named after its month
(``…2024-01…``), and all files of the months it holds. The ledger lists, by run,
every file with its size, its rows and a digest of their contents. A month whose
files are all as in the ledger is skipped; any other month is written to a staging
folder that readers of the landing folder don't see, and takes the place of the
landed one by a rename. So a reader finds a month as it was, not at all, or as it
is now, but never a part of it.

The digest is a sum of row hashes, so it doesn't depend on the order of the rows or
of the tasks. Files are told apart by it in one scan whose shuffle has a row for
each file and task.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripspark.schemas import RAW, RAW_DATA_COLUMNS
from tripspark.session import delete_path, path_exists, publish, same_path, session_settings
from tripspark.sinks.writers import OPEN_MONTHS
from tripspark.sources.readers import decoded_file_path

LEDGER, STAGING = "_ledger", "_staging"
MONTH_IN_NAME = r"(\d{4})-(\d{2})"
LANDED, SKIPPED, NAMELESS = "landed", "skipped", "without month"
ENTRIES = "file_name string, file_size bigint, row_count bigint, digest string, year int, month int, status string"


def _relative(path: Column, source: str) -> Column:
    """A file's path below the source folder, however its scheme is spelled."""
    return F.substring_index(path, re.sub(r"^[\w+.-]+:(//[^/]*)?", "", source).rstrip("/") + "/", -1)


def _read_source(spark: SparkSession, source: str) -> DataFrame:
    schema = RAW[:-2]
    return (spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(source)
            .withColumn("file_name", _relative(decoded_file_path(), source)))


def source_files(spark: SparkSession, source: str) -> DataFrame:
    """Name, size, rows, content digest and month (NULL if the name has none) of a source folder's files."""
    source = same_path(spark, source)
    listed = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
              .load(source).select(_relative(F.col("path"), source).alias("file_name"), F.col("length").alias("file_size")))
    values = [x for c in RAW_DATA_COLUMNS for x in (F.col(c), F.col(c).isNull())]
    hashes = [F.sum(F.xxhash64(F.lit(seed), *values).cast("decimal(20,0)")).cast("string") for seed in (1, 2)]
    contents = _read_source(spark, source).groupBy("file_name").agg(
        F.count(F.lit(1)).alias("row_count"), F.concat_ws("/", *hashes).alias("digest"))
    month = [F.nullif(F.regexp_extract("file_name", MONTH_IN_NAME, i), F.lit("")).cast("int") for i in (1, 2)]
    return listed.join(contents, "file_name", "left").select(
        "file_name", "file_size", F.coalesce("row_count", F.lit(0).cast("long")).alias("row_count"),
        F.coalesce("digest", F.lit("")).alias("digest"), month[0].alias("year"), month[1].alias("month"))


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """All entries of all runs, in the order of ``run``."""
    folder = f"{path}/{LEDGER}"
    schema = f"{ENTRIES}, run int"
    return spark.read.schema(schema).parquet(folder) if path_exists(spark, folder) else spark.createDataFrame([], schema)


def known_files(ledger: DataFrame) -> DataFrame:
    """What is landed: the files of each month in the last run that landed it."""
    last = F.max(F.when(F.col("status") == LANDED, F.col("run"))).over(Window.partitionBy("year", "month"))
    return ledger.withColumn("last", last).filter((F.col("run") == F.col("last")) & (F.col("status") == LANDED)).drop("last")


def land_files(spark: SparkSession, source: str, path: str) -> DataFrame:
    """Land the source's new and changed months under ``path``; returns this run's ledger entries."""
    ledger = read_ledger(spark, path)
    run = (ledger.agg(F.max("run")).first()[0] or 0) + 1
    staging, folder = f"{path}/{STAGING}-{uuid.uuid4().hex[:8]}", f"{path}/{LEDGER}/run={run}"
    had = known_files(ledger).select("file_name", "file_size", "digest", "year", "month", F.lit(True).alias("known"))
    found = source_files(spark, source).withColumn("here", F.lit(True))
    both = found.join(had, ["file_name", "file_size", "digest", "year", "month"], "full")
    # a month is as it was if each of its files is both here and known
    same = F.min(F.col("here").isNotNull() & F.col("known").isNotNull()).over(Window.partitionBy("year", "month"))
    told = both.withColumn("same", same).filter("here").withColumn(
        "status", F.when(F.col("year").isNull(), NAMELESS).when(F.col("same"), SKIPPED).otherwise(LANDED))
    # staged first, so that the decision is made once and the months are known; published with the ledger's entry
    entries = f"{staging}/{LEDGER}"
    told.select("file_name", "file_size", "row_count", "digest", "year", "month", "status").coalesce(1).write.parquet(entries)
    decided = spark.read.schema(ENTRIES).parquet(entries)
    chosen = decided.filter(F.col("status") == LANDED)
    months = [(r["year"], r["month"], r["n"]) for r in chosen.groupBy("year", "month").agg(F.sum("row_count").alias("n")).collect()]
    if months:
        rows = _read_source(spark, same_path(spark, source)).join(chosen.select("file_name", "year", "month"), "file_name").drop("file_name")
        rows = rows.withColumn("month", F.lpad(F.col("month").cast("string"), 2, "0"))
        with session_settings(spark, OPEN_MONTHS):  # a file holds one month: no shuffle
            rows.write.partitionBy("year", "month").parquet(f"{staging}/months")
    for y, m, n in months:  # bounded by the calendar
        month = f"year={y}/month={m:02d}"
        if not n:
            spark.createDataFrame([], RAW[:-2]).coalesce(1).write.parquet(f"{staging}/months/{month}")
        publish(spark, f"{staging}/months/{month}", f"{path}/{month}")
    publish(spark, entries, folder)
    delete_path(spark, staging)
    return spark.read.schema(ENTRIES).parquet(folder)


def duplicate_files_skipped(entries: DataFrame) -> int:
    return entries.filter(F.col("status") == SKIPPED).count()


def run_summary(ledger: DataFrame) -> DataFrame:
    """For each run: months and files landed and skipped, and the rows landed."""
    month = F.struct("year", "month")
    return ledger.groupBy("run").agg(
        F.count_distinct(F.when(F.col("status") == LANDED, month)).alias("months_landed"),
        F.count_distinct(F.when(F.col("status") == SKIPPED, month)).alias("months_skipped"),
        F.count_if(F.col("status") == LANDED).alias("files_landed"),
        F.count_if(F.col("status") == SKIPPED).alias("duplicate_files_skipped"),
        F.coalesce(F.sum(F.when(F.col("status") == LANDED, F.col("row_count"))), F.lit(0)).alias("rows_landed"))
