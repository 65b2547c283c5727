"""Month-based landing operators (L1-L5, L7), re-aimed from the reference's
download script onto an already mounted ``year=/month=`` landing folder.

Periods are a calendar (bounded by the number of months, not by data volume)
and come from a directory listing: a month counts as landed if its folder holds a
file, whatever is in it, and no data file is opened to find out. Selections
filter on the partition columns only, so the scans are pruned to the chosen
month directories.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripspark.session import list_files, write_text
from tripspark.sources.readers import read_raw

# Fixed values of the landing rules: the first full year landed in mode
# ``historical`` and the trip type recorded in the landing marker.
DEFAULT_BASE_YEAR = 2024
DEFAULT_TRIP_TYPES = ["fhvhv"]


def periods_between(df: DataFrame, start: Column, end: Column) -> DataFrame:
    """Every month from ``start`` to ``end`` (dates, inclusive) per input row."""
    d = F.explode(F.sequence(start, end, F.expr("INTERVAL 1 MONTH"))).alias("d")
    return df.select(d).select(
        F.year("d").alias("year"), F.month("d").alias("month"),
        F.date_format("d", "yyyy-MM").alias("period"))


def periods(spark: SparkSession, start_year: int, start_month: int, n: int) -> DataFrame:
    """L1: ``n`` consecutive months from a start month, rolling over year ends."""
    start = F.make_date(F.lit(start_year), F.lit(start_month), F.lit(1))
    return periods_between(spark.range(1), start, F.add_months(start, n - 1))


MONTH_KEYS = ("year", "month")


def landed_files(spark: SparkSession, path: str) -> DataFrame:
    """(year, month, file_path, file_size) of the landed data files, from a listing."""
    rows = [(y, m, name, size) for (y, m), name, size in list_files(spark, path, MONTH_KEYS)]
    return spark.createDataFrame(rows, "year int, month int, file_path string, file_size bigint")


def landed_periods(spark: SparkSession, path: str) -> DataFrame:
    """(year, month) of the landed months, from a listing."""
    months = sorted({ym for ym, _, _ in list_files(spark, path, MONTH_KEYS)})
    return spark.createDataFrame(months, "year int, month int")


def period_range(landed: DataFrame) -> DataFrame:
    """All months from the first to the last landed month."""
    bounds = landed.agg(F.min(F.struct("year", "month")).alias("lo"), F.max(F.struct("year", "month")).alias("hi"))
    return periods_between(bounds, *[F.make_date(f"{p}.year", f"{p}.month", F.lit(1)) for p in ("lo", "hi")])


def latest_period(landed: DataFrame, as_of: _dt.date | None = None) -> DataFrame:
    """L2: newest landed month no later than ``as_of``'s month in its year,
    else the newest month of the previous year, else January of the previous
    year (the reference's fallback). One row (year, month).
    """
    as_of = as_of or _dt.date.today()
    y, m = as_of.year, as_of.month
    cand = landed.filter(((F.col("year") == y) & (F.col("month") <= m)) | (F.col("year") == y - 1))
    default = F.struct(F.lit(y - 1).alias("year"), F.lit(1).alias("month"))
    return (cand.agg(F.max(F.struct("year", "month")).alias("p"))
            .select(F.coalesce("p", default).alias("p"))
            .select(F.col("p.year").alias("year"), F.col("p.month").alias("month")))


def resolve_latest(landed: DataFrame, as_of: _dt.date | None = None) -> tuple[int, int]:
    """The latest period as literals (one row), for partition-pruned reads."""
    r = latest_period(landed, as_of).first()
    return int(r["year"]), int(r["month"])


def select_current(spark: SparkSession, path: str, latest: tuple[int, int]) -> DataFrame:
    """L3: mode ``current`` — only the latest month (pruned scan)."""
    return read_raw(spark, path, year=latest[0], month=latest[1])


def historical_filter(latest: tuple[int, int], base_year: int = DEFAULT_BASE_YEAR,
                      strict_reference: bool = False) -> Column:
    """Partition predicate of mode ``historical``.

    Default: every month from January of ``base_year`` up to the month before
    the latest. ``strict_reference=True`` reproduces the reference's rule: the
    whole base year plus months 1..latest-1 of the latest year, only if that
    year is after the base year and the latest month is not January.
    """
    ly, lm = latest
    y, m = F.col("year"), F.col("month")
    if strict_reference:
        pred = y == base_year
        if ly > base_year and lm > 1:
            pred = pred | ((y == ly) & (m < lm))
        return pred
    return (y >= base_year) & ((y < ly) | ((y == ly) & (m < lm)))


def select_historical(raw: DataFrame, latest: tuple[int, int], base_year: int = DEFAULT_BASE_YEAR,
                      strict_reference: bool = False) -> DataFrame:
    """L4: mode ``historical`` over the landed table."""
    return raw.filter(historical_filter(latest, base_year, strict_reference))


def missing_periods(wanted: DataFrame, landed: DataFrame) -> DataFrame:
    """Wanted months with no landed data (to be fetched)."""
    return wanted.join(landed.select("year", "month"), ["year", "month"], "left_anti")


def month_row_counts(spark: SparkSession, path: str) -> DataFrame:
    """Rows of each landed month, 0 for months whose files are empty."""
    counts = read_raw(spark, path).groupBy("year", "month").agg(F.count(F.lit(1)).alias("row_count"))
    return (landed_periods(spark, path).join(counts, ["year", "month"], "left")
            .select("year", "month", F.format_string("%04d-%02d", "year", "month").alias("period"),
                    F.coalesce("row_count", F.lit(0).cast("bigint")).alias("row_count")))


def landing_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Per landed month — file count and bytes from the listing, rows from the files."""
    sizes = (landed_files(spark, path).groupBy("year", "month")
             .agg(F.count(F.lit(1)).alias("file_count"), F.sum("file_size").alias("total_bytes")))
    return (sizes.join(month_row_counts(spark, path), ["year", "month"])
            .withColumn("total_size_gb", F.round(F.col("total_bytes") / F.lit(1024.0 ** 3), 2))
            .select("year", "month", "file_count", "total_bytes", "row_count", "total_size_gb", "period"))


# Fixed values of the landing marker.
PUBLICATION_DELAY_MONTHS = 2
MARKER_NAME = "ingestion.done"


def manifest_record(manifest: DataFrame, job_type: str, latest: tuple[int, int],
                    trip_types: list[str] | None = None, job_run_id: str = "unknown",
                    duplicate_files_skipped: int = 0) -> DataFrame:
    """The landing marker: one row summarising a landing run.

    ``data_period`` is the first month of the manifest, ``data_period_end`` its
    last one (the manifest lists what the run landed); the newest month that
    exists is ``latest_available_month``.
    """
    total = manifest.agg(
        F.sum("file_count").alias("total_files"),
        F.round(F.sum("total_bytes") / F.lit(1024.0 ** 3), 2).alias("total_size_gb"),
        F.sum("row_count").alias("total_rows"),
        F.min("period").alias("first"), F.max("period").alias("last"))
    files = F.coalesce("total_files", F.lit(0))
    return total.select(
        F.current_timestamp().alias("ingestion_date"),
        F.lit(job_type).alias("job_type"),
        F.coalesce("first", F.lit("unknown")).alias("data_period"),
        F.coalesce("last", F.lit("unknown")).alias("data_period_end"),
        F.array(*[F.lit(t) for t in (trip_types or DEFAULT_TRIP_TYPES)]).alias("taxi_types"),
        files.alias("total_files"),
        F.coalesce("total_size_gb", F.lit(0.0)).alias("total_size_gb"),
        F.coalesce("total_rows", F.lit(0)).alias("total_rows"),
        F.lit(job_run_id).alias("job_run_id"),
        F.lit(f"{latest[0]:04d}-{latest[1]:02d}").alias("latest_available_month"),
        F.lit(PUBLICATION_DELAY_MONTHS).alias("publication_delay_months"),
        F.lit(duplicate_files_skipped).alias("duplicate_files_skipped"),
        F.when(files > 0, F.lit("SUCCESS")).otherwise(F.lit("EMPTY")).alias("status"),
    )


def write_manifest(record: DataFrame, folder: str) -> str:
    """Write the one-row marker as ``folder/ingestion.done`` (JSON), which later steps can
    wait for; returns its path."""
    path = f"{folder}/{MARKER_NAME}"
    write_text(record.sparkSession, path, record.toJSON().first())
    return path
