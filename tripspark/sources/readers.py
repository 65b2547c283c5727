"""Batch scans.

Every scan declares its schema, so no inference job runs and the file source
can push filters and prune columns/partitions from the start.
"""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tripspark.schemas import CURATED, RAW, ZONE

log = logging.getLogger(__name__)


def raw_schema(extra: dict[str, str] | None = None) -> StructType:
    """The declared raw schema with further data columns (name -> type) before the partition columns."""
    added = StructType.fromDDL(", ".join(f"`{n}` {t}" for n, t in extra.items())).fields if extra else []
    return StructType([*RAW.fields[:-2], *added, *RAW.fields[-2:]])


def decoded_file_path() -> Column:
    """The path of a row's file as listings spell it; the metadata column has it URL-encoded.

    Paths in which nothing is encoded, which are nearly all, are passed on: decoding costs more
    than reading the row."""
    path = F.col("_metadata.file_path")
    return F.when(F.contains(path, F.lit("%")), F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))).otherwise(path)


def file_columns(spark: SparkSession, path: str) -> dict[str, str]:
    """Data columns that the landed files have beyond the declared ones, over all files
    (name -> type). Reads the footers of all files in one job; for reports and set-up."""
    found = spark.read.option("mergeSchema", "true").parquet(path).schema
    return {f.name: f.dataType.simpleString() for f in found.fields if f.name not in RAW.fieldNames()}


def read_raw(spark: SparkSession, path: str, year: int | None = None,
             month: int | None = None, extra: dict[str, str] | None = None) -> DataFrame:
    """Raw trips under ``year=/month=``; optional single-month read.

    The month is selected by a filter on the partition columns of the base
    path (partition pruning), so the partition columns stay in the result.
    ``extra`` names further file columns with their types; files without such a
    column give NULL. ``file_columns`` finds what the files have.
    """
    df = spark.read.schema(raw_schema(extra)).parquet(path)
    if year is not None:
        df = df.filter(F.col("year") == F.lit(year))
    if month is not None:
        df = df.filter(F.col("month") == F.lit(month))
    return df


def read_curated(spark: SparkSession, path: str, year: int | None = None,
                 month: int | None = None) -> DataFrame:
    """S3: curated trips (year/month/day partitions)."""
    df = spark.read.schema(CURATED).parquet(path)
    if year is not None:
        df = df.filter(F.col("year") == F.lit(year))
    if month is not None:
        df = df.filter(F.col("month") == F.lit(month))
    return df


class DuplicateZoneError(ValueError):
    pass


def zone_stats(zones: DataFrame) -> tuple[int, int, int]:
    """(rows, rows with an id, distinct ids) of a zone table in one aggregate job."""
    r = zones.agg(F.count(F.lit(1)).alias("n"), F.count("LocationID").alias("k"),
                  F.count_distinct("LocationID").alias("d")).first()
    return int(r["n"]), int(r["k"]), int(r["d"])


def check_zones(zones: DataFrame) -> int:
    """Raise if a LocationID repeats (a left join would fan trips out).

    Rows without an id match no trip and are tolerated. Returns the row count,
    which callers use as the proven size bound before broadcasting the table.
    """
    n, with_id, distinct = zone_stats(zones)
    if with_id != distinct:
        raise DuplicateZoneError(f"zone table has {with_id} ids but {distinct} distinct ones")
    return n


def read_zones(spark: SparkSession, path: str, check: bool = True) -> DataFrame:
    """Zone lookup CSV with header, declared types, unique ids."""
    zones = spark.read.schema(ZONE).option("header", True).csv(path)
    if check:
        check_zones(zones)
    return zones


def read_table(spark: SparkSession, db: str | None, name: str) -> DataFrame:
    """Catalog table read."""
    return spark.table(f"{db}.{name}" if db else name)


def repair_partitions(spark: SparkSession, table: str) -> bool:
    """Register partition directories that appeared since the last run.

    Failure is tolerated (the reference goes on with the known partitions);
    returns whether the repair succeeded.
    """
    try:
        spark.catalog.recoverPartitions(table)
        return True
    except Exception as e:  # noqa: BLE001 - tolerated by design
        log.warning("partition repair of %s failed, using known partitions: %s", table, e)
        return False


def create_external_raw_table(spark: SparkSession, name: str, path: str) -> None:
    """Register landed raw files as a partitioned catalog table (no data copy) unless it is there."""
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in RAW.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet "
              f"PARTITIONED BY (year, month) LOCATION '{path}'")


def table_source(spark: SparkSession, table: str) -> tuple[str, StructType]:
    """Location and schema of a partitioned file table in the catalog."""
    told = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    if not told.get("Location"):
        raise ValueError(f"table {table} has no location that could be streamed")
    return told["Location"], spark.table(table).schema


def read_mart(spark: SparkSession, path: str, schema) -> DataFrame:
    """Read back a mart written by the sinks (partition columns from paths)."""
    return spark.read.schema(schema).parquet(path)


def has_rows(df: DataFrame) -> bool:
    """Whether anything new arrived (stops at the first row found)."""
    return not df.isEmpty()
