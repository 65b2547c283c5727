"""Composite batch pipelines (C1, C2) — the user entry points.

C1 reads raw once: scan -> curate -> validate -> write. The reference ran
2·columns + 10 actions over an uncached input; here the counts come from file
metadata (the footers of the raw and the written files), so they hold whatever
tasks were run again, and the profile is one optional aggregate job.

C2 scans the curated table once into a daily pre-aggregate (written, so the
three marts re-aggregate a small durable table instead of re-scanning or
caching the trips) and counts the written tables from their footers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripspark.operators.curate import curate
from tripspark.operators.marts import (borough_from_cube, daily_cube, service_from_cube, total_overflows,
                                       zone_from_cube)
from tripspark.operators.quality import (column_profile, dataset_overview, license_distribution,
                                         profile_and_overview, split_outcomes, validate)
from tripspark.schemas import DAILY_BOROUGH, DAILY_CUBE, DAILY_SERVICE, DAILY_ZONE
from tripspark.sinks.writers import (write_curated, write_daily_borough, write_daily_service,
                                     write_daily_zone, write_outcomes, write_partitioned)
from tripspark.sources.readers import (check_zones, file_columns, read_curated, read_mart, read_raw,
                                       read_zones)


def profile_raw(spark: SparkSession, raw_path: str) -> dict[str, DataFrame]:
    """Data-quality reports of the raw layer (A4-A6) over all columns that the files have."""
    raw = read_raw(spark, raw_path, extra=file_columns(spark, raw_path))
    return {"column_profile": column_profile(raw),
            "license_distribution": license_distribution(raw),
            "dataset_overview": dataset_overview(raw)}


def raw_to_curated(spark: SparkSession, raw_path: str, curated_path: str,
                   processed_at=None, rebalance: bool = True,
                   rejects_path: str | None = None, profile: bool = False,
                   cbd_column: str | None = None) -> dict[str, object]:
    """Curate, validate and write the curated layer in one pass.

    ``rebalance`` shuffles the valid rows by day before the write (few, evenly
    sized files); without it each task writes a file for each day it holds.
    ``cbd_column`` names the raw column with the congestion fee (0 without).
    With ``rejects_path`` the rejected rows and the rules they broke are also
    written there, by the same write (one scan of raw sends each row to one of the two
    tables, which must be in one file system); by default they are only counted.
    ``profile=True`` adds NULL counts of all columns that the files have (one
    aggregate job) and the license distribution as a DataFrame (unbounded if
    the raw data are dirty, so it is not collected).
    """
    out: dict[str, object] = {}
    if profile:
        raw = read_raw(spark, raw_path, extra=file_columns(spark, raw_path))
        out["raw_rows"], out["raw_null_counts"] = profile_and_overview(raw)
        out["raw_columns"] = len(raw.columns)
        out["licenses"] = license_distribution(raw)
    extra = {cbd_column: "double"} if cbd_column else None
    curated = curate(read_raw(spark, raw_path, extra=extra), processed_at=processed_at, cbd_column=cbd_column)
    if rejects_path:
        write_outcomes(split_outcomes(curated), curated_path, rejects_path, rebalance=rebalance)
    else:
        write_curated(validate(curated), curated_path, rebalance=rebalance)
    initial = read_raw(spark, raw_path).count()
    valid_n = read_curated(spark, curated_path).count()
    n_rejected = initial - valid_n
    out.update({"initial_count": initial, "valid_count": valid_n, "rejected_count": n_rejected,
                "rejection_rate_pct": (n_rejected / initial * 100.0) if initial else None})
    return out


def curated_to_aggregated(spark: SparkSession, curated_path: str, zones_path: str,
                          out_root: str, count_overflows: bool = False) -> dict[str, int]:
    """Daily pre-aggregate, then the borough, zone and service marts.

    The curated table is scanned once: its partial aggregates are shuffled
    into the pre-aggregate, which is written to ``out_root/daily_cube`` (a
    durable cut of the lineage) and re-aggregated into the three marts.
    Returns the row count of every table written; with ``count_overflows`` also how many
    totals were too large for their mart and are NULL there (``overflows:table.total``).
    """
    zones = read_zones(spark, zones_path, check=False)
    zone_rows = check_zones(zones)
    curated = read_curated(spark, curated_path)
    cube_path = f"{out_root}/daily_cube"
    write_partitioned(daily_cube(curated), cube_path, ("year", "month"))
    cube = spark.read.schema(DAILY_CUBE).parquet(cube_path)
    write_daily_borough(borough_from_cube(cube, zones, zone_rows), f"{out_root}/daily_borough")
    write_daily_zone(zone_from_cube(cube, zones, zone_rows), f"{out_root}/daily_zone")
    write_daily_service(service_from_cube(cube), f"{out_root}/daily_service")
    counts = {"curated": curated.count()}
    for name, schema in (("daily_borough", DAILY_BOROUGH), ("daily_zone", DAILY_ZONE), ("daily_service", DAILY_SERVICE)):
        counts[name] = read_mart(spark, f"{out_root}/{name}", schema).count()
    if count_overflows:
        for r in total_overflows(cube, zones, zone_rows).collect():
            counts[f"overflows:{r['table_name']}.{r['total_name']}"] = r["overflow_count"]
    return counts
