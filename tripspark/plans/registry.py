"""Registered queries: one per operator of SURVEY §2, each ``(spark, sf_dir) ->
DataFrame`` over the driver's tables (through the trip-shaped fixture).

Parameters fixed here (processing time, the single month of S2, the as-of
date and base year of the landing modes) are shared with ``tripspark.oracle``.
Queries that write (sinks, catalog, incremental) do the writing into a fresh
folder under the shared scratch root and return the re-read table.
"""

from __future__ import annotations

import dataclasses
import datetime as _dt
import hashlib
import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tripspark import fixtures, oracle
from tripspark.operators import landing
from tripspark.operators.curate import curate, preview
from tripspark.operators.enrich import enrich
from tripspark.operators.marts import (borough_from_cube, compression_report, daily_cube, daily_service,
                                       daily_zone, service_from_cube, service_match_rate,
                                       service_ordered, top_boroughs, top_routes, total_overflows, weekend_revenue,
                                       zone_from_cube)
from tripspark.operators.quality import (column_profile, dataset_overview, license_distribution, rejected,
                                         rejects_by_rule, validate, validation_metrics)
from tripspark.plans import pipelines
from tripspark.schemas import CURATED, DAILY_BOROUGH, DAILY_CUBE, DAILY_SERVICE, DAILY_ZONE, with_column
from tripspark.session import DEFAULT_CONF, list_files, new_scratch_dir, set_modification_time
from tripspark.sinks.ledger import duplicate_files_skipped, land_files, read_ledger, run_summary
from tripspark.sinks.writers import (land, write_curated, write_daily_borough, write_daily_service,
                                     write_daily_zone)
from tripspark.sources.readers import (check_zones, create_external_raw_table, has_rows, read_curated, read_mart,
                                       read_raw, read_table, read_zones, repair_partitions)
from tripspark.streaming.incremental import (IncrementalPipeline, StreamIdentityError, incremental_rejects,
                                             incremental_totals, read_incremental_curated, read_quarantine)

Query = Callable[[SparkSession, str], DataFrame]


def processed_at():
    return F.lit(oracle.PROCESSED_AT).cast("timestamp")


def raw(spark: SparkSession, sf: str) -> DataFrame:
    return read_raw(spark, fixtures.raw_path(spark, sf))


def zones(spark: SparkSession, sf: str) -> tuple[DataFrame, int]:
    z = read_zones(spark, fixtures.zone_csv_path(spark, sf), check=False)
    return z, check_zones(z)


def curated(spark: SparkSession, sf: str) -> DataFrame:
    return curate(raw(spark, sf), processed_at=processed_at())


def valid(spark: SparkSession, sf: str) -> DataFrame:
    return validate(curated(spark, sf))


def enriched(spark: SparkSession, sf: str) -> DataFrame:
    z, n = zones(spark, sf)
    return enrich(valid(spark, sf), z, n)


def borough(spark: SparkSession, sf: str) -> DataFrame:
    """A1, ids first: trips are aggregated on numeric ids, and only the groups get names."""
    z, n = zones(spark, sf)
    return borough_from_cube(daily_cube(valid(spark, sf)), z, n)


def zone_mart(spark: SparkSession, sf: str) -> DataFrame:
    z, n = zones(spark, sf)
    return daily_zone(valid(spark, sf), z, n)


def service(spark: SparkSession, sf: str) -> DataFrame:
    return daily_service(valid(spark, sf))


def compression_report_q(spark: SparkSession, sf: str) -> DataFrame:
    """A7 from one written daily pre-aggregate: the raw trips are scanned once."""
    z, n = zones(spark, sf)
    path = new_scratch_dir(spark, "cube")
    daily_cube(valid(spark, sf)).write.parquet(path)
    cube = spark.read.schema(DAILY_CUBE).parquet(path)
    return compression_report(cube, borough_from_cube(cube, z, n), zone_from_cube(cube, z, n),
                              service_from_cube(cube))


def mart_overflows(spark: SparkSession, sf: str) -> DataFrame:
    """Totals that are too large for their mart, counted from one written daily pre-aggregate."""
    z, n = zones(spark, sf)
    path = new_scratch_dir(spark, "cube")
    daily_cube(valid(spark, sf)).write.parquet(path)
    return total_overflows(spark.read.schema(DAILY_CUBE).parquet(path), z, n)


# -- sinks: write then read back ------------------------------------------------

def curated_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = new_scratch_dir(spark, "curated")
    write_curated(valid(spark, sf), path, rebalance=False)  # the raw files are by month
    return read_curated(spark, path)


def _mart_roundtrip(build, write, schema) -> Query:
    def q(spark: SparkSession, sf: str) -> DataFrame:
        path = new_scratch_dir(spark, "mart")
        write(build(spark, sf), path)
        return read_mart(spark, path, schema)
    return q


def landed_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Raw trips landed in two steps, the last year again, then read."""
    path = new_scratch_dir(spark, "landed")
    r = raw(spark, sf)
    last = r.agg(F.max("year")).first()[0]
    land(r, path, dynamic=False, rebalance=False)
    land(r.filter(F.col("year") == last), path, rebalance=False)
    return read_raw(spark, path)


# -- pipelines ------------------------------------------------------------------

def _c1(spark: SparkSession, sf: str) -> tuple[str, dict[str, object]]:
    path = new_scratch_dir(spark, "pipeline")
    metrics = pipelines.raw_to_curated(spark, fixtures.raw_path(spark, sf), f"{path}/curated", processed_at=processed_at(),
                                       rebalance=False)  # the raw files are by month
    return path, metrics


def pipeline_curated(spark: SparkSession, sf: str) -> DataFrame:
    return read_curated(spark, f"{_c1(spark, sf)[0]}/curated")


def pipeline_metrics(spark: SparkSession, sf: str) -> DataFrame:
    m = _c1(spark, sf)[1]
    names = ("initial_count", "valid_count", "rejected_count", "rejection_rate_pct")
    return spark.createDataFrame([tuple(m[n] for n in names)],
                                 "initial_count bigint, valid_count bigint, rejected_count bigint, rejection_rate_pct double")


def pipeline_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """F3 as the quarantine that C1's one write fills beside the curated table."""
    path = new_scratch_dir(spark, "pipeline")
    pipelines.raw_to_curated(spark, fixtures.raw_path(spark, sf), f"{path}/curated", processed_at=processed_at(),
                             rebalance=False, rejects_path=f"{path}/rejects")
    schema = with_column(CURATED, "failed_rules", StringType())
    return spark.read.schema(schema).parquet(f"{path}/rejects").select(*schema.fieldNames())


def _c2(spark: SparkSession, sf: str) -> tuple[str, dict[str, int]]:
    path, _ = _c1(spark, sf)
    return path, pipelines.curated_to_aggregated(spark, f"{path}/curated", fixtures.zone_csv_path(spark, sf), path)


def _pipeline_mart(name: str, schema) -> Query:
    return lambda spark, sf: read_mart(spark, f"{_c2(spark, sf)[0]}/{name}", schema)


def pipeline_counts(spark: SparkSession, sf: str) -> DataFrame:
    return spark.createDataFrame(sorted(_c2(spark, sf)[1].items()), "table_name string, row_count bigint")


def has_rows_q(spark: SparkSession, sf: str) -> DataFrame:
    """S8 for each year of a window around the data: whether it has landed trips."""
    r = raw(spark, sf)
    b = r.agg(F.min("year").alias("lo"), F.max("year").alias("hi")).first()
    years = range(b["lo"] - 1, b["hi"] + 2)  # bounded by the calendar
    return spark.createDataFrame([(y, has_rows(r.filter(F.col("year") == y))) for y in years], "year int, has_rows boolean")


# -- catalog --------------------------------------------------------------------

def _external_raw_table(spark: SparkSession, sf: str) -> str:
    """One catalog table for each landed fixture, made on first use."""
    path = fixtures.raw_path(spark, sf)
    name = f"raw_trips_{hashlib.sha1(path.encode()).hexdigest()[:10]}"
    create_external_raw_table(spark, name, path)
    if not repair_partitions(spark, name):
        raise RuntimeError(f"partitions of {name} could not be registered")
    return name


def catalog_scan(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, None, _external_raw_table(spark, sf))


def catalog_repair(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql(f"SHOW PARTITIONS {_external_raw_table(spark, sf)}")


# -- landing --------------------------------------------------------------------

AS_OF = _dt.date.fromisoformat(oracle.AS_OF)


def landed(spark: SparkSession, sf: str) -> DataFrame:
    return landing.landed_periods(spark, fixtures.raw_path(spark, sf))


def periods_q(spark: SparkSession, sf: str) -> DataFrame:
    """L1: as many consecutive months as have landed, from the last landed one on."""
    b = landed(spark, sf).agg(F.max(F.struct("year", "month")).alias("hi"), F.count(F.lit(1)).alias("n")).first()
    return landing.periods(spark, b["hi"]["year"], b["hi"]["month"], b["n"])


def _latest(spark: SparkSession, sf: str) -> tuple[int, int]:
    return landing.resolve_latest(landed(spark, sf), AS_OF)


def missing_periods_q(spark: SparkSession, sf: str) -> DataFrame:
    have = landed(spark, sf)
    bounds = have.agg(F.min("year").alias("lo"), F.max("year").alias("hi"))
    wanted = landing.periods_between(bounds, F.make_date("lo", F.lit(1), F.lit(1)),
                                     F.make_date(F.col("hi") + 1, F.lit(12), F.lit(1)))
    return landing.missing_periods(wanted, have)


def _landed_twice(spark: SparkSession, sf: str) -> str:
    """Monthly files landed in two runs; before the second, later months arrive and the middle one, of which
    a part was there, gets a further file. Returns the landing folder."""
    folder, r = new_scratch_dir(spark, "ledger"), raw(spark, sf)
    idx = F.col("year") * 12 + F.col("month")
    b = r.agg(F.min(idx).alias("lo"), F.max(idx).alias("hi")).first()
    mid = (b["lo"] + b["hi"]) // 2
    late = (idx > mid) | ((idx == mid) & (F.col("trip_time") % 4 == 0))
    for piece in (r.filter(~late), r.filter(late)):
        named = piece.withColumn("period", F.format_string("%04d-%02d", "year", "month")).drop("year", "month")
        named.repartition("period").write.mode("append").partitionBy("period").parquet(f"{folder}/source")
        land_files(spark, f"{folder}/source", f"{folder}/raw")
    return f"{folder}/raw"


def landing_ledger(spark: SparkSession, sf: str) -> DataFrame:
    """What two runs landed and skipped."""
    return run_summary(read_ledger(spark, _landed_twice(spark, sf)))


def landing_marker(spark: SparkSession, sf: str) -> DataFrame:
    """The fields of the second run's marker that don't depend on time or file sizes."""
    path = _landed_twice(spark, sf)
    last = read_ledger(spark, path).filter(F.col("run") == 2)
    record = landing.manifest_record(
        landing.landing_manifest(spark, path), "historical", landing.resolve_latest(landing.landed_periods(spark, path), AS_OF),
        duplicate_files_skipped=duplicate_files_skipped(last))
    return record.select("job_type", "data_period", "data_period_end", "total_rows", "latest_available_month",
                         "publication_delay_months", "duplicate_files_skipped", "status")


# -- incremental ------------------------------------------------------------------

_INCREMENTAL: dict[tuple[str, str], IncrementalPipeline] = {}
_INCREMENTAL_LOCK = threading.Lock()


def incremental_pieces(raw_df: DataFrame) -> list[DataFrame]:
    """Three landings whose union is the whole table: the first half of the
    months, the second half, then a late file for the last month of the first
    half (a quarter of that month's rows, chosen by row hash), whose days were
    already processed by the first run."""
    idx = F.col("year") * 12 + F.col("month")
    b = raw_df.agg(F.min(idx).alias("lo"), F.max(idx).alias("hi")).first()
    mid = (b["lo"] + b["hi"]) // 2
    early = idx <= F.lit(mid)
    late = (idx == F.lit(mid)) & (F.pmod(F.xxhash64(*raw_df.columns), F.lit(4)) == 0)
    return [raw_df.filter(early & ~late), raw_df.filter(~early), raw_df.filter(late)]


def incremental_run(spark: SparkSession, sf: str) -> IncrementalPipeline:
    """Land the fixture in three pieces and run the stream after each (once per
    application and input; the ``incremental_*`` queries that read its tables share it)."""
    key = (spark.sparkContext.applicationId, sf)
    with _INCREMENTAL_LOCK:
        if key not in _INCREMENTAL:
            src = new_scratch_dir(spark, "incr-landing")
            pipe = IncrementalPipeline(spark, src, fixtures.zone_csv_path(spark, sf),
                                       new_scratch_dir(spark, "incr-out"), new_scratch_dir(spark, "incr-ckpt"),
                                       processed_at=processed_at())
            for piece in incremental_pieces(raw(spark, sf)):
                land(piece, src, mode="append", rebalance=False)
                pipe.run()
            _INCREMENTAL[key] = pipe
        return _INCREMENTAL[key]


def _fresh_pipeline(spark: SparkSession, sf: str) -> IncrementalPipeline:
    return IncrementalPipeline(spark, new_scratch_dir(spark, "incr-landing"), fixtures.zone_csv_path(spark, sf),
                               new_scratch_dir(spark, "incr-out"), new_scratch_dir(spark, "incr-ckpt"),
                               processed_at=processed_at())


def incremental_late_mtime(spark: SparkSession, sf: str) -> DataFrame:
    """The second landing's files claim to be a year older than the first one's."""
    pipe, parts = _fresh_pipeline(spark, sf), incremental_pieces(raw(spark, sf))
    land(parts[0], pipe.raw_path, mode="append", rebalance=False)
    pipe.run()
    known = {name for _, name, _ in list_files(spark, pipe.raw_path, landing.MONTH_KEYS)}
    land(parts[1].unionByName(parts[2]), pipe.raw_path, mode="append", rebalance=False)
    for _, name, _ in list_files(spark, pipe.raw_path, landing.MONTH_KEYS):
        if name not in known:
            set_modification_time(spark, name, _dt.datetime.now() - _dt.timedelta(days=365))
    pipe.run()
    return read_incremental_curated(spark, pipe.curated_path)


def incremental_rebuild(spark: SparkSession, sf: str) -> DataFrame:
    """A fresh checkpoint on existing tables is refused; a rebuild with it gives each row once."""
    pipe, parts = _fresh_pipeline(spark, sf), incremental_pieces(raw(spark, sf))
    for p in parts:
        land(p, pipe.raw_path, mode="append", rebalance=False)
    pipe.run()
    again = dataclasses.replace(pipe, checkpoint=new_scratch_dir(spark, "incr-ckpt"), batches=[])
    try:
        again.run()
    except StreamIdentityError:
        again.rebuild()
    else:
        raise AssertionError("a foreign checkpoint was accepted")
    return read_mart(spark, again.service_path, DAILY_SERVICE)


def incremental_catalog(spark: SparkSession, sf: str) -> DataFrame:
    """S7 from a catalog table: its location, schema and new partitions, landed in two pieces; zone mart."""
    src, parts = new_scratch_dir(spark, "incr-landing"), incremental_pieces(raw(spark, sf))
    land(parts[0], src, mode="append", rebalance=False)
    table = f"incr_trips_{hashlib.sha1(src.encode()).hexdigest()[:10]}"
    create_external_raw_table(spark, table, src)
    pipe = dataclasses.replace(_fresh_pipeline(spark, sf), raw_table=table)
    pipe.run()
    land(parts[1].unionByName(parts[2]), src, mode="append", rebalance=False)
    pipe.run()
    return read_mart(spark, pipe.zone_path, DAILY_ZONE)


def incremental_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """The newest year is landed with part of its rows first, then again in full, and the folders
    are merged: borough mart."""
    pipe, r = _fresh_pipeline(spark, sf), raw(spark, sf)
    last = r.agg(F.max("year")).first()[0]
    partial = F.pmod(F.xxhash64(*r.columns), F.lit(3)) > 0
    land(r.filter((F.col("year") < last) | partial), pipe.raw_path, mode="append", rebalance=False)
    pipe.run()
    land(r.filter(F.col("year") == last), pipe.raw_path, rebalance=False)
    pipe.run()
    pipe.compact()
    return read_mart(spark, pipe.borough_path, DAILY_BOROUGH)


def _incremental_mart(attr: str, schema) -> Query:
    def q(spark: SparkSession, sf: str) -> DataFrame:
        return read_mart(spark, getattr(incremental_run(spark, sf), attr), schema)
    return q


def queries() -> dict[str, Query]:
    q: dict[str, Query] = {
        # sources
        "raw_scan": raw,
        "raw_scan_month": lambda s, sf: read_raw(s, fixtures.raw_path(s, sf),
                                                 oracle.MONTH_YEAR, oracle.MONTH_MONTH),
        "zone_scan": lambda s, sf: zones(s, sf)[0],
        "catalog_scan": catalog_scan,
        "catalog_repair": catalog_repair,
        # projection / validation / quality
        "curate_trips": curated,
        "curate_trips_cbd": lambda s, sf: curate(
            read_raw(s, fixtures.raw_cbd_path(s, sf), extra={fixtures.CBD_COLUMN: "double"}),
            processed_at=processed_at(), cbd_column=fixtures.CBD_COLUMN),
        "column_profile_files": lambda s, sf: pipelines.profile_raw(s, fixtures.raw_cbd_path(s, sf))["column_profile"],
        "validate_trips": valid,
        "curated_preview": lambda s, sf: preview(valid(s, sf)),
        "validation_metrics": lambda s, sf: validation_metrics(curated(s, sf)),
        "rejects_by_rule": lambda s, sf: rejects_by_rule(curated(s, sf)),
        "rejected_trips": lambda s, sf: rejected(curated(s, sf)),
        "column_profile": lambda s, sf: column_profile(raw(s, sf)),
        "license_distribution": lambda s, sf: license_distribution(raw(s, sf)),
        "dataset_overview": lambda s, sf: dataset_overview(raw(s, sf)),
        # join / marts / reports
        "enrich_trips": enriched,
        "daily_borough": borough,
        "daily_zone": zone_mart,
        "daily_service": service,
        "compression_report": compression_report_q,
        "mart_overflows": mart_overflows,
        "top_boroughs": lambda s, sf: top_boroughs(borough(s, sf)),
        "top_routes": lambda s, sf: top_routes(zone_mart(s, sf)),
        "service_ordered": lambda s, sf: service_ordered(service(s, sf)),
        "weekend_revenue": lambda s, sf: weekend_revenue(borough(s, sf)),
        "service_match_rate": lambda s, sf: service_match_rate(service(s, sf)),
        # sinks
        "curated_roundtrip": curated_roundtrip,
        "borough_roundtrip": _mart_roundtrip(borough, write_daily_borough, DAILY_BOROUGH),
        "zone_roundtrip": _mart_roundtrip(zone_mart, write_daily_zone, DAILY_ZONE),
        "service_roundtrip": _mart_roundtrip(service, write_daily_service, DAILY_SERVICE),
        "landed_roundtrip": landed_roundtrip,
        # pipelines
        "pipeline_curated": pipeline_curated,
        "pipeline_metrics": pipeline_metrics,
        "pipeline_rejects": pipeline_rejects,
        "pipeline_counts": pipeline_counts,
        "pipeline_borough": _pipeline_mart("daily_borough", DAILY_BOROUGH),
        "pipeline_zone": _pipeline_mart("daily_zone", DAILY_ZONE),
        "pipeline_service": _pipeline_mart("daily_service", DAILY_SERVICE),
        # landing
        "has_rows": has_rows_q,
        "periods": periods_q,
        "period_sequence": lambda s, sf: landing.period_range(landed(s, sf)),
        "latest_period": lambda s, sf: landing.latest_period(landed(s, sf), AS_OF),
        "current_month_trips": lambda s, sf: landing.select_current(s, fixtures.raw_path(s, sf),
                                                                    _latest(s, sf)),
        "historical_trips": lambda s, sf: landing.select_historical(raw(s, sf), _latest(s, sf),
                                                                    oracle.HISTORY_BASE_YEAR),
        "historical_trips_strict": lambda s, sf: landing.select_historical(
            raw(s, sf), _latest(s, sf), oracle.HISTORY_BASE_YEAR, strict_reference=True),
        "missing_periods": missing_periods_q,
        "landing_manifest": lambda s, sf: landing.landing_manifest(s, fixtures.raw_path(s, sf)),
        "landing_ledger": landing_ledger,
        "landing_marker": landing_marker,
        "landing_row_counts": lambda s, sf: landing.month_row_counts(s, fixtures.raw_path(s, sf)),
        # incremental (stream in three landings) == batch
        "incremental_curate": lambda s, sf: read_incremental_curated(s, incremental_run(s, sf).curated_path),
        "incremental_borough": _incremental_mart("borough_path", DAILY_BOROUGH),
        "incremental_zone": _incremental_mart("zone_path", DAILY_ZONE),
        "incremental_service": _incremental_mart("service_path", DAILY_SERVICE),
        "incremental_quarantine": lambda s, sf: read_quarantine(s, incremental_run(s, sf).curated_path),
        "incremental_metrics": lambda s, sf: incremental_totals(incremental_run(s, sf).metrics()),
        "incremental_rejects": lambda s, sf: incremental_rejects(incremental_run(s, sf).metrics()),
        "incremental_catalog": incremental_catalog,
        "incremental_late_mtime": incremental_late_mtime,
        "incremental_rebuild": incremental_rebuild,
        "incremental_refresh": incremental_refresh,
    }
    return {name: _in_utc(f) for name, f in q.items()}


def _in_utc(q: Query) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        # Raw timestamps without zone are read in the session zone.
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", DEFAULT_CONF["spark.sql.codegen.hugeMethodLimit"])
        return q(spark, sf)
    return run


def oracle_sql() -> dict[str, str]:
    return oracle.oracle_queries()
