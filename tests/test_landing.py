"""Landing operators (L1-L7) on small frames and on the landed fixture."""

from __future__ import annotations

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from tripspark import fixtures
from tripspark.operators import landing
from tripspark.session import new_scratch_dir
from tripspark.sinks.writers import land
from tripspark.sources.readers import read_raw


def ym(df):
    return [(r["year"], r["month"]) for r in df.orderBy("year", "month").collect()]


def test_periods_roll_over_year_end(spark):
    p = landing.periods(spark, 2024, 11, 4)
    assert ym(p) == [(2024, 11), (2024, 12), (2025, 1), (2025, 2)]
    assert [r["period"] for r in p.orderBy("year", "month").collect()][0] == "2024-11"


def landed(spark, pairs):
    return spark.createDataFrame(pairs, "year int, month int")


def test_latest_period_rules(spark):
    as_of = dt.date(2025, 6, 15)
    assert ym(landing.latest_period(landed(spark, [(2025, 3), (2025, 7), (2024, 12)]), as_of)) == [(2025, 3)]
    assert ym(landing.latest_period(landed(spark, [(2024, 5), (2024, 11)]), as_of)) == [(2024, 11)]
    # nothing in the current or previous year -> January of the previous year
    assert ym(landing.latest_period(landed(spark, [(2020, 1)]), as_of)) == [(2024, 1)]


def test_historical_modes(spark):
    months = landed(spark, [(y, m) for y in (2023, 2024, 2025) for m in range(1, 13)])
    default = ym(landing.select_historical(months, (2025, 4), base_year=2024))
    assert default[0] == (2024, 1) and default[-1] == (2025, 3) and len(default) == 15
    strict = ym(landing.select_historical(months, (2025, 4), base_year=2024, strict_reference=True))
    assert strict == [(2024, m) for m in range(1, 13)] + [(2025, 1), (2025, 2), (2025, 3)]
    # strict: latest in January -> base year only; latest inside base year is not held back
    assert len(ym(landing.select_historical(months, (2025, 1), 2024, strict_reference=True))) == 12
    assert len(ym(landing.select_historical(months, (2024, 6), 2024, strict_reference=True))) == 12
    assert ym(landing.select_historical(months, (2024, 6), 2024)) == [(2024, m) for m in range(1, 6)]


def test_missing_periods(spark):
    wanted = landing.periods(spark, 2024, 1, 6)
    have = landed(spark, [(2024, 1), (2024, 3), (2024, 4)])
    assert ym(landing.missing_periods(wanted, have)) == [(2024, 2), (2024, 5), (2024, 6)]


def test_land_writes_two_digit_months_and_keeps_other_months(spark, sf_small):
    raw = read_raw(spark, fixtures.raw_path(spark, sf_small))
    path = new_scratch_dir(spark, "land-test")
    first = raw.filter((F.col("year") == 1996) & (F.col("month") <= 2))
    land(first, path)
    assert sorted(os.listdir(os.path.join(path, "year=1996"))) == ["month=01", "month=02"]
    # landing month 2 again replaces only month 2
    land(raw.filter((F.col("year") == 1996) & (F.col("month") == 2)), path)
    back = read_raw(spark, path)
    assert back.count() == first.count()
    assert ym(landing.landed_periods(spark, path)) == [(1996, 1), (1996, 2)]


def test_manifest_record_json(spark, sf_small):
    path = fixtures.raw_path(spark, sf_small)
    m = landing.landing_manifest(spark, path)
    first, last = min(ym(m)), max(ym(m))
    rec = landing.manifest_record(m.filter(F.struct("year", "month") < F.struct(F.lit(last[0]), F.lit(last[1]))),
                                  "historical", last, job_run_id="run-7", duplicate_files_skipped=3)
    out = new_scratch_dir(spark, "marker")
    marker = landing.write_manifest(rec, out)
    landing.write_manifest(rec, out)  # the name is fixed: written again, it is replaced
    assert marker.endswith("/ingestion.done")
    doc = json.loads(open(marker).read())
    assert doc["data_period"] == "%04d-%02d" % first and doc["data_period_end"] < doc["latest_available_month"]
    assert doc["latest_available_month"] == "%04d-%02d" % last
    assert (doc["status"], doc["job_run_id"], doc["duplicate_files_skipped"]) == ("SUCCESS", "run-7", 3)
    assert doc["publication_delay_months"] == 2 and doc["taxi_types"] == ["fhvhv"]
    assert doc["total_rows"] < read_raw(spark, path).count()


def test_a_month_with_an_empty_file_has_landed(spark, sf_small):
    raw = read_raw(spark, fixtures.raw_path(spark, sf_small))
    path = new_scratch_dir(spark, "empty-month")
    land(raw.filter((F.col("year") == 1996) & (F.col("month") == 1)), path)
    raw.filter("false").drop("year", "month").coalesce(1).write.parquet(f"{path}/year=1996/month=03")
    have = landing.landed_periods(spark, path)
    assert ym(have) == [(1996, 1), (1996, 3)]
    assert ym(landing.missing_periods(landing.period_range(have), have)) == [(1996, 2)]
    counts = {r["period"]: r["row_count"] for r in landing.landing_manifest(spark, path).collect()}
    assert counts["1996-01"] > 0 and counts["1996-03"] == 0


def test_empty_manifest(spark, sf_small):
    m = landing.landing_manifest(spark, fixtures.raw_path(spark, sf_small)).filter("false")
    r = landing.manifest_record(m, "current", (2001, 5)).first()
    assert (r["status"], r["data_period"], r["latest_available_month"]) == ("EMPTY", "unknown", "2001-05")
