"""Golden tests of the curated layer on hand-made frames."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tripspark.operators.curate import curate
from tripspark.operators.quality import (rejects_by_rule, validate, validation_metrics,
                                         validation_rules)
from tripspark.schemas import CURATED, RAW

T0 = dt.datetime(2024, 3, 9, 23, 59, 59)  # a Saturday


def raw_row(**over):
    base = {
        "hvfhs_license_num": "HV0003", "dispatching_base_num": "B00001", "originating_base_num": None,
        "request_datetime": T0 - dt.timedelta(minutes=5), "on_scene_datetime": None,
        "pickup_datetime": T0, "dropoff_datetime": T0 + dt.timedelta(minutes=20),
        "PULocationID": 1, "DOLocationID": 2, "trip_miles": 3.0, "trip_time": 1200,
        "base_passenger_fare": 10.0, "tolls": 0.0, "bcf": 0.25, "sales_tax": 0.75,
        "congestion_surcharge": 2.75, "airport_fee": None, "tips": 1.0, "driver_pay": 8.0,
        "shared_request_flag": "N", "shared_match_flag": "N", "access_a_ride_flag": " ",
        "wav_request_flag": "N", "wav_match_flag": "N", "year": 2024, "month": 3,
    }
    base.update(over)
    return tuple(base[f.name] for f in RAW.fields)


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), schema=RAW)


def cur(spark, *rows):
    return curate(frame(spark, *rows), processed_at=F.lit("2025-01-01 00:00:00").cast("timestamp"))


def test_schema_is_the_38_curated_columns(spark):
    c = cur(spark, raw_row())
    assert c.columns == CURATED.fieldNames()
    assert len(c.columns) == 38
    for f in CURATED.fields:
        assert c.schema[f.name].dataType == f.dataType, f.name


def test_null_money_becomes_zero_before_validation(spark):
    r = cur(spark, raw_row(base_passenger_fare=None, trip_miles=None)).first()
    assert r["base_passenger_fare"] == Decimal("0.00")
    assert r["trip_miles"] == Decimal("0.00")
    # speed uses the un-coalesced miles -> NULL
    assert r["avg_speed_mph"] is None
    assert validate(cur(spark, raw_row(base_passenger_fare=None))).count() == 1


def test_flags_true_only_for_exact_Y(spark):
    rows = [raw_row(shared_request_flag=v) for v in ["Y", "N", "y", None, " "]]
    got = [r["shared_request_flag"] for r in cur(spark, *rows).collect()]
    assert got == [True, False, False, False, False]


def test_duration_and_speed_from_trip_time(spark):
    rows = [raw_row(trip_time=None), raw_row(trip_time=0), raw_row(trip_time=-1), raw_row(trip_time=90)]
    got = [(r["trip_duration_minutes"], r["avg_speed_mph"]) for r in cur(spark, *rows).collect()]
    assert got[0] == (None, None)
    assert got[1] == (Decimal("0.00"), None)
    assert got[2] == (Decimal("-0.02"), None)
    assert got[3] == (Decimal("1.50"), Decimal("120.00"))


def test_totals_sum_doubles_then_round(spark):
    r = cur(spark, raw_row(base_passenger_fare=0.125, tolls=0.0, bcf=0.0, sales_tax=0.0,
                           congestion_surcharge=0.0, airport_fee=None, tips=0.0)).first()
    assert r["base_passenger_fare"] == Decimal("0.13")  # HALF_UP
    assert r["total_fare"] == Decimal("0.13")
    r = cur(spark, raw_row()).first()
    assert r["total_fare"] == Decimal("13.75")
    assert r["total_amount"] == Decimal("14.75")  # + tips, driver_pay excluded


def test_overflow_and_nan_become_null_and_rejected(spark):
    c = cur(spark, raw_row(base_passenger_fare=1e12), raw_row(trip_miles=float("nan")))
    rows = c.collect()
    assert rows[0]["base_passenger_fare"] is None
    assert rows[1]["trip_miles"] is None
    assert validate(c).count() == 0


def test_dates_weekday_names_and_unknown(spark):
    days = [dt.datetime(2024, 3, 3 + i, 0, 0, 0) for i in range(7)]  # Sunday..Saturday
    rows = [raw_row(pickup_datetime=d, request_datetime=d, dropoff_datetime=d + dt.timedelta(hours=1))
            for d in days] + [raw_row(pickup_datetime=None)]
    got = [(r["day_of_week"], r["is_weekend"], r["trip_date"], r["pickup_hour"]) for r in cur(spark, *rows).collect()]
    names = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]
    assert [g[0] for g in got[:7]] == names
    assert [g[1] for g in got[:7]] == [True, False, False, False, False, False, True]
    assert got[7][:3] == ("Unknown", False, None)
    r = cur(spark, raw_row(pickup_datetime=dt.datetime(2024, 12, 31, 23, 59, 59))).first()
    assert (r["year"], r["month"], r["day"], r["pickup_hour"]) == (2024, 12, 31, 23)


def test_partition_columns_follow_pickup_not_file(spark):
    r = cur(spark, raw_row(year=2023, month=11)).first()
    assert (r["year"], r["month"]) == (2024, 3)


@pytest.mark.parametrize("over,ok", [
    ({"trip_miles": 0.0}, True), ({"trip_miles": 500.0}, True), ({"trip_miles": 500.01}, False),
    ({"trip_miles": -0.01}, False),
    ({"base_passenger_fare": 0.0}, True), ({"base_passenger_fare": 10000.0}, True),
    ({"base_passenger_fare": 10000.01}, False),
    ({"dropoff_datetime": T0}, False), ({"request_datetime": T0}, True),
    ({"request_datetime": None}, False),
    ({"pickup_datetime": None}, False), ({"dropoff_datetime": None}, False),
    ({"PULocationID": None}, False), ({"DOLocationID": None}, False),
    ({"hvfhs_license_num": "HV0002"}, True), ({"hvfhs_license_num": "HV0004"}, True),
    ({"hvfhs_license_num": "HV0005"}, True), ({"hvfhs_license_num": "HV0009"}, False),
    ({"hvfhs_license_num": None}, False),
])
def test_validation_rules_and_bounds(spark, over, ok):
    assert validate(cur(spark, raw_row(**over))).count() == (1 if ok else 0)


def test_metrics_and_rejects(spark):
    c = cur(spark, raw_row(), raw_row(request_datetime=None), raw_row(PULocationID=None, trip_miles=600.0))
    m = validation_metrics(c).first().asDict()
    assert m == {"initial_count": 3, "valid_count": 1, "rejected_count": 2,
                 "rejection_rate_pct": pytest.approx(200 / 3)}
    by_rule = {r["rule"]: r["failed_count"] for r in rejects_by_rule(c).collect()}
    assert by_rule["pickup_after_request"] == 1
    assert by_rule["pu_location_not_null"] == 1
    assert by_rule["trip_miles_in_range"] == 1
    assert by_rule["any"] == 2
    assert set(by_rule) == set(validation_rules()) | {"any"}


def test_empty_input_rate_is_null(spark):
    m = validation_metrics(frame(spark).transform(lambda d: curate(d))).first()
    assert m["initial_count"] == 0 and m["rejection_rate_pct"] is None


def test_cbd_fee_default_zero_and_optional_column(spark):
    df = frame(spark, raw_row()).withColumn("cbd_fee", F.lit(0.75))
    assert curate(df).first()["cbd_congestion_fee"] == Decimal("0.00")
    r = curate(df, cbd_column="cbd_fee").first()
    assert r["cbd_congestion_fee"] == Decimal("0.75")
    assert r["total_fare"] == Decimal("14.50")


def test_total_duration_truncates_and_avg_rounds_twice(spark):
    from tripspark.operators.marts import daily_borough

    rows = [raw_row(trip_time=t) for t in (3719, 3720, 3720)]  # 61.98 + 62.00 + 62.00 minutes
    e = validate(cur(spark, *rows)).withColumn("pickup_borough", F.lit("A")).withColumn(
        "dropoff_borough", F.lit("B"))
    r = daily_borough(e).first()
    assert r["total_duration"] == 185  # 185.98 truncated, not rounded
    assert r["avg_borough_duration"] == Decimal("61.99")  # 61.993333 -> 61.99


def test_timestamp_without_zone_input_uses_session_zone(spark):
    base = frame(spark, raw_row())
    ntz = base.withColumn("pickup_datetime", F.col("pickup_datetime").cast("timestamp_ntz"))
    assert ntz.schema["pickup_datetime"].dataType.simpleString() == "timestamp_ntz"
    a, b = curate(base).first(), curate(ntz).first()
    assert a["pickup_datetime"] == b["pickup_datetime"] and a["trip_date"] == b["trip_date"]
    assert b["pickup_hour"] == 23


def test_has_rows(spark):
    from tripspark.sources.readers import has_rows

    assert has_rows(frame(spark, raw_row())) and not has_rows(frame(spark))


def test_raw_files_with_other_physical_types(spark, tmp_path):
    """Zone-less timestamps and int32/int64 ids read through the declared raw schema."""
    from tripspark.sources.readers import read_raw

    base = frame(spark, raw_row())
    odd = base.select(*[F.col(c).cast("timestamp_ntz").alias(c) if c.endswith("_datetime")
                        else F.col(c).cast("int").alias(c) if c in ("PULocationID", "DOLocationID", "trip_time")
                        else F.col(c) for c in base.columns if c not in ("year", "month")])
    odd.write.parquet(str(tmp_path / "raw" / "year=2024" / "month=03"))
    a = curate(read_raw(spark, str(tmp_path / "raw"))).drop("processing_timestamp").first()
    b = curate(base).drop("processing_timestamp").first()
    assert a == b
