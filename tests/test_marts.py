"""Join semantics and cross-mart properties."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tripspark.operators.enrich import enrich
from tripspark.operators.marts import daily_borough, daily_service, daily_zone
from tripspark.plans import registry
from tripspark.schemas import ZONE
from tripspark.sources.readers import DuplicateZoneError, check_zones


def test_marts_agree_on_trip_count_and_revenue(spark, sf_small):
    valid = registry.valid(spark, sf_small)
    n = valid.count()
    b, z, s = (registry.borough(spark, sf_small), registry.zone_mart(spark, sf_small),
               registry.service(spark, sf_small))
    totals = [df.agg(F.sum("trip_count"), F.sum("total_revenue")).first() for df in (b, z, s)]
    assert {t[0] for t in totals} == {n}
    assert len({t[1] for t in totals}) == 1
    assert valid.agg(F.sum("total_amount")).first()[0] == totals[0][1]


def test_unmatched_and_null_ids_keep_trips(spark, sf_small):
    valid = registry.valid(spark, sf_small)
    z, n = registry.zones(spark, sf_small)
    e = enrich(valid, z, n)
    assert e.count() == valid.count()
    # PULocationID 99 has no zone: the trip stays, with NULL names, and forms its own group
    unmatched = e.filter(F.col("PULocationID") == 99)
    assert unmatched.count() > 0 and unmatched.filter(F.col("pickup_borough").isNotNull()).count() == 0
    b = daily_borough(e)
    assert b.filter(F.col("pickup_borough").isNull()).agg(F.sum("trip_count")).first()[0] == unmatched.count()


def test_duplicate_zone_id_raises(spark):
    zones = spark.createDataFrame([(1, "A", "Z1", "S"), (1, "B", "Z2", "S")], schema=ZONE)
    with pytest.raises(DuplicateZoneError):
        check_zones(zones)


def test_zones_without_id_are_tolerated(spark):
    zones = spark.createDataFrame([(1, "A", "Z1", "S"), (None, "B", "Z2", "S"), (None, "C", "Z3", "S")], schema=ZONE)
    assert check_zones(zones) == 3
    trips = spark.createDataFrame([(1, 1), (None, 1)], "PULocationID int, DOLocationID int")
    from tripspark.operators.enrich import join_zone_names

    got = sorted((str(r["pickup_borough"]), r["dropoff_borough"]) for r in join_zone_names(trips, zones).collect())
    assert got == [("A", "A"), ("None", "A")]


def test_zone_names_equal_max_over_group(spark, sf_small):
    """Aggregate-then-join gives what max(name) over the joined rows gives."""
    valid = registry.valid(spark, sf_small)
    z, n = registry.zones(spark, sf_small)
    e = enrich(valid, z, n)
    ref = (e.groupBy("trip_date", "PULocationID", "DOLocationID", "is_airport_trip")
           .agg(F.max("pickup_zone").alias("pickup_zone"), F.max("dropoff_borough").alias("dropoff_borough")))
    got = daily_zone(valid, z, n).select(*ref.columns)
    assert got.exceptAll(ref).count() == 0 and ref.exceptAll(got).count() == 0


def test_service_counts(spark, sf_small):
    s = daily_service(registry.enriched(spark, sf_small))
    bad = s.filter((F.col("shared_matched_count") > F.col("trip_count")) |
                   (F.col("wav_matched_count") > F.col("trip_count")))
    assert bad.count() == 0
