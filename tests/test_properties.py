"""Randomised checks against brute force on small generated frames.

A plain-Python model of the curated columns and validation rules is compared
with Spark's ``curate``/``validate``; the pre-aggregate marts are compared with
the direct marts on data that includes NULL durations and amounts.
"""

from __future__ import annotations

import datetime as dt
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tripspark.operators import marts
from tripspark.operators.curate import curate
from tripspark.operators.quality import validate
from tripspark.schemas import RAW, ZONE

from test_curate import raw_row  # noqa: E402  (tests/ is on sys.path)

T0 = dt.datetime(2024, 1, 1)
CENT = Decimal("0.01")
LICENSES = ["HV0002", "HV0003", "HV0004", "HV0005", "HV0009", None]


def money(x):
    return Decimal(repr(x if x is not None else 0.0)).quantize(CENT, ROUND_HALF_UP)


def thousandths(lo, hi):
    return st.one_of(st.none(), st.integers(lo, hi).map(lambda v: v / 1000))


row_strategy = st.fixed_dictionaries({
    "hvfhs_license_num": st.sampled_from(LICENSES),
    "req": st.one_of(st.none(), st.integers(0, 60 * 24 * 20)),
    "pu": st.one_of(st.none(), st.integers(0, 60 * 24 * 20)),
    "dur": st.one_of(st.none(), st.integers(-5, 120)),
    "PULocationID": st.one_of(st.none(), st.integers(1, 4)),
    "DOLocationID": st.one_of(st.none(), st.integers(1, 4)),
    "trip_miles": thousandths(-20, 600_000),
    "trip_time": st.one_of(st.none(), st.integers(-10, 7200)),
    "base_passenger_fare": thousandths(-1000, 10_001_000),
    "tolls": thousandths(0, 20_000),
    "tips": thousandths(0, 20_000),
    "airport_fee": st.one_of(st.none(), st.just(2.5), st.just(0.0)),
    "shared_request_flag": st.sampled_from(["Y", "N", None]),
    "shared_match_flag": st.sampled_from(["Y", "N"]),
    "wav_request_flag": st.sampled_from(["Y", "N"]),
})


def to_raw(d):
    minute = dt.timedelta(minutes=1)
    req = None if d["req"] is None else T0 + d["req"] * minute
    pu = None if d["pu"] is None else T0 + d["pu"] * minute
    do = None if (pu is None or d["dur"] is None) else pu + d["dur"] * minute
    over = {k: d[k] for k in ("hvfhs_license_num", "PULocationID", "DOLocationID", "trip_miles", "trip_time",
                              "base_passenger_fare", "tolls", "tips", "airport_fee", "shared_request_flag",
                              "shared_match_flag", "wav_request_flag")}
    return raw_row(request_datetime=req, pickup_datetime=pu, dropoff_datetime=do, **over)


def model(r):
    """Expected (valid?, total_amount, minutes, day name) of one raw row."""
    f = dict(zip(RAW.fieldNames(), r))
    miles, fare = money(f["trip_miles"]), money(f["base_passenger_fare"])
    pu, do, req = f["pickup_datetime"], f["dropoff_datetime"], f["request_datetime"]
    ok = (pu is not None and do is not None and f["PULocationID"] is not None
          and f["DOLocationID"] is not None and 0 <= miles <= 500 and 0 <= fare <= 10000
          and do > pu and req is not None and pu >= req
          and f["hvfhs_license_num"] in ("HV0002", "HV0003", "HV0004", "HV0005"))
    z = [f[c] if f[c] is not None else 0.0 for c in
         ("base_passenger_fare", "tolls", "bcf", "sales_tax", "congestion_surcharge", "airport_fee")]
    total = z[0]
    for v in z[1:]:
        total = total + v
    total = total + 0.0 + (f["tips"] if f["tips"] is not None else 0.0)
    tt = f["trip_time"]
    minutes = None if tt is None else Decimal(repr(tt / 60.0)).quantize(CENT, ROUND_HALF_UP)
    day = "Unknown" if pu is None else pu.strftime("%A")
    return ok, money(total), minutes, day


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(row_strategy, min_size=1, max_size=40))
def test_curate_and_validate_match_model(spark, rows):
    # the passthrough column carries a row id through curate
    raw = [to_raw(d)[:1] + (f"R{i}",) + to_raw(d)[2:] for i, d in enumerate(rows)]
    cur = curate(spark.createDataFrame(raw, schema=RAW))
    got = {r["dispatching_base_num"]: (r["total_amount"], r["trip_duration_minutes"], r["day_of_week"])
           for r in cur.collect()}
    expected = {f"R{i}": model(r) for i, r in enumerate(raw)}
    for rid, (ok, total, minutes, day) in expected.items():
        assert got[rid] == (total, minutes, day), rid
    valid_ids = {r["dispatching_base_num"] for r in validate(cur).select("dispatching_base_num").collect()}
    assert valid_ids == {rid for rid, v in expected.items() if v[0]}


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(row_strategy, min_size=1, max_size=60))
def test_pre_aggregate_marts_equal_direct_marts(spark, rows):
    trips = curate(spark.createDataFrame([to_raw(d) for d in rows], schema=RAW)).filter(
        F.col("pickup_datetime").isNotNull())
    zones = spark.createDataFrame([(1, "B1", "Z1", "S1"), (2, "B1", "Z2", "S2"), (3, "B2", "Z3", "S1")],
                                  schema=ZONE)
    from tripspark.operators.enrich import enrich

    enriched = enrich(trips, zones, 3)
    cube = marts.daily_cube(trips)

    def same(a, b):
        b = b.select(*a.columns)
        return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0

    assert same(marts.daily_borough(enriched), marts.borough_from_cube(cube, zones, 3))
    assert same(marts.daily_zone(trips, zones, 3), marts.zone_from_cube(cube, zones, 3))
    assert same(marts.daily_service(enriched), marts.service_from_cube(cube))
