"""Trip-shaped input derived from the driver's TPC-H-like tables (FIXTURES.md §4).

The reference has no sample data, so raw trips are a deterministic view over
``lineitem ⋈ orders ⋈ supplier ⋈ customer`` and the zone dimension is
``nation ⋈ region``. The view is landed once per input directory as Parquet
under ``year=/month=`` in the shared scratch folder (the real input is a Parquet
scan too), and re-used by every query afterwards.
"""

from __future__ import annotations

import hashlib
import threading

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripspark.schemas import RAW, ZONE
from tripspark.session import path_exists, path_stamp, same_path, scratch_root

FIXTURE_VERSION = "v3"
_LOCK = threading.Lock()  # one landing at a time if queries run on several threads


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _seconds(n: Column) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), n.cast("decimal(18,6)"))


def _base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The few columns that a trip is made of, with the year and two-digit month of its request.

    All joins are plain equi-joins; Spark/AQE picks broadcast for the small
    dimension sides by measured size, sort-merge otherwise. Orders get their
    customer's nation before they meet lineitem, so that only the lineitem/orders
    join moves lineitem rows once customers are too many to broadcast.
    """
    l = _table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_returnflag")
    o = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    s = _table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    c = _table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    o = o.join(c, o.o_custkey == c.c_custkey).select("o_orderkey", "o_orderdate", "c_nationkey")
    base = l.join(o, l.l_orderkey == o.o_orderkey).join(s, l.l_suppkey == s.s_suppkey)
    base = base.select(
        (F.col("l_orderkey") * 7 + F.col("l_linenumber")).alias("k"), "l_suppkey", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_returnflag", "o_orderdate", "s_nationkey", "c_nationkey")
    req = _request_time()
    return base.select("*", F.year(req).alias("year"), F.lpad(F.month(req).cast("string"), 2, "0").alias("month"))


def _request_time() -> Column:
    return F.col("o_orderdate") + _seconds(F.col("k") * 37 % 86400)


def trip_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw trips (RAW schema incl. year/month of the request) as a lazy view."""
    trips = _trips(_base(spark, sf_dir))
    return trips.withColumn("month", F.col("month").cast(RAW["month"].dataType))


def _trips(base: DataFrame) -> DataFrame:
    """Raw trips of the base rows, one by one; year and month are passed on as they are."""
    k = F.col("k")
    step1 = base.select(
        "*",
        F.when(k % 59 == 0, F.lit(0).cast("bigint"))
         .otherwise((F.col("l_quantity") * 90).cast("bigint") + F.col("l_suppkey") % 60).alias("tt"),
        _request_time().alias("req"),
    )
    step2 = step1.select(
        "*",
        F.when(k % 29 == 0, F.col("req") - _seconds(F.lit(60)))
         .otherwise(F.col("req") + _seconds(F.lit(300))).alias("pu"),
    )
    base_num = F.concat(F.lit("B"), F.lpad(F.col("l_suppkey").cast("string"), 5, "0"))
    null = F.lit(None)
    ts = lambda c: c.cast("timestamp")
    return step2.select(
        F.when(k % 23 == 0, F.lit("HV0009"))
         .otherwise(F.concat(F.lit("HV000"), (2 + k % 4).cast("string"))).alias("hvfhs_license_num"),
        base_num.alias("dispatching_base_num"),
        F.when(k % 3 == 0, null.cast("string")).otherwise(base_num).alias("originating_base_num"),
        ts(F.when(k % 41 == 0, null).otherwise(F.col("req"))).alias("request_datetime"),
        ts(F.when(F.col("l_returnflag") == "A", F.col("req") + _seconds(F.lit(120)))).alias("on_scene_datetime"),
        ts(F.when(k % 71 == 0, null).otherwise(F.col("pu"))).alias("pickup_datetime"),
        ts(F.when(k % 73 == 0, null)
            .when(k % 31 == 0, F.col("pu"))
            .otherwise(F.col("pu") + _seconds(F.col("tt")))).alias("dropoff_datetime"),
        F.when(k % 37 == 0, null.cast("int")).when(k % 43 == 0, F.lit(99))
         .otherwise(F.col("s_nationkey")).alias("PULocationID"),
        F.when(k % 79 == 0, null.cast("int")).otherwise(F.col("c_nationkey")).alias("DOLocationID"),
        F.when(k % 47 == 0, null.cast("double")).when(k % 53 == 0, F.lit(600.0))
         .otherwise(F.col("l_quantity") * 37.0 / 100.0).alias("trip_miles"),
        F.col("tt").alias("trip_time"),
        F.when(k % 61 == 0, F.lit(-5.0)).when(k % 67 == 0, F.lit(20000.0))
         .when(k % 83 == 0, null.cast("double"))
         .otherwise(F.floor("l_extendedprice") / 100.0 + F.lit(0.003)).alias("base_passenger_fare"),
        # tenths of a cent, away from half cents: summing before rounding gives other
        # totals than rounding before summing
        (F.col("l_discount") * 10.0 + F.lit(0.003)).alias("tolls"),
        (F.col("l_tax") * 5.0).alias("bcf"),
        (F.col("l_tax") * 20.0).alias("sales_tax"),
        F.when(k % 13 == 0, null.cast("double")).otherwise(F.lit(2.75)).alias("congestion_surcharge"),
        F.when(F.col("l_returnflag") == "R", F.lit(2.5)).alias("airport_fee"),
        (F.col("l_quantity") / 4.0).alias("tips"),
        (F.floor(F.col("l_extendedprice") / 1.5) / 100.0).alias("driver_pay"),
        F.when(k % 5 == 0, F.lit("Y")).when(k % 7 == 0, null.cast("string"))
         .otherwise(F.lit("N")).alias("shared_request_flag"),
        F.when(k % 10 == 0, F.lit("Y")).otherwise(F.lit("N")).alias("shared_match_flag"),
        F.when(k % 17 == 0, F.lit("Y")).otherwise(F.lit(" ")).alias("access_a_ride_flag"),
        F.when(k % 11 == 0, F.lit("Y")).otherwise(F.lit("N")).alias("wav_request_flag"),
        F.when(k % 22 == 0, F.lit("Y")).otherwise(F.lit("N")).alias("wav_match_flag"),
        "year", "month",
    ).select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in RAW.fields[:-2]], "year", "month")


def zone_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone dimension: LocationID = nation key, Borough = region name."""
    n = _table(spark, sf_dir, "nation")
    r = _table(spark, sf_dir, "region")
    return (n.join(r, n.n_regionkey == r.r_regionkey)
            .select(F.col("n_nationkey").cast("int").alias("LocationID"),
                    F.col("r_name").alias("Borough"),
                    F.col("n_name").alias("Zone"),
                    F.concat(F.lit("SZ_"), (F.col("n_regionkey") % 3).cast("string")).alias("service_zone")))


def _fingerprint(spark: SparkSession, sf_dir: str) -> str:
    h = hashlib.sha1(FIXTURE_VERSION.encode())
    h.update(same_path(spark, sf_dir).encode())
    for name in ("lineitem", "orders", "supplier", "customer", "nation", "region"):
        size, changed = path_stamp(spark, f"{sf_dir}/{name}.parquet")
        h.update(f"{name}:{size}:{changed}".encode())
    return h.hexdigest()[:16]


def fixture_dir(spark: SparkSession, sf_dir: str) -> str:
    return f"{scratch_root(spark)}/tripspark-fixture-{_fingerprint(spark, sf_dir)}"


def raw_path(spark: SparkSession, sf_dir: str) -> str:
    """Landed raw trips for ``sf_dir``: written once, then re-used.

    The narrow base rows are dealt and sorted by month, and become trips where they
    are written: the wide rows are neither shuffled nor sorted."""
    path = f"{fixture_dir(spark, sf_dir)}/raw"
    with _LOCK:
        if not path_exists(spark, f"{path}/_SUCCESS"):
            _landed_trips(spark, sf_dir).write.mode("overwrite").partitionBy("year", "month").parquet(path)
    return path


def _landed_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All trips, dealt and sorted by year and two-digit month."""
    return _trips(_base(spark, sf_dir).hint("rebalance", "year", "month").sortWithinPartitions("year", "month"))


#: Extra raw column of ``raw_cbd_path`` and the first year that has it.
CBD_COLUMN, CBD_FROM_YEAR = "cbd_congestion_fee", 1997


def raw_cbd_path(spark: SparkSession, sf_dir: str) -> str:
    """The raw trips landed again with a congestion fee in the files of later years only."""
    from tripspark.sinks.writers import land

    source, path = raw_path(spark, sf_dir), f"{fixture_dir(spark, sf_dir)}/raw_cbd"
    with _LOCK:
        if not path_exists(spark, f"{path}/_SUCCESS"):
            raw = spark.read.schema(RAW).parquet(source)
            t = F.col("trip_time")
            fee = F.when(t % 7 == 0, F.lit(None)).when(t % 3 == 0, F.lit(0.753)).otherwise(F.lit(1.5)).cast("double")
            land(raw.filter(F.col("year") >= CBD_FROM_YEAR).withColumn(CBD_COLUMN, fee), path, dynamic=False, rebalance=False)
            land(raw.filter(F.col("year") < CBD_FROM_YEAR), path, mode="append", rebalance=False)
    return path


def zone_csv_path(spark: SparkSession, sf_dir: str) -> str:
    """Zone lookup as CSV with header, like the reference's lookup file."""
    path = f"{fixture_dir(spark, sf_dir)}/zones_csv"
    with _LOCK:
        if not path_exists(spark, f"{path}/_SUCCESS"):
            (zone_view(spark, sf_dir).select(*[f.name for f in ZONE.fields])
             .write.mode("overwrite").option("header", True).csv(path))
    return path
