"""Declared schemas of every layer (no schema inference jobs)."""

from __future__ import annotations

from pyspark.sql.types import (BooleanType, DateType, DecimalType, DoubleType,
                               IntegerType, LongType, StringType, StructField,
                               StructType, TimestampType)

MONEY = DecimalType(10, 2)
MONEY_SUM = DecimalType(12, 2)


def _struct(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


RAW_MONEY_COLUMNS = ["base_passenger_fare", "tolls", "bcf", "sales_tax",
                     "congestion_surcharge", "airport_fee", "tips", "driver_pay"]
FLAG_COLUMNS = ["shared_request_flag", "shared_match_flag", "access_a_ride_flag",
                "wav_request_flag", "wav_match_flag"]

# Raw trip file as landed under year=/month= directories (FIXTURES.md §1).
# Read types are the widest the files may carry: Parquet widens int32 -> bigint,
# float/int32 -> double and zone-less timestamps -> timestamp on read, but never
# narrows, so ids are declared bigint; ``curate`` casts them to int.
RAW = _struct(
    ("hvfhs_license_num", StringType()),
    ("dispatching_base_num", StringType()),
    ("originating_base_num", StringType()),
    ("request_datetime", TimestampType()),
    ("on_scene_datetime", TimestampType()),
    ("pickup_datetime", TimestampType()),
    ("dropoff_datetime", TimestampType()),
    ("PULocationID", LongType()),
    ("DOLocationID", LongType()),
    ("trip_miles", DoubleType()),
    ("trip_time", LongType()),
    *[(c, DoubleType()) for c in RAW_MONEY_COLUMNS],
    *[(c, StringType()) for c in FLAG_COLUMNS],
    ("year", IntegerType()),
    ("month", IntegerType()),
)

RAW_DATA_COLUMNS = [f.name for f in RAW.fields if f.name not in ("year", "month")]

CURATED = _struct(
    ("hvfhs_license_num", StringType()),
    ("dispatching_base_num", StringType()),
    ("originating_base_num", StringType()),
    ("request_datetime", TimestampType()),
    ("on_scene_datetime", TimestampType()),
    ("pickup_datetime", TimestampType()),
    ("dropoff_datetime", TimestampType()),
    ("PULocationID", IntegerType()),
    ("DOLocationID", IntegerType()),
    ("trip_miles", MONEY),
    ("trip_time_seconds", IntegerType()),
    *[(c, MONEY) for c in RAW_MONEY_COLUMNS],
    *[(c, BooleanType()) for c in FLAG_COLUMNS],
    ("cbd_congestion_fee", MONEY),
    ("trip_date", DateType()),
    ("pickup_hour", IntegerType()),
    ("day_of_week", StringType()),
    ("is_weekend", BooleanType()),
    ("trip_duration_minutes", MONEY),
    ("total_fare", MONEY),
    ("total_amount", MONEY),
    ("avg_speed_mph", MONEY),
    ("is_airport_trip", BooleanType()),
    ("year", IntegerType()),
    ("month", IntegerType()),
    ("day", IntegerType()),
    ("processing_timestamp", TimestampType()),
)

ZONE = _struct(
    ("LocationID", IntegerType()),
    ("Borough", StringType()),
    ("Zone", StringType()),
    ("service_zone", StringType()),
)

ENRICHED_COLUMNS = [
    "trip_date", "day_of_week", "is_weekend", "PULocationID", "DOLocationID",
    "shared_request_flag", "shared_match_flag", "wav_request_flag", "wav_match_flag",
    "is_airport_trip", "total_amount", "trip_miles", "trip_duration_minutes", "driver_pay",
    "pickup_borough", "pickup_zone", "pickup_service_zone",
    "dropoff_borough", "dropoff_zone", "dropoff_service_zone",
]

DAILY_BOROUGH = _struct(
    ("trip_date", DateType()),
    ("day_of_week", StringType()),
    ("is_weekend", BooleanType()),
    ("pickup_borough", StringType()),
    ("dropoff_borough", StringType()),
    ("trip_count", LongType()),
    ("total_revenue", MONEY_SUM),
    ("total_distance", MONEY_SUM),
    ("total_duration", LongType()),
    ("avg_borough_distance", MONEY),
    ("avg_borough_duration", MONEY),
    ("year", IntegerType()),
    ("month", IntegerType()),
)

DAILY_ZONE = _struct(
    ("trip_date", DateType()),
    ("PULocationID", IntegerType()),
    ("DOLocationID", IntegerType()),
    ("is_airport_trip", BooleanType()),
    ("trip_count", LongType()),
    ("total_revenue", MONEY_SUM),
    ("avg_zone_distance", MONEY),
    ("avg_zone_duration", MONEY),
    ("avg_fare_per_trip", MONEY),
    ("total_driver_pay", MONEY_SUM),
    ("pickup_zone", StringType()),
    ("pickup_borough", StringType()),
    ("pickup_service_zone", StringType()),
    ("dropoff_zone", StringType()),
    ("dropoff_borough", StringType()),
    ("dropoff_service_zone", StringType()),
    ("year", IntegerType()),
    ("month", IntegerType()),
    ("day", IntegerType()),
)

DAILY_SERVICE = _struct(
    ("trip_date", DateType()),
    ("day_of_week", StringType()),
    ("is_weekend", BooleanType()),
    ("shared_request_flag", BooleanType()),
    ("wav_request_flag", BooleanType()),
    ("trip_count", LongType()),
    ("total_revenue", MONEY_SUM),
    ("shared_matched_count", LongType()),
    ("wav_matched_count", LongType()),
    ("year", IntegerType()),
    ("month", IntegerType()),
)


def with_column(schema: StructType, name: str, dtype) -> StructType:
    """Schema plus one trailing nullable column (e.g. an incremental batch id)."""
    return StructType(list(schema.fields) + [StructField(name, dtype, True)])

# Daily pre-aggregate at id level: the three marts are re-aggregations of it.
MONEY_TOTAL = DecimalType(20, 2)
DAILY_CUBE = _struct(
    ("trip_date", DateType()),
    ("day_of_week", StringType()),
    ("is_weekend", BooleanType()),
    ("PULocationID", IntegerType()),
    ("DOLocationID", IntegerType()),
    ("is_airport_trip", BooleanType()),
    ("shared_request_flag", BooleanType()),
    ("wav_request_flag", BooleanType()),
    ("trip_count", LongType()),
    ("sum_amount", MONEY_TOTAL),
    ("n_amount", LongType()),
    ("sum_miles", MONEY_TOTAL),
    ("n_miles", LongType()),
    ("sum_minutes", MONEY_TOTAL),
    ("n_minutes", LongType()),
    ("sum_driver_pay", MONEY_TOTAL),
    ("n_driver_pay", LongType()),
    ("shared_matched_count", LongType()),
    ("wav_matched_count", LongType()),
    ("year", IntegerType()),
    ("month", IntegerType()),
    ("day", IntegerType()),
)
