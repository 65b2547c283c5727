"""P1 (raw -> curated projection) and P3 (ordered preview)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripspark.functions import trip_expr as E
from tripspark.schemas import CURATED, FLAG_COLUMNS, MONEY, RAW_MONEY_COLUMNS


def curate(raw: DataFrame, processed_at: _dt.datetime | Column | None = None,
           cbd_column: str | None = None, passthrough: tuple[str, ...] = ()) -> DataFrame:
    """Raw trips -> the 38 curated columns, one Project node, no UDF.

    ``processed_at`` fixes ``processing_timestamp`` (default: query start
    time). ``cbd_column`` takes the congestion fee from that raw column if
    given; by default the fee is 0, as in the reference. Columns named in
    ``passthrough`` follow unchanged.
    """
    pickup = E.ts("pickup_datetime")
    trip_time = F.col("trip_time")
    cbd = E.zero_if_null(cbd_column) if cbd_column else None
    fare = E.fare_sum(cbd)
    if processed_at is None:
        stamp = F.current_timestamp()
    elif isinstance(processed_at, Column):
        stamp = processed_at
    else:
        stamp = F.lit(processed_at)
    cols = [
        F.col("hvfhs_license_num"),
        F.col("dispatching_base_num"),
        F.col("originating_base_num"),
        E.ts("request_datetime").alias("request_datetime"),
        E.ts("on_scene_datetime").alias("on_scene_datetime"),
        pickup.alias("pickup_datetime"),
        E.ts("dropoff_datetime").alias("dropoff_datetime"),
        E.as_int("PULocationID").alias("PULocationID"),
        E.as_int("DOLocationID").alias("DOLocationID"),
        E.money("trip_miles").alias("trip_miles"),
        E.as_int("trip_time").alias("trip_time_seconds"),
        *[E.money(c).alias(c) for c in RAW_MONEY_COLUMNS],
        *[E.flag(c).alias(c) for c in FLAG_COLUMNS],
        (cbd if cbd is not None else F.lit(0.0)).try_cast(MONEY).alias("cbd_congestion_fee"),
        pickup.cast("date").alias("trip_date"),
        F.hour(pickup).alias("pickup_hour"),
        E.day_name(pickup).alias("day_of_week"),
        E.weekend(pickup).alias("is_weekend"),
        E.minutes(trip_time).alias("trip_duration_minutes"),
        fare.try_cast(MONEY).alias("total_fare"),
        (fare + E.zero_if_null("tips")).try_cast(MONEY).alias("total_amount"),
        E.speed_mph(F.col("trip_miles"), trip_time).alias("avg_speed_mph"),
        (E.zero_if_null("airport_fee") > 0).alias("is_airport_trip"),
        F.year(pickup).alias("year"),
        F.month(pickup).alias("month"),
        F.dayofmonth(pickup).alias("day"),
        stamp.cast("timestamp").alias("processing_timestamp"),
    ]
    out = raw.select(*cols, *passthrough)
    assert out.columns == [*CURATED.fieldNames(), *passthrough], out.columns
    return out


PREVIEW_COLUMNS = ["trip_date", "PULocationID", "DOLocationID", "total_amount", "is_weekend"]


def preview(df: DataFrame, columns: list[str] | None = None, n: int = 5) -> DataFrame:
    """First ``n`` rows of a column subset in a total order.

    Ordering by every selected column makes the result deterministic (ties are
    identical rows). Planned as TakeOrderedAndProject: each task keeps its own
    top ``n`` and only those reach the final merge.
    """
    columns = columns or PREVIEW_COLUMNS
    return df.select(*columns).orderBy(*[F.col(c).asc_nulls_first() for c in columns]).limit(n)
