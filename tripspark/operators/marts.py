"""Daily marts (A1-A3), their size report (A7), top-k reports (T1-T3) and the
analyses built on them (SURVEY §2.11).

Aggregates run as HashAggregate with a partial (map-side) step: a hot group
key is combined inside each task before the shuffle, so one key holding a
third of all trips still moves only one buffer row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripspark.operators.enrich import BROADCAST_ZONE_ROWS, join_zone_names
from tripspark.schemas import DAILY_CUBE, MONEY, MONEY_SUM, MONEY_TOTAL
from tripspark.sources.readers import check_zones

# Type of a revenue total over many days and boroughs.
DecimalTypeWide = "decimal(18,2)"


def _sum_money(c: str) -> Column:
    return F.sum(c).try_cast(MONEY_SUM)


def _avg_money(c: str) -> Column:
    # avg(decimal(10,2)) is decimal(14,6); the cast rounds HALF_UP again.
    return F.avg(c).try_cast(MONEY)


def _date_parts(df: DataFrame, day: bool = False) -> DataFrame:
    parts = {"year": F.year("trip_date"), "month": F.month("trip_date")}
    if day:
        parts["day"] = F.dayofmonth("trip_date")
    return df.withColumns(parts)


BOROUGH_KEYS = ["trip_date", "day_of_week", "is_weekend", "pickup_borough", "dropoff_borough"]
ZONE_KEYS = ["trip_date", "PULocationID", "DOLocationID", "is_airport_trip"]
SERVICE_KEYS = ["trip_date", "day_of_week", "is_weekend", "shared_request_flag", "wav_request_flag"]


def daily_borough(enriched: DataFrame) -> DataFrame:
    """A1: one row per day × pickup borough × dropoff borough."""
    agg = enriched.groupBy(*BOROUGH_KEYS).agg(
        F.count(F.lit(1)).alias("trip_count"),
        _sum_money("total_amount").alias("total_revenue"),
        _sum_money("trip_miles").alias("total_distance"),
        F.sum("trip_duration_minutes").try_cast("bigint").alias("total_duration"),
        _avg_money("trip_miles").alias("avg_borough_distance"),
        _avg_money("trip_duration_minutes").alias("avg_borough_duration"),
    )
    return _date_parts(agg)


ZONE_NAME_COLUMNS = ["pickup_zone", "pickup_borough", "pickup_service_zone",
                     "dropoff_zone", "dropoff_borough", "dropoff_service_zone"]


def daily_zone(trips: DataFrame, zones: DataFrame, zone_rows: int | None = None,
               broadcast_limit: int = BROADCAST_ZONE_ROWS) -> DataFrame:
    """A2: one row per day × pickup id × dropoff id × airport flag.

    ``trips`` are curated or enriched trips (only ids and measures are used).
    Aggregation runs on the numeric ids first (HashAggregate; the reference's
    ``max`` over six name strings forces a sort-based aggregate), then the
    names are joined onto the aggregated rows. With unique zone ids (checked)
    this equals taking ``max`` of the names per group.
    """
    if zone_rows is None:
        zone_rows = check_zones(zones)
    agg = trips.groupBy(*ZONE_KEYS).agg(
        F.count(F.lit(1)).alias("trip_count"),
        _sum_money("total_amount").alias("total_revenue"),
        _avg_money("trip_miles").alias("avg_zone_distance"),
        _avg_money("trip_duration_minutes").alias("avg_zone_duration"),
        _avg_money("total_amount").alias("avg_fare_per_trip"),
        _sum_money("driver_pay").alias("total_driver_pay"),
    )
    named = join_zone_names(agg, zones, zone_rows, broadcast_limit)
    measures = ["trip_count", "total_revenue", "avg_zone_distance", "avg_zone_duration",
                "avg_fare_per_trip", "total_driver_pay"]
    return _date_parts(named.select(*ZONE_KEYS, *measures, *ZONE_NAME_COLUMNS), day=True)


def daily_service(enriched: DataFrame) -> DataFrame:
    """A3: one row per day × shared-request flag × accessible-request flag."""
    agg = enriched.groupBy(*SERVICE_KEYS).agg(
        F.count(F.lit(1)).alias("trip_count"),
        _sum_money("total_amount").alias("total_revenue"),
        F.count_if(F.col("shared_match_flag")).alias("shared_matched_count"),
        F.count_if(F.col("wav_match_flag")).alias("wav_matched_count"),
    )
    return _date_parts(agg)


# -- daily pre-aggregate ---------------------------------------------------------
#
# One pass over the trips builds a day × pickup id × dropoff id × flags table of
# exact decimal sums and non-NULL counts. The three marts are re-aggregations
# of it: the trips are scanned and shuffled once (as partial aggregates)
# instead of three times, and the incremental path recomputes months of marts
# from this small table instead of from the trips.

CUBE_KEYS = ["trip_date", "day_of_week", "is_weekend", "PULocationID", "DOLocationID",
             "is_airport_trip", "shared_request_flag", "wav_request_flag"]


def daily_cube(trips: DataFrame) -> DataFrame:
    """Exact additive measures per day and id-level group (no rounding yet)."""
    agg = trips.groupBy(*CUBE_KEYS).agg(
        F.count(F.lit(1)).alias("trip_count"),
        F.sum("total_amount").alias("sum_amount"),
        F.count("total_amount").alias("n_amount"),
        F.sum("trip_miles").alias("sum_miles"),
        F.count("trip_miles").alias("n_miles"),
        F.sum("trip_duration_minutes").alias("sum_minutes"),
        F.count("trip_duration_minutes").alias("n_minutes"),
        F.sum("driver_pay").alias("sum_driver_pay"),
        F.count("driver_pay").alias("n_driver_pay"),
        F.count_if(F.col("shared_match_flag")).alias("shared_matched_count"),
        F.count_if(F.col("wav_match_flag")).alias("wav_matched_count"),
    )
    return _date_parts(agg, day=True)


#: Sums of the pre-aggregate, with the counts of the values that are in them.
CUBE_SUMS = {"sum_amount": "n_amount", "sum_miles": "n_miles", "sum_minutes": "n_minutes", "sum_driver_pay": "n_driver_pay"}
CUBE_COUNTS = ["trip_count", *CUBE_SUMS.values(), "shared_matched_count", "wav_matched_count"]


def negated(cube: DataFrame) -> DataFrame:
    """A pre-aggregate that takes away what ``cube`` holds when it is merged."""
    return cube.withColumns({c: -F.col(c) for c in [*CUBE_SUMS, *CUBE_COUNTS]})


def merge_cubes(cubes: DataFrame) -> DataFrame:
    """One pre-aggregate from the rows of several, some of them perhaps negated.

    The measures are exact and additive, so the result is the pre-aggregate of the
    trips added and not taken back: groups without trips vanish, and a sum over no
    values is NULL again."""
    agg = cubes.groupBy(*CUBE_KEYS).agg(
        *[F.sum(c).alias(c) for c in CUBE_COUNTS],
        *[F.when(F.sum(n) > 0, F.sum(c)).cast(MONEY_TOTAL).alias(c) for c, n in CUBE_SUMS.items()])
    return _date_parts(agg.filter("trip_count > 0"), day=True).select(*DAILY_CUBE.fieldNames())


def _avg_from_sums(total: str, n: str) -> Column:
    """``avg`` of a decimal(10,2) column rebuilt from its exact sum and count.

    Spark evaluates that average as avg(unscaled long) in DOUBLE / 100, cast
    to decimal(14,6) (the sums of integers are exact in DOUBLE below 2^53, so
    the order of addition does not matter); the same steps are applied here,
    then the mart's cast to decimal(10,2).
    """
    unscaled = (F.sum(total) * F.lit(100)).cast("bigint").cast("double")
    cnt = F.sum(n)
    return (F.when(cnt > 0, unscaled / cnt.cast("double") / F.lit(100.0))
            .cast("decimal(14,6)").try_cast(MONEY))


def borough_from_cube(cube: DataFrame, zones: DataFrame, zone_rows: int | None = None,
                      broadcast_limit: int = BROADCAST_ZONE_ROWS) -> DataFrame:
    """A1 from the pre-aggregate (equal to ``daily_borough`` of the trips)."""
    named = join_zone_names(cube, zones, zone_rows, broadcast_limit)
    agg = named.groupBy(*BOROUGH_KEYS).agg(
        F.sum("trip_count").alias("trip_count"),
        F.sum("sum_amount").try_cast(MONEY_SUM).alias("total_revenue"),
        F.sum("sum_miles").try_cast(MONEY_SUM).alias("total_distance"),
        F.sum("sum_minutes").try_cast("bigint").alias("total_duration"),
        _avg_from_sums("sum_miles", "n_miles").alias("avg_borough_distance"),
        _avg_from_sums("sum_minutes", "n_minutes").alias("avg_borough_duration"),
    )
    return _date_parts(agg)


def zone_from_cube(cube: DataFrame, zones: DataFrame, zone_rows: int | None = None,
                   broadcast_limit: int = BROADCAST_ZONE_ROWS) -> DataFrame:
    """A2 from the pre-aggregate (equal to ``daily_zone`` of the trips)."""
    if zone_rows is None:
        zone_rows = check_zones(zones)
    agg = cube.groupBy(*ZONE_KEYS).agg(
        F.sum("trip_count").alias("trip_count"),
        F.sum("sum_amount").try_cast(MONEY_SUM).alias("total_revenue"),
        _avg_from_sums("sum_miles", "n_miles").alias("avg_zone_distance"),
        _avg_from_sums("sum_minutes", "n_minutes").alias("avg_zone_duration"),
        _avg_from_sums("sum_amount", "n_amount").alias("avg_fare_per_trip"),
        F.sum("sum_driver_pay").try_cast(MONEY_SUM).alias("total_driver_pay"),
    )
    named = join_zone_names(agg, zones, zone_rows, broadcast_limit)
    measures = ["trip_count", "total_revenue", "avg_zone_distance", "avg_zone_duration",
                "avg_fare_per_trip", "total_driver_pay"]
    return _date_parts(named.select(*ZONE_KEYS, *measures, *ZONE_NAME_COLUMNS), day=True)


def service_from_cube(cube: DataFrame) -> DataFrame:
    """A3 from the pre-aggregate (equal to ``daily_service`` of the trips)."""
    agg = cube.groupBy(*SERVICE_KEYS).agg(
        F.sum("trip_count").alias("trip_count"),
        F.sum("sum_amount").try_cast(MONEY_SUM).alias("total_revenue"),
        F.sum("shared_matched_count").alias("shared_matched_count"),
        F.sum("wav_matched_count").alias("wav_matched_count"),
    )
    return _date_parts(agg)


def compression_report(cube: DataFrame, borough: DataFrame, zone: DataFrame,
                       service: DataFrame) -> DataFrame:
    """Rows of each mart and their share of the curated rows (percent).

    ``cube`` is the daily pre-aggregate that the marts were made of; its trip
    counts add up to the curated rows, so the trips are not read again. Each
    table is counted by one aggregate with one row per task in its shuffle.
    """
    trips = cube.agg(F.coalesce(F.sum("trip_count"), F.lit(0)).alias("row_count"))
    counted = trips.select(F.lit("curated").alias("table_name"), "row_count")
    for name, df in {"daily_borough": borough, "daily_zone": zone, "daily_service": service}.items():
        counted = counted.unionByName(df.agg(F.count(F.lit(1)).alias("row_count"))
                                      .select(F.lit(name).alias("table_name"), "row_count"))
    base = F.max(F.when(F.col("table_name") == "curated", F.col("row_count"))).over(Window.partitionBy(F.lit(0)))
    return counted.select(
        "table_name", "row_count",
        (F.try_divide(F.col("row_count").cast("double"), base.cast("double")) * F.lit(100.0)).alias("pct_of_curated"))


def total_overflows(cube: DataFrame, zones: DataFrame, zone_rows: int | None = None,
                    broadcast_limit: int = BROADCAST_ZONE_ROWS) -> DataFrame:
    """How many totals of each mart are beyond decimal(12,2), hence NULL in the mart.

    The totals are added up in the pre-aggregate's wide decimals and compared with what the
    mart can hold: (table_name, total_name, overflow_count)."""
    named = join_zone_names(cube, zones, zone_rows, broadcast_limit)
    given = [("daily_borough", named, BOROUGH_KEYS, {"total_revenue": "sum_amount", "total_distance": "sum_miles"}),
             ("daily_zone", cube, ZONE_KEYS, {"total_revenue": "sum_amount", "total_driver_pay": "sum_driver_pay"}),
             ("daily_service", cube, SERVICE_KEYS, {"total_revenue": "sum_amount"})]
    out = None
    for table, rows, keys, totals in given:
        wide = rows.groupBy(*keys).agg(*[F.sum(c).alias(name) for name, c in totals.items()])
        lost = wide.agg(*[F.count_if(F.col(t).isNotNull() & F.col(t).try_cast(MONEY_SUM).isNull()).alias(t) for t in totals])
        part = lost.unpivot([], list(totals), "total_name", "overflow_count").select(
            F.lit(table).alias("table_name"), "total_name", "overflow_count")
        out = part if out is None else out.unionByName(part)
    return out


def _top(df: DataFrame, n: int, order: list[Column]) -> DataFrame:
    return df.orderBy(*order).limit(n)


def top_boroughs(borough: DataFrame, n: int = 10) -> DataFrame:
    """Borough pairs with the highest daily revenue (ties by group keys)."""
    return _top(borough, n, [F.desc_nulls_last("total_revenue"),
                             *[F.asc_nulls_first(k) for k in BOROUGH_KEYS]])


def top_routes(zone: DataFrame, n: int = 10) -> DataFrame:
    """Routes (pickup id, dropoff id, day) with the highest revenue."""
    return _top(zone, n, [F.desc_nulls_last("total_revenue"),
                          *[F.asc_nulls_first(k) for k in ZONE_KEYS]])


def service_ordered(service: DataFrame, n: int = 10) -> DataFrame:
    """First rows of the service mart by date, shared flag, accessible flag.

    The three keys are unique in the mart (the date fixes day name and
    weekend), so the order is total.
    """
    return _top(service, n, [F.asc_nulls_first("trip_date"),
                             F.asc_nulls_first("shared_request_flag"),
                             F.asc_nulls_first("wav_request_flag")])


def weekend_revenue(borough: DataFrame) -> DataFrame:
    """Weekend vs weekday revenue from the borough mart."""
    agg = borough.groupBy("is_weekend").agg(
        F.count_distinct("trip_date").alias("days"),
        F.sum("trip_count").alias("trip_count"),
        F.sum("total_revenue").try_cast(DecimalTypeWide).alias("total_revenue"))
    rev = F.col("total_revenue").cast("double")
    return agg.select(
        "is_weekend", "days", "trip_count", "total_revenue",
        F.try_divide(rev, F.col("trip_count").cast("double")).alias("revenue_per_trip"),
        F.try_divide(rev, F.col("days").cast("double")).alias("revenue_per_day"))


def service_match_rate(service: DataFrame) -> DataFrame:
    """Per day: share of shared / accessible requests that were matched."""
    agg = service.groupBy("trip_date").agg(
        F.sum("trip_count").alias("trip_count"),
        F.sum(F.when(F.col("shared_request_flag"), F.col("trip_count")).otherwise(F.lit(0))).alias("shared_requests"),
        F.sum("shared_matched_count").alias("shared_matched"),
        F.sum(F.when(F.col("wav_request_flag"), F.col("trip_count")).otherwise(F.lit(0))).alias("wav_requests"),
        F.sum("wav_matched_count").alias("wav_matched"))
    return agg.select(
        "trip_date", "trip_count", "shared_requests", "shared_matched", "wav_requests", "wav_matched",
        F.try_divide(F.col("shared_matched").cast("double"), F.col("shared_requests").cast("double"))
        .alias("shared_match_rate"),
        F.try_divide(F.col("wav_matched").cast("double"), F.col("wav_requests").cast("double"))
        .alias("wav_match_rate"))

