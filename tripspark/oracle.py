"""DuckDB SQL for the correctness gate: the same results as the Spark queries,
computed from the driver's pre-registered tables.

Built from CTEs, one per layer, mirroring FIXTURES.md §4 and SURVEY §2. The
engine differences that matter (SURVEY §5, oracle hazards) are handled here:
``dayofweek`` 0-6, rounding casts to BIGINT (``trunc`` first), ``avg`` of a
decimal being DOUBLE (cast through decimal(14,6)), HUGEINT/BIGINT results of
``sum``/``year`` (cast to Spark's types).
"""

from __future__ import annotations

PROCESSED_AT = "2025-01-01 00:00:00"
MONTH_YEAR, MONTH_MONTH = 1998, 1          # S2 single-month read
AS_OF = "2001-06-15"                       # L2-L4 reference date
HISTORY_BASE_YEAR = 1997                   # L4 base year

RAW = """raw AS (
  SELECT
    CASE WHEN k % 23 = 0 THEN 'HV0009' ELSE concat('HV000', CAST(2 + k % 4 AS VARCHAR)) END AS hvfhs_license_num,
    concat('B', lpad(CAST(l_suppkey AS VARCHAR), 5, '0')) AS dispatching_base_num,
    CASE WHEN k % 3 = 0 THEN NULL ELSE concat('B', lpad(CAST(l_suppkey AS VARCHAR), 5, '0')) END AS originating_base_num,
    CAST(CASE WHEN k % 41 = 0 THEN NULL ELSE req END AS TIMESTAMP) AS request_datetime,
    CAST(CASE WHEN l_returnflag = 'A' THEN req + to_seconds(120) ELSE NULL END AS TIMESTAMP) AS on_scene_datetime,
    CAST(CASE WHEN k % 71 = 0 THEN NULL ELSE pu END AS TIMESTAMP) AS pickup_datetime,
    CAST(CASE WHEN k % 73 = 0 THEN NULL WHEN k % 31 = 0 THEN pu ELSE pu + to_seconds(tt) END AS TIMESTAMP) AS dropoff_datetime,
    CAST(CASE WHEN k % 37 = 0 THEN NULL WHEN k % 43 = 0 THEN 99 ELSE s_nationkey END AS BIGINT) AS PULocationID,
    CAST(CASE WHEN k % 79 = 0 THEN NULL ELSE c_nationkey END AS BIGINT) AS DOLocationID,
    CASE WHEN k % 47 = 0 THEN NULL WHEN k % 53 = 0 THEN 600e0 ELSE l_quantity * 37e0 / 100e0 END AS trip_miles,
    CAST(tt AS BIGINT) AS trip_time,
    CASE WHEN k % 61 = 0 THEN -5e0 WHEN k % 67 = 0 THEN 20000e0 WHEN k % 83 = 0 THEN NULL
         ELSE floor(l_extendedprice) / 100e0 + 0.003e0 END AS base_passenger_fare,
    l_discount * 10e0 + 0.003e0 AS tolls,
    l_tax * 5e0 AS bcf,
    l_tax * 20e0 AS sales_tax,
    CASE WHEN k % 13 = 0 THEN NULL ELSE 2.75e0 END AS congestion_surcharge,
    CASE WHEN l_returnflag = 'R' THEN 2.5e0 ELSE NULL END AS airport_fee,
    l_quantity / 4e0 AS tips,
    floor(l_extendedprice / 1.5e0) / 100e0 AS driver_pay,
    CASE WHEN k % 5 = 0 THEN 'Y' WHEN k % 7 = 0 THEN NULL ELSE 'N' END AS shared_request_flag,
    CASE WHEN k % 10 = 0 THEN 'Y' ELSE 'N' END AS shared_match_flag,
    CASE WHEN k % 17 = 0 THEN 'Y' ELSE ' ' END AS access_a_ride_flag,
    CASE WHEN k % 11 = 0 THEN 'Y' ELSE 'N' END AS wav_request_flag,
    CASE WHEN k % 22 = 0 THEN 'Y' ELSE 'N' END AS wav_match_flag,
    CAST(year(req) AS INTEGER) AS year,
    CAST(month(req) AS INTEGER) AS month
  FROM (
    SELECT *, CASE WHEN k % 29 = 0 THEN req - to_seconds(60) ELSE req + to_seconds(300) END AS pu
    FROM (
      SELECT *,
        CASE WHEN k % 59 = 0 THEN CAST(0 AS BIGINT)
             ELSE CAST(l_quantity * 90 AS BIGINT) + l_suppkey % 60 END AS tt,
        o_orderdate + to_seconds(k * 37 % 86400) AS req
      FROM (
        SELECT l.l_orderkey * 7 + l.l_linenumber AS k, l.l_suppkey, l.l_quantity, l.l_extendedprice,
               l.l_discount, l.l_tax, l.l_returnflag, o.o_orderdate, s.s_nationkey, c.c_nationkey
        FROM lineitem l
        JOIN orders o ON l.l_orderkey = o.o_orderkey
        JOIN supplier s ON l.l_suppkey = s.s_suppkey
        JOIN customer c ON o.o_custkey = c.c_custkey
      ) b1
    ) b2
  ) b3
)"""

RAW_COLUMNS = [
    "hvfhs_license_num", "dispatching_base_num", "originating_base_num", "request_datetime",
    "on_scene_datetime", "pickup_datetime", "dropoff_datetime", "PULocationID", "DOLocationID",
    "trip_miles", "trip_time", "base_passenger_fare", "tolls", "bcf", "sales_tax",
    "congestion_surcharge", "airport_fee", "tips", "driver_pay", "shared_request_flag",
    "shared_match_flag", "access_a_ride_flag", "wav_request_flag", "wav_match_flag", "year", "month",
]


def _z(c: str) -> str:
    return f"coalesce(CAST({c} AS DOUBLE), 0e0)"


def _m(c: str) -> str:
    return f"TRY_CAST({_z(c)} AS DECIMAL(10,2))"


_FARE = (f"{_z('base_passenger_fare')} + {_z('tolls')} + {_z('bcf')} + {_z('sales_tax')} + "
         f"{_z('congestion_surcharge')} + {_z('airport_fee')} + 0e0")

CURATED = f"""curated AS (
  SELECT
    hvfhs_license_num, dispatching_base_num, originating_base_num,
    CAST(request_datetime AS TIMESTAMP) AS request_datetime,
    CAST(on_scene_datetime AS TIMESTAMP) AS on_scene_datetime,
    CAST(pickup_datetime AS TIMESTAMP) AS pickup_datetime,
    CAST(dropoff_datetime AS TIMESTAMP) AS dropoff_datetime,
    TRY_CAST(PULocationID AS INTEGER) AS PULocationID,
    TRY_CAST(DOLocationID AS INTEGER) AS DOLocationID,
    {_m('trip_miles')} AS trip_miles,
    TRY_CAST(trip_time AS INTEGER) AS trip_time_seconds,
    {_m('base_passenger_fare')} AS base_passenger_fare,
    {_m('tolls')} AS tolls,
    {_m('bcf')} AS bcf,
    {_m('sales_tax')} AS sales_tax,
    {_m('congestion_surcharge')} AS congestion_surcharge,
    {_m('airport_fee')} AS airport_fee,
    {_m('tips')} AS tips,
    {_m('driver_pay')} AS driver_pay,
    coalesce(shared_request_flag = 'Y', false) AS shared_request_flag,
    coalesce(shared_match_flag = 'Y', false) AS shared_match_flag,
    coalesce(access_a_ride_flag = 'Y', false) AS access_a_ride_flag,
    coalesce(wav_request_flag = 'Y', false) AS wav_request_flag,
    coalesce(wav_match_flag = 'Y', false) AS wav_match_flag,
    CAST(0 AS DECIMAL(10,2)) AS cbd_congestion_fee,
    CAST(pickup_datetime AS DATE) AS trip_date,
    CAST(hour(pickup_datetime) AS INTEGER) AS pickup_hour,
    coalesce(dayname(pickup_datetime), 'Unknown') AS day_of_week,
    coalesce(dayofweek(pickup_datetime) IN (0, 6), false) AS is_weekend,
    TRY_CAST(trip_time / 60e0 AS DECIMAL(10,2)) AS trip_duration_minutes,
    TRY_CAST({_FARE} AS DECIMAL(10,2)) AS total_fare,
    TRY_CAST({_FARE} + {_z('tips')} AS DECIMAL(10,2)) AS total_amount,
    TRY_CAST(CASE WHEN trip_time > 0 THEN trip_miles / (trip_time / 3600e0) END AS DECIMAL(10,2)) AS avg_speed_mph,
    {_z('airport_fee')} > 0 AS is_airport_trip,
    CAST(year(pickup_datetime) AS INTEGER) AS year,
    CAST(month(pickup_datetime) AS INTEGER) AS month,
    CAST(day(pickup_datetime) AS INTEGER) AS day,
    TIMESTAMP '{PROCESSED_AT}' AS processing_timestamp
  FROM raw
)"""

RULES = {
    "pickup_not_null": "pickup_datetime IS NOT NULL",
    "dropoff_not_null": "dropoff_datetime IS NOT NULL",
    "pu_location_not_null": "PULocationID IS NOT NULL",
    "do_location_not_null": "DOLocationID IS NOT NULL",
    "trip_miles_in_range": "(trip_miles >= 0 AND trip_miles <= 500)",
    "base_fare_in_range": "(base_passenger_fare >= 0 AND base_passenger_fare <= 10000)",
    "dropoff_after_pickup": "dropoff_datetime > pickup_datetime",
    "pickup_after_request": "pickup_datetime >= request_datetime",
    "known_license": "hvfhs_license_num IN ('HV0002', 'HV0003', 'HV0004', 'HV0005')",
}
VALID_PREDICATE = " AND ".join(RULES.values())

VALID = f"valid AS (SELECT * FROM curated WHERE {VALID_PREDICATE})"

ZONES = """zones AS (
  SELECT CAST(n_nationkey AS INTEGER) AS LocationID, r_name AS Borough, n_name AS Zone,
         concat('SZ_', CAST(n_regionkey % 3 AS VARCHAR)) AS service_zone
  FROM nation JOIN region ON n_regionkey = r_regionkey
)"""

ENRICHED = """enriched AS (
  SELECT v.trip_date, v.day_of_week, v.is_weekend, v.PULocationID, v.DOLocationID,
         v.shared_request_flag, v.shared_match_flag, v.wav_request_flag, v.wav_match_flag,
         v.is_airport_trip, v.total_amount, v.trip_miles, v.trip_duration_minutes, v.driver_pay,
         pz.Borough AS pickup_borough, pz.Zone AS pickup_zone, pz.service_zone AS pickup_service_zone,
         dz.Borough AS dropoff_borough, dz.Zone AS dropoff_zone, dz.service_zone AS dropoff_service_zone
  FROM valid v
  LEFT JOIN zones pz ON v.PULocationID = pz.LocationID
  LEFT JOIN zones dz ON v.DOLocationID = dz.LocationID
)"""


def _avg(c: str) -> str:
    return f"CAST(CAST(avg({c}) AS DECIMAL(14,6)) AS DECIMAL(10,2))"


BOROUGH = f"""borough AS (
  SELECT trip_date, day_of_week, is_weekend, pickup_borough, dropoff_borough,
         count(*) AS trip_count,
         CAST(sum(total_amount) AS DECIMAL(12,2)) AS total_revenue,
         CAST(sum(trip_miles) AS DECIMAL(12,2)) AS total_distance,
         CAST(trunc(sum(trip_duration_minutes)) AS BIGINT) AS total_duration,
         {_avg('trip_miles')} AS avg_borough_distance,
         {_avg('trip_duration_minutes')} AS avg_borough_duration,
         CAST(year(trip_date) AS INTEGER) AS year,
         CAST(month(trip_date) AS INTEGER) AS month
  FROM enriched
  GROUP BY trip_date, day_of_week, is_weekend, pickup_borough, dropoff_borough
)"""

ZONE_MART = f"""zone_mart AS (
  SELECT trip_date, PULocationID, DOLocationID, is_airport_trip,
         count(*) AS trip_count,
         CAST(sum(total_amount) AS DECIMAL(12,2)) AS total_revenue,
         {_avg('trip_miles')} AS avg_zone_distance,
         {_avg('trip_duration_minutes')} AS avg_zone_duration,
         {_avg('total_amount')} AS avg_fare_per_trip,
         CAST(sum(driver_pay) AS DECIMAL(12,2)) AS total_driver_pay,
         max(pickup_zone) AS pickup_zone, max(pickup_borough) AS pickup_borough,
         max(pickup_service_zone) AS pickup_service_zone,
         max(dropoff_zone) AS dropoff_zone, max(dropoff_borough) AS dropoff_borough,
         max(dropoff_service_zone) AS dropoff_service_zone,
         CAST(year(trip_date) AS INTEGER) AS year,
         CAST(month(trip_date) AS INTEGER) AS month,
         CAST(day(trip_date) AS INTEGER) AS day
  FROM enriched
  GROUP BY trip_date, PULocationID, DOLocationID, is_airport_trip
)"""

SERVICE = """service AS (
  SELECT trip_date, day_of_week, is_weekend, shared_request_flag, wav_request_flag,
         count(*) AS trip_count,
         CAST(sum(total_amount) AS DECIMAL(12,2)) AS total_revenue,
         CAST(sum(CASE WHEN shared_match_flag THEN 1 ELSE 0 END) AS BIGINT) AS shared_matched_count,
         CAST(sum(CASE WHEN wav_match_flag THEN 1 ELSE 0 END) AS BIGINT) AS wav_matched_count,
         CAST(year(trip_date) AS INTEGER) AS year,
         CAST(month(trip_date) AS INTEGER) AS month
  FROM enriched
  GROUP BY trip_date, day_of_week, is_weekend, shared_request_flag, wav_request_flag
)"""

PERIODS = """periods AS (
  SELECT DISTINCT year, month FROM raw
)"""

LATEST = f"""latest AS (
  SELECT coalesce(
    (SELECT max(struct_pack(y := year, m := month)) FROM periods
      WHERE (year = year(DATE '{AS_OF}') AND month <= month(DATE '{AS_OF}'))
         OR year = year(DATE '{AS_OF}') - 1),
    struct_pack(y := CAST(year(DATE '{AS_OF}') - 1 AS INTEGER), m := 1)) AS p
)"""

_CHAINS = {
    "raw": [RAW],
    "curated": [RAW, CURATED],
    "valid": [RAW, CURATED, VALID],
    "enriched": [RAW, CURATED, VALID, ZONES, ENRICHED],
    "marts": [RAW, CURATED, VALID, ZONES, ENRICHED, BOROUGH, ZONE_MART, SERVICE],
    "landing": [RAW, PERIODS, LATEST],
}


def _with(chain: str, select: str) -> str:
    return "WITH " + ",\n".join(_CHAINS[chain]) + "\n" + select


def _union_counts(rows: list[tuple[str, str]], source: str) -> str:
    parts = [f"SELECT '{name}' AS rule, CAST(count_if(NOT coalesce({pred}, false)) AS BIGINT) AS failed_count "
             f"FROM {source}" for name, pred in rows]
    return "\nUNION ALL\n".join(parts)


def _column_profile() -> str:
    parts = [f"SELECT {i} AS ordinal, '{c}' AS column_name, "
             f"CAST(count_if({c} IS NULL) AS BIGINT) AS null_count, "
             f"CAST(count_if({c} IS NULL) AS DOUBLE) / CAST(count(*) AS DOUBLE) * 100e0 AS null_pct FROM raw"
             for i, c in enumerate(RAW_COLUMNS)]
    return "\nUNION ALL\n".join(parts)


def _hist_filter(strict: bool) -> str:
    ly, lm = "(SELECT p.y FROM latest)", "(SELECT p.m FROM latest)"
    if strict:
        return (f"year = {HISTORY_BASE_YEAR} OR ({ly} > {HISTORY_BASE_YEAR} AND {lm} > 1 "
                f"AND year = {ly} AND month < {lm})")
    return (f"(year > {HISTORY_BASE_YEAR} OR (year = {HISTORY_BASE_YEAR} AND month >= 1)) "
            f"AND (year < {ly} OR (year = {ly} AND month < {lm}))")


def oracle_queries() -> dict[str, str]:
    raw_cols = ", ".join(RAW_COLUMNS)
    q: dict[str, str] = {}
    q["raw_scan"] = _with("raw", f"SELECT {raw_cols} FROM raw")
    q["raw_scan_month"] = _with(
        "raw", f"SELECT {raw_cols} FROM raw WHERE year = {MONTH_YEAR} AND month = {MONTH_MONTH}")
    q["zone_scan"] = "WITH " + ZONES + "\nSELECT * FROM zones"
    q["curate_trips"] = _with("curated", "SELECT * FROM curated")
    q["validate_trips"] = _with("valid", "SELECT * FROM valid")
    q["curated_preview"] = _with("valid", (
        "SELECT trip_date, PULocationID, DOLocationID, total_amount, is_weekend FROM valid "
        "ORDER BY trip_date NULLS FIRST, PULocationID NULLS FIRST, DOLocationID NULLS FIRST, "
        "total_amount NULLS FIRST, is_weekend NULLS FIRST LIMIT 5"))
    q["validation_metrics"] = _with("curated", f"""
SELECT initial_count, valid_count, initial_count - valid_count AS rejected_count,
       CAST(initial_count - valid_count AS DOUBLE) / CAST(initial_count AS DOUBLE) * 100e0 AS rejection_rate_pct
FROM (SELECT count(*) AS initial_count,
             CAST(count_if(coalesce({VALID_PREDICATE}, false)) AS BIGINT) AS valid_count
      FROM curated) m""")
    failed = ", ".join(f"CASE WHEN NOT coalesce({pred}, false) THEN '{name}' END" for name, pred in RULES.items())
    q["rejected_trips"] = _with("curated", f"""
SELECT *, concat_ws(',', {failed}) AS failed_rules
FROM curated WHERE NOT coalesce({VALID_PREDICATE}, false)""")
    q["rejects_by_rule"] = _with("curated", _union_counts(
        list(RULES.items()) + [("any", VALID_PREDICATE)], "curated"))
    q["column_profile"] = _with("raw", _column_profile())
    q["license_distribution"] = _with(
        "raw", 'SELECT hvfhs_license_num, count(*) AS "count" FROM raw GROUP BY hvfhs_license_num')
    q["dataset_overview"] = _with("raw", f"SELECT count(*) AS row_count, {len(RAW_COLUMNS)} AS column_count FROM raw")
    q["enrich_trips"] = _with("enriched", "SELECT * FROM enriched")
    q["daily_borough"] = _with("marts", "SELECT * FROM borough")
    q["daily_zone"] = _with("marts", "SELECT * FROM zone_mart")
    q["daily_service"] = _with("marts", "SELECT * FROM service")
    q["compression_report"] = _with("marts", """
SELECT table_name, row_count,
       CAST(row_count AS DOUBLE) / CAST((SELECT count(*) FROM valid) AS DOUBLE) * 100e0 AS pct_of_curated
FROM (SELECT 'curated' AS table_name, count(*) AS row_count FROM valid
      UNION ALL SELECT 'daily_borough', count(*) FROM borough
      UNION ALL SELECT 'daily_zone', count(*) FROM zone_mart
      UNION ALL SELECT 'daily_service', count(*) FROM service) t""")
    q["top_boroughs"] = _with("marts", """
SELECT * FROM borough
ORDER BY total_revenue DESC NULLS LAST, trip_date NULLS FIRST, day_of_week NULLS FIRST,
         is_weekend NULLS FIRST, pickup_borough NULLS FIRST, dropoff_borough NULLS FIRST
LIMIT 10""")
    q["top_routes"] = _with("marts", """
SELECT * FROM zone_mart
ORDER BY total_revenue DESC NULLS LAST, trip_date NULLS FIRST, PULocationID NULLS FIRST,
         DOLocationID NULLS FIRST, is_airport_trip NULLS FIRST
LIMIT 10""")
    q["service_ordered"] = _with("marts", """
SELECT * FROM service
ORDER BY trip_date NULLS FIRST, shared_request_flag NULLS FIRST, wav_request_flag NULLS FIRST
LIMIT 10""")
    q["weekend_revenue"] = _with("marts", """
SELECT is_weekend, days, trip_count, total_revenue,
       CAST(total_revenue AS DOUBLE) / CAST(trip_count AS DOUBLE) AS revenue_per_trip,
       CAST(total_revenue AS DOUBLE) / CAST(days AS DOUBLE) AS revenue_per_day
FROM (SELECT is_weekend, count(DISTINCT trip_date) AS days, CAST(sum(trip_count) AS BIGINT) AS trip_count,
             CAST(sum(total_revenue) AS DECIMAL(18,2)) AS total_revenue
      FROM borough GROUP BY is_weekend) w""")
    q["service_match_rate"] = _with("marts", """
SELECT trip_date, trip_count, shared_requests, shared_matched, wav_requests, wav_matched,
       CASE WHEN shared_requests = 0 THEN NULL ELSE CAST(shared_matched AS DOUBLE) / CAST(shared_requests AS DOUBLE) END AS shared_match_rate,
       CASE WHEN wav_requests = 0 THEN NULL ELSE CAST(wav_matched AS DOUBLE) / CAST(wav_requests AS DOUBLE) END AS wav_match_rate
FROM (SELECT trip_date, CAST(sum(trip_count) AS BIGINT) AS trip_count,
             CAST(sum(CASE WHEN shared_request_flag THEN trip_count ELSE 0 END) AS BIGINT) AS shared_requests,
             CAST(sum(shared_matched_count) AS BIGINT) AS shared_matched,
             CAST(sum(CASE WHEN wav_request_flag THEN trip_count ELSE 0 END) AS BIGINT) AS wav_requests,
             CAST(sum(wav_matched_count) AS BIGINT) AS wav_matched
      FROM service GROUP BY trip_date) s""")
    cbd = "CASE WHEN year < 1997 OR trip_time % 7 = 0 THEN NULL WHEN trip_time % 3 = 0 THEN 0.753e0 ELSE 1.5e0 END"
    with_fee = RAW.replace("raw AS (", "raw0 AS (", 1) + f",\nraw AS (SELECT *, {cbd} AS cbd_fee FROM raw0)"
    curated_fee = (CURATED.replace("CAST(0 AS DECIMAL(10,2)) AS cbd_congestion_fee", f"{_m('cbd_fee')} AS cbd_congestion_fee")
                   .replace("+ 0e0", f"+ {_z('cbd_fee')}"))
    q["curate_trips_cbd"] = f"WITH {with_fee},\n{curated_fee}\nSELECT * FROM curated"
    n = len(RAW_COLUMNS) - 2
    q["column_profile_files"] = f"WITH {with_fee}\n" + "\nUNION ALL\n".join(
        f"SELECT {i} AS ordinal, '{name}' AS column_name, CAST(count_if({c} IS NULL) AS BIGINT) AS null_count, "
        f"CAST(count_if({c} IS NULL) AS DOUBLE) / CAST(count(*) AS DOUBLE) * 100e0 AS null_pct FROM raw"
        for i, (name, c) in enumerate([*[(c, c) for c in RAW_COLUMNS[:n]], ("cbd_congestion_fee", "cbd_fee"),
                                       *[(c, c) for c in RAW_COLUMNS[n:]]]))
    # Round trips through the partitioned sinks equal the tables themselves.
    q["curated_roundtrip"] = q["validate_trips"]
    q["borough_roundtrip"] = q["daily_borough"]
    q["zone_roundtrip"] = q["daily_zone"]
    q["service_roundtrip"] = q["daily_service"]
    q["catalog_scan"] = q["raw_scan"]
    q["catalog_repair"] = _with("raw", """
SELECT DISTINCT 'year=' || CAST(year AS VARCHAR) || '/month=' || lpad(CAST(month AS VARCHAR), 2, '0') AS partition
FROM raw""")
    # Totals beyond decimal(12,2), from sums in wide decimals.
    wide = [("daily_borough", "trip_date, day_of_week, is_weekend, pickup_borough, dropoff_borough",
             {"total_revenue": "total_amount", "total_distance": "trip_miles"}),
            ("daily_zone", "trip_date, PULocationID, DOLocationID, is_airport_trip",
             {"total_revenue": "total_amount", "total_driver_pay": "driver_pay"}),
            ("daily_service", "trip_date, day_of_week, is_weekend, shared_request_flag, wav_request_flag",
             {"total_revenue": "total_amount"})]
    q["mart_overflows"] = _with("enriched", "\nUNION ALL\n".join(
        f"SELECT '{table}' AS table_name, '{total}' AS total_name, count(*) FILTER (WHERE abs(s) > 9999999999.99) AS overflow_count "
        f"FROM (SELECT sum({column}) AS s FROM enriched GROUP BY {keys}) g"
        for table, keys, totals in wide for total, column in totals.items()))
    # Pipelines.
    q["landed_roundtrip"] = q["raw_scan"]
    q["pipeline_curated"] = q["validate_trips"]
    q["pipeline_rejects"] = q["rejected_trips"]
    q["pipeline_metrics"] = q["validation_metrics"]
    q["pipeline_borough"], q["pipeline_zone"], q["pipeline_service"] = q["daily_borough"], q["daily_zone"], q["daily_service"]
    q["pipeline_counts"] = f"SELECT table_name, row_count FROM ({q['compression_report']}) r"
    # Landing operators.
    q["has_rows"] = _with("raw", """
SELECT CAST(y AS INTEGER) AS year, EXISTS (SELECT 1 FROM raw WHERE year = y) AS has_rows
FROM (SELECT unnest(generate_series(min(year) - 1, max(year) + 1)) AS y FROM raw) s""")
    q["periods"] = _with("landing", """
SELECT CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month, strftime(d, '%Y-%m') AS period
FROM (SELECT unnest(generate_series(hi, hi + to_months(CAST(n - 1 AS INTEGER)), INTERVAL 1 MONTH)) AS d
      FROM (SELECT max(make_date(year, month, 1)) AS hi, count(*) AS n FROM periods) b) s""")
    q["landing_row_counts"] = _with("raw", """
SELECT year, month, printf('%04d-%02d', year, month) AS period, count(*) AS row_count FROM raw GROUP BY year, month""")
    # Two runs: rows up to the middle month (some of its rows come later), then that month and those after it.
    q["landing_ledger"] = "WITH " + RAW + """, m AS (
  SELECT year * 12 + month AS i, CAST(floor((min(year * 12 + month) OVER () + max(year * 12 + month) OVER ()) / 2) AS BIGINT) AS mid,
         trip_time % 4 = 0 AS late FROM raw
)
SELECT 1 AS run, count(DISTINCT i) AS months_landed, CAST(0 AS BIGINT) AS months_skipped, count(DISTINCT i) AS files_landed,
       CAST(0 AS BIGINT) AS duplicate_files_skipped, count(*) AS rows_landed
FROM m WHERE i < mid OR (i = mid AND NOT late)
UNION ALL
SELECT 2, count(DISTINCT i) FILTER (WHERE i >= mid), count(DISTINCT i) FILTER (WHERE i < mid),
       count(DISTINCT (i, i = mid AND NOT late)) FILTER (WHERE i >= mid), count(DISTINCT i) FILTER (WHERE i < mid),
       count(*) FILTER (WHERE i >= mid)
FROM m"""
    q["landing_marker"] = _with("landing", """
SELECT 'historical' AS job_type, min(printf('%04d-%02d', year, month)) AS data_period,
       max(printf('%04d-%02d', year, month)) AS data_period_end, count(*) AS total_rows,
       (SELECT printf('%04d-%02d', p.y, p.m) FROM latest) AS latest_available_month, 2 AS publication_delay_months,
       CAST(count(DISTINCT year * 12 + month) FILTER (WHERE year * 12 + month <
         floor(((SELECT min(year * 12 + month) FROM raw) + (SELECT max(year * 12 + month) FROM raw)) / 2)) AS INTEGER)
         AS duplicate_files_skipped, 'SUCCESS' AS status
FROM raw""")
    q["period_sequence"] = _with("raw", """
SELECT CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month, strftime(d, '%Y-%m') AS period
FROM (SELECT unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS d
      FROM (SELECT min(make_date(year, month, 1)) AS lo, max(make_date(year, month, 1)) AS hi FROM raw) b) s""")
    q["latest_period"] = _with("landing", "SELECT p.y AS year, p.m AS month FROM latest")
    q["current_month_trips"] = _with("landing", f"""
SELECT {raw_cols} FROM raw WHERE year = (SELECT p.y FROM latest) AND month = (SELECT p.m FROM latest)""")
    q["historical_trips"] = _with("landing", f"SELECT {raw_cols} FROM raw WHERE {_hist_filter(False)}")
    q["historical_trips_strict"] = _with("landing", f"SELECT {raw_cols} FROM raw WHERE {_hist_filter(True)}")
    q["missing_periods"] = _with("landing", """
SELECT CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month, strftime(d, '%Y-%m') AS period
FROM (SELECT unnest(generate_series(make_date(CAST(min(year) AS BIGINT), 1, 1),
                                    make_date(CAST(max(year) AS BIGINT) + 1, 12, 1), INTERVAL 1 MONTH)) AS d
      FROM periods) w
WHERE NOT EXISTS (SELECT 1 FROM periods p WHERE p.year = year(w.d) AND p.month = month(w.d))""")
    # Incremental runs must end with the same tables as one batch run.
    q["incremental_curate"] = q["validate_trips"]
    q["incremental_borough"] = q["daily_borough"]
    q["incremental_zone"] = q["daily_zone"]
    q["incremental_service"] = q["daily_service"]
    q["incremental_quarantine"] = q["rejected_trips"]
    q["incremental_metrics"] = q["validation_metrics"]
    q["incremental_rejects"] = q["rejects_by_rule"]
    q["incremental_catalog"] = q["daily_zone"]
    q["incremental_late_mtime"] = q["validate_trips"]
    q["incremental_rebuild"] = q["daily_service"]
    q["incremental_refresh"] = q["daily_borough"]
    return q
