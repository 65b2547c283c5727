"""Validation and data-quality reports.

Every report is a single aggregate job over the input: a global ``agg`` with
partial aggregation in each task, so only one small row per task is shuffled,
however skewed the data is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tripspark.functions.trip_expr import MAX_BASE_FARE, MAX_TRIP_MILES, VALID_LICENSES


def validation_rules() -> dict[str, Column]:
    """The nine rule groups of the curated layer, by name.

    A row is valid only if every predicate is TRUE; a NULL result (e.g. a NULL
    request time in ``pickup_after_request``) rejects the row.
    """
    c = F.col
    return {
        "pickup_not_null": c("pickup_datetime").isNotNull(),
        "dropoff_not_null": c("dropoff_datetime").isNotNull(),
        "pu_location_not_null": c("PULocationID").isNotNull(),
        "do_location_not_null": c("DOLocationID").isNotNull(),
        "trip_miles_in_range": (c("trip_miles") >= 0) & (c("trip_miles") <= MAX_TRIP_MILES),
        "base_fare_in_range": (c("base_passenger_fare") >= 0) & (c("base_passenger_fare") <= MAX_BASE_FARE),
        "dropoff_after_pickup": c("dropoff_datetime") > c("pickup_datetime"),
        "pickup_after_request": c("pickup_datetime") >= c("request_datetime"),
        "known_license": c("hvfhs_license_num").isin(VALID_LICENSES),
    }


def is_valid() -> Column:
    """Conjunction of all rules (three-valued: NULL counts as not valid)."""
    rules = list(validation_rules().values())
    out = rules[0]
    for r in rules[1:]:
        out = out & r
    return out


def validate(curated: DataFrame, observation: Observation | None = None) -> DataFrame:
    """keep rows passing every rule.

    With ``observation`` the initial/valid counts are collected as a side
    effect of the job that consumes the result (no extra scan).
    """
    if observation is not None:
        curated = curated.observe(
            observation,
            F.count(F.lit(1)).alias("initial_count"),
            F.count_if(F.coalesce(is_valid(), F.lit(False))).alias("valid_count"))
    return curated.filter(is_valid())


def validation_metrics(curated: DataFrame) -> DataFrame:
    """initial, valid and rejected counts and rejection rate in percent.

    One pass; the rate is NULL on empty input (the reference divides by zero).
    """
    agg = curated.agg(
        F.count(F.lit(1)).alias("initial_count"),
        F.count_if(F.coalesce(is_valid(), F.lit(False))).alias("valid_count"))
    rejected = F.col("initial_count") - F.col("valid_count")
    return agg.select(
        "initial_count", "valid_count", rejected.alias("rejected_count"),
        (F.try_divide(rejected.cast("double"), F.col("initial_count").cast("double"))
         * F.lit(100.0)).alias("rejection_rate_pct"))


def rejected(curated: DataFrame) -> DataFrame:
    """rows that fail validation, with ``failed_rules`` listing every rule
    they broke (comma-separated, in rule order) — for logging or quarantine."""
    names = [F.when(~F.coalesce(p, F.lit(False)), F.lit(n)) for n, p in validation_rules().items()]
    return (curated.filter(~F.coalesce(is_valid(), F.lit(False)))
            .withColumn("failed_rules", F.concat_ws(",", *names)))


OUTCOME, VALID, REJECTED = "outcome", "valid", "rejected"


def split_outcomes(curated: DataFrame) -> DataFrame:
    """F1 and F3 in one pass: every row with ``failed_rules`` (NULL if none) and its ``outcome``,
    by which one write sends valid and rejected rows to folders of their own."""
    names = [F.when(~F.coalesce(p, F.lit(False)), F.lit(n)) for n, p in validation_rules().items()]
    told = curated.withColumn("failed_rules", F.nullif(F.concat_ws(",", *names), F.lit("")))
    return told.withColumn(OUTCOME, F.when(F.col("failed_rules").isNull(), VALID).otherwise(REJECTED))


def outcome_metrics(outcomes: DataFrame) -> DataFrame:
    """F2 and F3 of rows that were split: initial, valid and rejected counts, and how many rows
    failed each rule (a map; a row may fail several). One row."""
    fails = [F.count_if(F.array_contains(F.split("failed_rules", ","), name)).alias(name) for name in validation_rules()]
    agg = outcomes.agg(F.count(F.lit(1)).alias("initial_count"), F.count_if(F.col(OUTCOME) == VALID).alias("valid_count"), *fails)
    return agg.select("initial_count", "valid_count", (F.col("initial_count") - F.col("valid_count")).alias("rejected_count"),
                      F.create_map(*[x for name in validation_rules() for x in (F.lit(name), F.col(name))]).alias("rejects"))


def rejects_by_rule(curated: DataFrame) -> DataFrame:
    """for each rule, how many rows fail it (a row may fail several),
    plus the number of rejected rows overall (``rule = 'any'``).

    One global aggregate of conditional counts, then unpivoted to rows.
    """
    rules = validation_rules()
    fails = [F.count_if(~F.coalesce(p, F.lit(False))).alias(name) for name, p in rules.items()]
    fails.append(F.count_if(~F.coalesce(is_valid(), F.lit(False))).alias("any"))
    wide = curated.agg(*fails)
    names = list(rules) + ["any"]
    return wide.unpivot([], names, "rule", "failed_count").select(
        "rule", F.col("failed_count").cast("bigint").alias("failed_count"))


def column_profile(df: DataFrame) -> DataFrame:
    """A4: NULL count and percentage for every column, in column order.

    One aggregate job for all columns (the reference ran two per column).
    """
    names = df.columns
    wide = df.agg(F.count(F.lit(1)).alias("__rows"),
                  *[F.count_if(F.col(f"`{n}`").isNull()).alias(f"c{i}") for i, n in enumerate(names)])
    stacked = F.inline(F.array(*[
        F.struct(F.lit(i).alias("ordinal"), F.lit(n).alias("column_name"), F.col(f"c{i}").alias("null_count"))
        for i, n in enumerate(names)]))
    return wide.select("__rows", stacked).select(
        "ordinal", "column_name", F.col("null_count").cast("bigint").alias("null_count"),
        (F.try_divide(F.col("null_count").cast("double"), F.col("__rows").cast("double"))
         * F.lit(100.0)).alias("null_pct"))


def profile_and_overview(df: DataFrame) -> tuple[int, dict[str, int]]:
    """A4 and A6 in one job: (rows, NULL count by column). The result has one number a column."""
    names = df.columns
    r = df.agg(F.count(F.lit(1)), *[F.count_if(F.col(f"`{n}`").isNull()) for n in names]).first()
    return int(r[0]), {n: int(c) for n, c in zip(names, r[1:], strict=True)}


def license_distribution(raw: DataFrame) -> DataFrame:
    """A5: trips per license, most frequent first (ties by license)."""
    return (raw.groupBy("hvfhs_license_num").agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), F.asc_nulls_first("hvfhs_license_num")))


def dataset_overview(df: DataFrame) -> DataFrame:
    """Row and column count."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        "row_count", F.lit(len(df.columns)).alias("column_count"))
