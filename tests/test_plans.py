"""Plan tests: no Python UDFs, broadcast dimension joins, hash
aggregation for the zone mart, pushed filters and pruned partitions."""

from __future__ import annotations

import pytest

from tripspark.plans import inspect, registry

QUERIES = registry.queries()


WRITES_WHILE_BUILT = ("_roundtrip", "incremental_", "catalog_", "pipeline_", "has_rows")


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not any(w in n for w in WRITES_WHILE_BUILT)))
def test_no_python_udf_and_no_cartesian(spark, sf_small, name):
    df = QUERIES[name](spark, sf_small)
    assert not inspect.has_python_udf(df)
    assert "CartesianProduct" not in inspect.join_strategies(df)
    assert "BroadcastNestedLoopJoin" not in inspect.join_strategies(df)


def test_enrich_broadcasts_zones(spark, sf_small):
    df = registry.enriched(spark, sf_small)
    joins = inspect.join_strategies(df)
    assert joins.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in joins


def test_enrich_falls_back_when_zone_table_exceeds_limit(spark, sf_small):
    from tripspark.operators.enrich import enrich

    z, _ = registry.zones(spark, sf_small)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        df = enrich(registry.valid(spark, sf_small), z, zone_rows=10, broadcast_limit=5)
        assert "BroadcastHashJoin" not in inspect.join_strategies(df)
        assert df.count() == registry.valid(spark, sf_small).count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", ["daily_service", "service_ordered", "service_match_rate"])
def test_service_queries_join_nothing(spark, sf_small, name):
    df = QUERIES[name](spark, sf_small)
    assert inspect.join_strategies(df) == [] and inspect.plan_text(df).count("Scan parquet") <= 2


def test_borough_mart_names_groups_not_trips(spark, sf_small):
    plan = inspect.executed_plan(registry.borough(spark, sf_small))
    # the tree prints top-down: the trips' own aggregate lies below both joins
    assert plan.count("BroadcastHashJoin") == 2 and plan.rindex("BroadcastHashJoin") < plan.rindex("partial_sum")
    assert "SortAggregate" not in inspect.aggregate_strategies(registry.borough(spark, sf_small))


def test_size_report_reads_only_the_written_pre_aggregate(spark, sf_small):
    plan = inspect.executed_plan(registry.compression_report_q(spark, sf_small))
    assert "/raw" not in plan and "fixture" not in plan.replace("zones_csv", "").split("cube-")[0]


@pytest.mark.parametrize("name", ["latest_period", "period_sequence", "missing_periods", "periods"])
def test_months_come_from_a_listing(spark, sf_small, name):
    assert "FileScan" not in inspect.executed_plan(QUERIES[name](spark, sf_small))


def test_zone_mart_is_hash_aggregated_before_names(spark, sf_small):
    df = registry.zone_mart(spark, sf_small)
    aggs = inspect.aggregate_strategies(df)
    assert "SortAggregate" not in aggs and aggs.count("HashAggregate") >= 2


def test_validation_pushes_filters_to_scan(spark, sf_small):
    pushed = " ".join(inspect.pushed_filters(registry.valid(spark, sf_small)))
    assert "IsNotNull(pickup_datetime)" in pushed
    assert "In(hvfhs_license_num" in pushed


def test_month_read_prunes_partitions(spark, sf_small):
    df = QUERIES["raw_scan_month"](spark, sf_small)
    pf = " ".join(inspect.partition_filters(df))
    assert "year" in pf and "month" in pf


def test_projection_prunes_columns(spark, sf_small):
    from tripspark.operators.curate import preview

    text = inspect.plan_text(preview(registry.valid(spark, sf_small)))
    read = text[text.index("ReadSchema"):].split("\n")[0]
    assert "driver_pay" not in read and "dispatching_base_num" not in read and "on_scene_datetime" not in read


def test_one_scan_splits_valid_and_rejected_rows(spark, sf_small):
    """C1 with a quarantine scans raw once and computes the rules once; the write deals rows by outcome."""
    from tripspark.operators.quality import split_outcomes

    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    try:
        plan = inspect.executed_plan(split_outcomes(registry.curated(spark, sf_small)).hint("rebalance", "outcome", "year"))
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")
    assert plan.count("FileScan") == 1 and plan.count("concat_ws") == 1
