"""Catalog reads (S5) and partition repair (S6) on the landed fixture."""

from __future__ import annotations

import uuid

from tripspark import fixtures
from tripspark.plans import registry
from tripspark.sources.readers import create_external_raw_table, read_table, repair_partitions


def test_repair_registers_landed_months(spark, sf_small):
    name = f"raw_trips_{uuid.uuid4().hex[:8]}"
    create_external_raw_table(spark, name, fixtures.raw_path(spark, sf_small))
    before = read_table(spark, None, name).count()
    assert repair_partitions(spark, name)
    after = read_table(spark, None, name).count()
    assert after == registry.raw(spark, sf_small).count()
    assert before <= after
    parts = [r["partition"] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()]
    assert parts and all(p.startswith("year=") and "/month=" in p for p in parts)


def test_failed_repair_is_tolerated(spark):
    assert repair_partitions(spark, f"no_such_table_{uuid.uuid4().hex[:8]}") is False


def test_catalog_queries_leave_one_table(spark, sf_small):
    for _ in range(2):
        registry.catalog_scan(spark, sf_small)
        registry.catalog_repair(spark, sf_small)
    path = fixtures.raw_path(spark, sf_small)
    found = [t.name for t in spark.catalog.listTables() if t.name == registry._external_raw_table(spark, sf_small)]
    assert len(found) == 1 and path
