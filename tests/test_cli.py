"""The command-line jobs run end to end on the landed fixture."""

from __future__ import annotations

import json

from tripspark import cli, fixtures
from tripspark.plans import registry
from tripspark.session import new_scratch_dir


def test_batch_jobs_and_landing_marker(spark, sf_small):
    raw, zones = fixtures.raw_path(spark, sf_small), fixtures.zone_csv_path(spark, sf_small)
    out = new_scratch_dir(spark, "cli")
    m = cli.main(["raw-to-curated", "--raw", raw, "--curated", f"{out}/curated"])
    assert m["valid_count"] == registry.valid(spark, sf_small).count()
    c = cli.main(["curated-to-aggregated", "--curated", f"{out}/curated", "--zones", zones, "--out", f"{out}/agg"])
    assert c["daily_borough"] == registry.borough(spark, sf_small).count()
    r = cli.main(["landing", "--raw", raw, "--mode", "current", "--as-of", "2001-06-15",
                  "--marker", f"{out}/marker"])
    doc = json.loads(open(f"{out}/marker/ingestion.done").read())
    assert doc["data_period"] == r["latest"] and doc["job_type"] == "current" and doc["total_files"] >= 1
    h = cli.main(["landing", "--raw", raw, "--mode", "historical", "--as-of", "2001-06-15", "--base-year", "1997",
                  "--marker", f"{out}/marker"])
    doc = json.loads(open(h["marker"]).read())
    assert doc["data_period"] == "1997-01" and doc["data_period_end"] < doc["latest_available_month"] == h["latest"]
    i = cli.main(["incremental", "--raw", raw, "--zones", zones, "--out", f"{out}/inc", "--compact"])
    assert len(i["batches"]) == 1
    assert cli.main(["incremental", "--raw", raw, "--zones", zones, "--out", f"{out}/inc/"])["batches"] == []
