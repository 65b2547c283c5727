"""Landing with a ledger: duplicates are skipped and counted, months are published as a whole."""

from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from tripspark import cli
from tripspark.plans import registry
from tripspark.session import new_scratch_dir
from tripspark.sinks import ledger
from tripspark.sources.readers import read_raw
from tripspark.streaming.incremental import read_increment


def put(raw, folder, name):
    """One source file with the month in its name."""
    work = new_scratch_dir(raw.sparkSession, "put")
    raw.drop("year", "month").coalesce(1).write.parquet(work)
    [part] = [f for f in os.listdir(work) if f.endswith(".parquet")]
    os.makedirs(folder, exist_ok=True)
    os.replace(f"{work}/{part}", f"{folder}/{name}.parquet")


def statuses(entries):
    return {r["file_name"]: r["status"] for r in entries.collect()}


def same(a, b):
    cols = sorted(a.columns)
    a, b = a.select(*cols), b.select(*cols)
    return a.count() == b.count() and a.exceptAll(b).count() == 0


@pytest.fixture
def months(spark, sf_small):
    raw = registry.raw(spark, sf_small).filter((F.col("year") == 1996) & (F.col("month") <= 3))
    return {m: raw.filter(F.col("month") == m) for m in (1, 2, 3)}


def test_files_are_skipped_and_counted(spark, months, capsys):
    root = new_scratch_dir(spark, "landing")
    source, path = f"{root}/source", f"{root}/raw"
    for m in (1, 2):
        put(months[m], source, f"trips_1996-{m:02d}")
    first = ledger.land_files(spark, source, path)
    assert set(statuses(first).values()) == {"landed"} and ledger.duplicate_files_skipped(first) == 0
    assert same(read_raw(spark, path), months[1].union(months[2]))
    files = sorted(os.listdir(f"{path}/year=1996/month=01"))
    # the same month again, a changed one and a new one; a file without a month
    put(months[2].filter("trip_time % 2 = 0"), source, "trips_1996-02")
    put(months[3], source, "trips_1996-03")
    put(months[3], source, "notes")
    second = ledger.land_files(spark, source, path)
    assert statuses(second) == {"trips_1996-01.parquet": "skipped", "trips_1996-02.parquet": "landed",
                                "trips_1996-03.parquet": "landed", "notes.parquet": "without month"}
    assert sorted(os.listdir(f"{path}/year=1996/month=01")) == files  # not even written again
    assert same(read_raw(spark, path), months[1].union(months[2].filter("trip_time % 2 = 0")).union(months[3]))
    # the marker takes the count from the ledger
    cli.main(["--master", "local[4]", "landing", "--raw", path, "--source", source, "--as-of", "1997-01-31",
              "--base-year", "1996", "--marker", f"{root}/marker"])
    with open(f"{root}/marker/ingestion.done") as f:
        assert json.load(f)["duplicate_files_skipped"] == 3
    runs = {r["run"]: r for r in ledger.run_summary(ledger.read_ledger(spark, path)).collect()}
    assert [runs[k]["duplicate_files_skipped"] for k in (1, 2, 3)] == [0, 1, 3]
    assert runs[2]["months_landed"] == 2 and not [n for n in os.listdir(path) if n.startswith("_staging")]


def test_rows_in_another_order_are_the_same_file_and_nulls_count(spark, months):
    root = new_scratch_dir(spark, "landing-digest")
    put(months[1].orderBy("trip_time"), f"{root}/a", "x_1996-01")
    put(months[1].orderBy(F.desc("driver_pay")), f"{root}/b", "x_1996-01")
    put(months[1].withColumns({"airport_fee": F.col("congestion_surcharge"), "congestion_surcharge": F.col("airport_fee")}),
        f"{root}/c", "x_1996-01")
    a, b, c = (ledger.source_files(spark, f"{root}/{n}").first()["digest"] for n in "abc")
    assert a == b != c


def test_a_month_is_published_as_a_whole(spark, months, monkeypatch):
    """A reader in between, and after a break, finds old or new months, never parts; empty files count as landed."""
    root = new_scratch_dir(spark, "landing-whole")
    source, path = f"{root}/source", f"{root}/raw"
    for m in (1, 2):
        put(months[m].filter("trip_time % 2 = 0"), source, f"trips_1996-{m:02d}")
    ledger.land_files(spark, source, path)
    whole = {(m, part): months[m].filter(f"trip_time % 2 = 0 OR {part}").count() for m in (1, 2) for part in ("true", "false")}
    for m in (1, 2):
        put(months[m], source, f"trips_1996-{m:02d}")
    put(months[3].limit(0), source, "trips_1996-03")
    seen, real = [], ledger.publish

    def watched(s, staged, target):
        if "/month=" in target:
            seen.append({r["month"]: r["count"] for r in read_raw(spark, path).groupBy("month").count().collect()})
        if len(seen) == 2:
            raise ConnectionError("broke off")
        real(s, staged, target)

    monkeypatch.setattr(ledger, "publish", watched)
    with pytest.raises(ConnectionError):
        ledger.land_files(spark, source, path)
    for counts in seen:
        assert all(n in (whole[m, "true"], whole[m, "false"]) for m, n in counts.items()) and set(counts) == {1, 2}
    monkeypatch.setattr(ledger, "publish", real)
    assert "skipped" not in statuses(ledger.land_files(spark, source, path)).values()
    assert same(read_raw(spark, path), months[1].union(months[2]))
    assert os.path.isdir(f"{path}/year=1996/month=03")
    assert set(statuses(ledger.land_files(spark, source, path)).values()) == {"skipped"}


def test_a_stream_does_not_see_staging_or_ledger(spark, months):
    root = new_scratch_dir(spark, "landing-stream")
    put(months[1], f"{root}/source", "trips_1996-01")
    ledger.land_files(spark, f"{root}/source", f"{root}/raw")
    os.makedirs(f"{root}/raw/_staging-x/months/year=1996/month=09")
    months[2].drop("year", "month").write.mode("append").parquet(f"{root}/raw/_staging-x/months/year=1996/month=09")
    out = f"{root}/out"
    q = (read_increment(spark, f"{root}/raw").writeStream.format("parquet").option("checkpointLocation", f"{root}/ckpt")
         .trigger(availableNow=True).start(out))
    q.awaitTermination()
    assert spark.read.parquet(out).count() == months[1].count()


def test_names_with_odd_characters(spark, months):
    """Listings and the metadata column spell such names differently; both mean one file."""
    root = new_scratch_dir(spark, "landing-names")
    source = f"{root}/so urce"
    for folder, name in ((source, "x y+z%41 é_1996-01"), (f"{source}/so urce", "x y+z%41 é_1996-02")):
        put(months[int(name[-1])], folder, name)
    entries = {r["file_name"]: r["row_count"] for r in ledger.land_files(spark, source, f"{root}/raw").collect()}
    assert entries == {"x y+z%41 é_1996-01.parquet": months[1].count(), "so urce/x y+z%41 é_1996-02.parquet": months[2].count()}
    assert same(read_raw(spark, f"{root}/raw"), months[1].union(months[2]))
    assert set(statuses(ledger.land_files(spark, source, f"{root}/raw")).values()) == {"skipped"}
