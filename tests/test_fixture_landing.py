"""The trips' landing: what is shuffled, and that rows from month folders are landed without a shuffle."""

from __future__ import annotations

from pyspark.sql import functions as F

from tripspark import fixtures
from tripspark.plans import inspect
from tripspark.schemas import RAW
from tripspark.session import list_files, new_scratch_dir
from tripspark.sinks.writers import land
from tripspark.sources.readers import read_raw


def same(a, b):
    a = a.select(*b.columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_trips_are_made_after_the_rows_are_dealt(spark, sf_small):
    """Base rows are dealt and sorted by month; the trips' columns are only computed above that."""
    text = inspect.executed_plan(fixtures._landed_trips(spark, sf_small))
    above, dealt = text.split("REBALANCE_PARTITIONS_BY_COL", 1)
    assert "trip_miles" in above and "Sort [year" in above
    assert "trip_miles" not in dealt and "sales_tax" not in dealt
    assert same(read_raw(spark, fixtures.raw_path(spark, sf_small)), fixtures.trip_view(spark, sf_small))


def test_rows_of_month_folders_are_landed_without_a_shuffle(spark):
    rows = spark.range(400).select(*[
        (F.lit(2020) + F.col("id") % 2).cast("int").alias("year") if f.name == "year" else
        (1 + F.col("id") % 12).cast("int").alias("month") if f.name == "month" else
        F.col("id").alias("trip_time") if f.name == "trip_time" else F.lit(None).cast(f.dataType).alias(f.name) for f in RAW.fields])
    first, again = new_scratch_dir(spark, "by-month"), new_scratch_dir(spark, "by-month")
    land(rows, first)
    source = read_raw(spark, first)
    spark.sparkContext.setJobGroup("land-again", "land-again")
    land(source, again, mode="append", rebalance=False)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    told = spark.sparkContext.statusTracker()
    assert [len(told.getJobInfo(j).stageIds) for j in told.getJobIdsForGroup("land-again")] == [1]
    assert same(read_raw(spark, again), source)
    months = {ym for ym, _, _ in list_files(spark, again, ("year", "month"))}
    assert months == {(2020, m) for m in range(1, 12, 2)} | {(2021, m) for m in range(2, 13, 2)}
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"


def test_a_batch_of_month_files_is_curated_without_a_shuffle(spark, sf_small, monkeypatch):
    """The rows of a batch are sorted where they are read: what is written has no exchange."""
    from tripspark.streaming import incremental

    seen, real = [], incremental.write_batch
    monkeypatch.setattr(incremental, "write_batch", lambda df, *a: seen.append((df, a)) or real(df, *a))
    pipe = incremental.IncrementalPipeline(spark, new_scratch_dir(spark, "by-month"), fixtures.zone_csv_path(spark, sf_small),
                                           new_scratch_dir(spark, "by-month"), new_scratch_dir(spark, "by-month"))
    raw = read_raw(spark, fixtures.raw_path(spark, sf_small)).filter("year = 1996 AND month < 4")
    land(raw, pipe.raw_path, mode="append", rebalance=False)
    pipe.curate_new()
    [(rows, (*_, rebalance))] = seen
    assert rebalance is False and "Exchange" not in inspect.executed_plan(rows)
    assert incremental.read_trips(spark, pipe.curated_path).count() == raw.count() > 0
