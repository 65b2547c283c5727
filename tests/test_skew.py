"""Hot keys: a day holding a third of all rows is split across writer tasks,
and a hot group key is combined map-side before the shuffle."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from tripspark.plans import inspect
from tripspark.session import new_scratch_dir
from tripspark.sinks.writers import write_partitioned


def hot_frame(spark, n=60_000):
    # a third of the rows on 2024-01-01, the rest spread over 40 days
    i = F.col("id")
    day = F.when(i % 3 == 0, F.lit(1)).otherwise(2 + i % 40)
    return spark.range(n).select(
        F.lit(2024).alias("year"), F.lit(1).alias("month"), ((day - 1) % 28 + 1).alias("day"),
        F.sha2(i.cast("string"), 256).alias("payload"))


def test_hot_day_is_split_across_writer_tasks(spark):
    keys = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k",
            "spark.sql.adaptive.coalescePartitions.enabled": "true"}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        path = new_scratch_dir(spark, "skew")
        write_partitioned(hot_frame(spark), path, ("year", "month", "day"))
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    hot = os.path.join(path, "year=2024", "month=1", "day=1")
    files = [f for f in os.listdir(hot) if f.endswith(".parquet")]
    assert len(files) > 1, files
    assert spark.read.parquet(path).count() == 60_000


def test_hot_group_key_is_combined_before_the_shuffle(spark):
    agg = hot_frame(spark).groupBy("day").agg(F.count(F.lit(1)).alias("n"))
    plan = inspect.executed_plan(agg)
    # the tree prints top-down: final aggregate, then the Exchange, then the
    # partial aggregate that runs in each map task before the shuffle
    assert plan.index("Exchange") < plan.index("partial_count")
    assert agg.filter(F.col("day") == 1).first()["n"] >= 20_000
