"""Mixing sources to target weights by a splitting tree (operator 6).

Method. The documents of every source are hashed into blocks, and a source's
target is turned into an exact number of blocks: whole passes over all of them
and, for the rest, the first blocks of a random order, the last of which is cut
between two documents. A binary tree splits the vector of block quotas among the
output shards: at each node the left half's share of every source is drawn from
the multivariate hypergeometric distribution, so that the leaves add up to the
quotas exactly. A leaf also knows how many blocks of each source lie to its
left, hence the positions it owns in the source's permuted order of blocks:
shards draw disjoint blocks without talking to one another. Rows are shuffled
within their shard by a hash.

Targets. Size is the number of words. Sources in code point order, null last,
have the weights 3, 1, 2 in turn and share 1.5 times the size of all documents;
no target exceeds twice its source's size, and what is above goes to the others
by weight until none is above.

Scale. One pass sums words by (source, hash bin): at most BINS rows a source,
however many documents it has. All planning works on that table; the draws of a
node are recomputed from its own seed, so every leaf is planned on its own. The
list of sources (at most MAX_SOURCES, checked) is the only thing that the driver
sees. Documents meet their block's draws in one join on (source, bin), whose
keys split a hot source into BINS parts.

Cases. Null text has size 0; a null source is a source of its own. Repeated
rows are separate documents. Documents of size 0 are taken with their block and
add nothing. A source of size 0 has the target 0. An empty table gives an empty
result. Reruns agree, also after lost executors: every choice is a function of
the rows and SEED.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripspark.llm.common import counted_broadcast, materialize, python_stages

SEED = 20
#: Blocks a source is cut into.
BINS = 4096
#: Words an output shard should hold; there are at most MAX_SHARDS.
SHARD_WORDS = 5_000_000
MAX_SHARDS = 16_384
MAX_SOURCES = 100_000

WEIGHTS = (3, 1, 2)
#: The mix's size over that of all documents, and the most a document may be repeated.
SHARE, REPEATS = 1.5, 2

WORD = r"[^\x20\x09-\x0D]+"
_COLUMNS = ("__size", "__bin", "__order")


def _sized(docs: DataFrame) -> DataFrame:
    return docs.withColumns({
        "__size": F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long"),
        "__bin": F.pmod(F.xxhash64(F.lit(SEED), "doc_id", "text"), F.lit(BINS)).cast("int"),
        "__order": F.xxhash64(F.lit(SEED + 1), "doc_id", "text")})


def source_targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size) with number (in code point order), weight and target added."""
    n = Window.orderBy(F.col("source").asc_nulls_last())
    weights = F.array(*[F.lit(float(w)) for w in WEIGHTS])
    numbered = (sizes.withColumn("number", F.row_number().over(n) - 1)
                .withColumn("weight", weights[F.col("number") % len(WEIGHTS)])
                .withColumn("most", (F.col("source_size") * REPEATS).cast("double"))
                .withColumn("ratio", F.col("most") / F.col("weight")))
    every = Window.partitionBy()
    before = Window.orderBy("ratio", "number").rowsBetween(Window.unboundedPreceding, -1)
    level = ((F.sum("source_size").over(every) * SHARE - F.coalesce(F.sum("most").over(before), F.lit(0.0)))
             / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    # Sources whose limit is below the level at their turn are full; the first other one sets the level of all others.
    levels = numbered.withColumn("level", level).withColumn(
        "level", F.min(F.when(F.col("ratio") > F.col("level"), F.struct("ratio", "number", "level"))).over(every)["level"])
    return levels.select("source", "source_size", "number", "weight",
                         F.least("most", F.coalesce(F.col("weight") * F.col("level"), "most")).alias("target"))


def _draw(quotas: np.ndarray, level: int, index: int) -> np.ndarray:
    """Blocks of each source that go to the left half of the tree node (level, index)."""
    random = np.random.Generator(np.random.PCG64([SEED, level, index]))
    total = int(quotas.sum())
    left = total // 2 + (int(random.integers(2)) if total % 2 else 0)
    return random.multivariate_hypergeometric(quotas, left, method="marginals")


def leaf(quotas: np.ndarray, depth: int, shard: int) -> tuple[np.ndarray, np.ndarray]:
    """(blocks of each source in a shard, blocks in the shards before it): the walk from the root to one leaf."""
    mine, before = quotas.copy(), np.zeros_like(quotas)
    for level in range(depth):
        left = _draw(mine, level, shard >> (depth - level))
        if shard >> (depth - level - 1) & 1:
            before, mine = before + left, mine - left
        else:
            mine = left
    return mine, before


def _leaves(quotas: list[int], depth: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vector = np.array(quotas, dtype=np.int64)
        for frame in frames:
            for shard in frame["id"]:
                mine, before = leaf(vector, depth, int(shard))
                own = np.flatnonzero(mine)
                yield pd.DataFrame({"shard": int(shard), "number": own, "first": before[own] + 1,
                                    "last": before[own] + mine[own]})
    return run


def plan(sizes_by_bin: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Targets by source, and the draws: (number, bin, epoch, shard, cut) with one row for each drawn block.

    ``cut`` is null for a whole block, else the words to take of it."""
    spark = sizes_by_bin.sparkSession
    targets = source_targets(sizes_by_bin.groupBy("source").agg(F.sum("words").alias("source_size")))
    targets = materialize(targets, "mix-targets")
    blocks = sizes_by_bin.join(F.broadcast(targets), sizes_by_bin["source"].eqNullSafe(targets["source"])).select(
        "number", "bin", "words", "source_size", "target")
    epochs = blocks.select("*", F.explode(F.sequence(F.lit(0), F.lit(REPEATS - 1))).alias("epoch"))
    rest = F.col("target") - F.col("epoch") * F.col("source_size")
    turn = Window.partitionBy("number", "epoch").orderBy(F.xxhash64(F.lit(SEED + 2), "bin"), "bin")
    before = F.coalesce(F.sum("words").over(turn.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    drawn = (epochs.withColumn("rest", rest - before).filter((F.col("rest") > 0) & (F.col("words") > 0)
                                                             | (rest >= F.col("source_size")))
             .withColumn("cut", F.when(F.col("rest") < F.col("words"), F.col("rest")))
             .withColumn("position", F.row_number().over(
                 Window.partitionBy("number").orderBy(F.xxhash64(F.lit(SEED + 3), "bin", "epoch"), "bin", "epoch"))))
    drawn = materialize(drawn.select("number", "bin", "epoch", "cut", "position"), "mix-drawn")
    quotas = {r["number"]: r["n"] for r in drawn.groupBy("number").agg(F.count(F.lit(1)).alias("n"))
              .limit(MAX_SOURCES + 1).collect()}
    if len(quotas) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    vector = [quotas.get(i, 0) for i in range(max(quotas, default=-1) + 1)]
    total = targets.agg(F.sum("target")).first()[0] or 0.0
    depth = min(int(math.log2(MAX_SHARDS)), max(0, math.ceil(math.log2(max(1.0, total / SHARD_WORDS)))))
    leaves = spark.range(1 << depth).mapInPandas(_leaves(vector, depth), "shard int, number int, first long, last long")
    owned = leaves.select("shard", "number", F.explode(F.sequence(F.col("first").cast("int"), F.col("last").cast("int")))
                          .alias("position"))
    return targets, materialize(drawn.join(owned, ["number", "position"]).drop("position"), "mix-draws")


def assign(docs: DataFrame) -> DataFrame:
    """Every input row with size, source_size, target and draws added.

    ``draws`` lists (epoch, shard, key) once for each time that the mix takes the row; key orders a shard's rows."""
    python_stages(docs.sparkSession)
    names = docs.columns
    sized = _sized(docs)
    by_bin = sized.groupBy("source", F.col("__bin").alias("bin")).agg(F.sum("__size").alias("words"))
    targets, draws = plan(materialize(by_bin, "mix-bins"))
    by_block = (draws.groupBy("number", "bin").agg(F.collect_list(F.struct("epoch", "shard", "cut")).alias("__draws"),
                                                   F.max(F.col("cut").isNotNull()).alias("__cut")))
    source = F.broadcast(targets.select(F.col("source").alias("__source"), "source_size", "number", "target"))
    of = counted_broadcast(materialize(by_block, "mix-blocks").toDF("number", "__bin", "__draws", "__cut"))
    rows = (sized.join(source, F.col("source").eqNullSafe(F.col("__source")))
            .join(of, ["number", "__bin"], "left"))
    whole = rows.filter(~F.coalesce("__cut", F.lit(False))).withColumn("__end", F.lit(None).cast("double"))
    inside = Window.partitionBy("number", "__bin").orderBy("__order", "__size").rowsBetween(Window.unboundedPreceding, 0)
    part = rows.filter(F.coalesce("__cut", F.lit(False))).withColumn(
        "__end", (F.sum("__size").over(inside) - F.col("__size") / 2).cast("double"))
    taken = F.filter("__draws", lambda d: d["cut"].isNull() | (F.col("__end") <= d["cut"]))
    draws_ = F.transform(F.coalesce(taken, F.array()), lambda d: F.struct(
        d["epoch"].alias("epoch"), d["shard"].alias("shard"),
        F.xxhash64(F.lit(SEED + 4), "__order", d["epoch"]).alias("key")))
    return whole.unionByName(part).select(*[F.col(n) for n in names if n not in ("source_size", "target", "size", "draws")],
                                          F.col("__size").alias("size"), "source_size", "target", draws_.alias("draws"))


def mix(docs: DataFrame) -> DataFrame:
    """The mix: the input's columns, each row as often as it is drawn, by shard and shuffled within it."""
    names = docs.columns
    safe = docs.select(*[F.col(n).alias(n if n in ("doc_id", "text", "source") else f"__c{i}")
                         for i, n in enumerate(names)])
    rows = assign(safe).select(*safe.columns, F.explode("draws").alias("__draw"))
    rows = rows.select("*", F.col("__draw.shard").alias("__shard"), F.col("__draw.key").alias("__key"))
    placed = rows.repartition("__shard").sortWithinPartitions("__shard", "__key")
    return placed.select(*[F.col(s).alias(n) for s, n in zip(safe.columns, names, strict=True)])
