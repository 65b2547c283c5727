"""Exact deduplication with keyed streaming state (operator 3, native).

Method: a stream of (digest, stable identifier, content locator) rows runs
through a streaming aggregation whose state is keyed by the digest, kept in
the RocksDB state store (on disk, snapshots in the shared checkpoint folder)
and never expires: there is no watermark. For each digest the state holds the
smallest identifier, the locator of its text, the number of rows and the
smallest and largest byte length. A digest that was hit more than once is then
checked on its full bytes: within one digest the smallest and the largest
normalised text must be the same string. Digests that fail are regrouped by
the text itself, so a digest collision can never merge two texts.

Only DataFrame, SQL and Structured Streaming functions are used: no Python
functions, pandas, Arrow or RDD code.

Scale. The stream carries 32-byte digests and ids, not texts. The aggregation
combines before the shuffle, so a text that makes up a third of all rows costs
one row per task. The full-byte check moves only texts whose digest repeats,
and combines before its shuffle, too.

Cases. Null text counts as empty; all empty texts form one group. Rows that
repeat (same id, same text) are counted in ``group_size``; the output has one
row per input row, and every repeat of the id that stays is ``kept``. Null ids
sort after all others: a group whose ids are all null keeps null. Columns of the input beyond
id and text are not read. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripspark.llm.common import counted_broadcast, materialize
from tripspark.session import new_scratch_dir, path_exists

STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # All instances of an executor share one bounded cache.
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "200",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Files of a small instance aren't given their full length in advance.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    # The state before the only batch of a run is never read again.
    "spark.sql.streaming.minBatchesToRetain": "2",
}


def normalised(text: Column) -> Column:
    """Each run of white space (space, tab to carriage return) as one space; null as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def digest_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, digest, locator) of each row. The locator says where the text
    lies: its normalised length in bytes, with the identifier, is enough to
    fetch it from ``docs`` again."""
    text = normalised(F.col(text_col))
    return docs.select(F.col(id_col).alias("doc_id"), text.alias("norm")).select(
        "doc_id", F.unhex(F.sha2(F.col("norm").cast("binary"), 256)).alias("digest"),
        F.octet_length("norm").cast("long").alias("n_bytes"))


def _less(*columns: str) -> Column:
    """Sort key in which nulls come last."""
    return F.struct(*[x for c in columns for x in (F.col(c).isNull().alias(f"{c}_null"), F.col(c))])


def stream_state(rows: DataFrame, checkpoint: str) -> DataFrame:
    """Run a stream of ``digest_rows`` through the keyed state; returns the state.

    ``rows`` is a streaming DataFrame. Run again with the same checkpoint after
    more input has arrived, the earlier state is taken up and only groups that
    changed are emitted; the newest row of a digest holds. Every micro-batch
    writes the groups that it changed to ``checkpoint/changes/batch=N``; a
    batch that is repeated after a failure overwrites its own folder.
    """
    spark = rows.sparkSession
    state = rows.groupBy("digest").agg(
        F.min(_less("doc_id", "n_bytes")).alias("first"), F.count(F.lit(1)).alias("group_size"),
        F.min("n_bytes").alias("min_bytes"), F.max("n_bytes").alias("max_bytes"))
    changes = f"{checkpoint}/changes"

    def write(batch: DataFrame, number: int) -> None:
        batch.select("digest", F.col("first.doc_id").alias("keep_id"), F.col("first.n_bytes").alias("n_bytes"),
                     "group_size", "min_bytes", "max_bytes").write.mode("overwrite").parquet(f"{changes}/batch={number}")

    before = {k: spark.conf.get(k, None) for k in STATE_SETTINGS}
    for k, v in STATE_SETTINGS.items():
        spark.conf.set(k, v)
    try:
        query = (state.writeStream.outputMode("update").foreachBatch(write)
                 .option("checkpointLocation", f"{checkpoint}/stream").trigger(availableNow=True).start())
        query.awaitTermination()
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    table = _read_changes(spark, changes)
    # Later batches replace what earlier ones said of a digest.
    last = table.groupBy("digest").agg(F.max_by(
        F.struct("keep_id", "n_bytes", "group_size", "min_bytes", "max_bytes"), "batch").alias("s"))
    return last.select("digest", "s.*")


def _read_changes(spark: SparkSession, changes: str) -> DataFrame:
    schema = ("digest binary, keep_id bigint, n_bytes bigint, group_size bigint, min_bytes bigint, "
              "max_bytes bigint, batch int")
    if not path_exists(spark, changes):  # no micro-batch has run: there was no input file
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(changes)


def stateful_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, digest (binary sha256)."""
    spark = docs.sparkSession
    folder = new_scratch_dir(spark, "dedup")
    slim = digest_rows(docs, id_col, text_col)
    slim.write.parquet(f"{folder}/digests")
    slim = spark.read.schema(slim.schema).parquet(f"{folder}/digests")
    stream = spark.readStream.schema(slim.schema).parquet(f"{folder}/digests")
    # Written first, so that the join below has a plain shuffle on either side and
    # Spark can split the rows of a digest that a large group shares.
    state = materialize(stream_state(stream, f"{folder}/state"), "dedup-state")
    groups = slim.join(state.select("digest", "keep_id", "group_size"), "digest")
    groups = materialize(groups.select("doc_id", "keep_id", "group_size", "digest"), "dedup-groups")
    texts = _hit_texts(docs, groups, id_col, text_col)
    differ = texts.groupBy("digest").agg(F.min("norm").alias("lo"), F.max("norm").alias("hi")).filter("lo <> hi")
    differ = materialize(differ.select("digest"), "dedup-collisions")
    if not differ.isEmpty():
        groups = groups.join(differ, "digest", "left_anti").unionByName(_by_text(texts.join(differ, "digest")))
    return groups.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                         "digest")


def _hit_texts(docs: DataFrame, groups: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, digest, norm) of the rows whose digest was hit more than once."""
    hits = groups.filter("group_size > 1").select(F.col("doc_id").alias("hit_id")).distinct()
    hits = counted_broadcast(materialize(hits, "dedup-hits"))
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    texts = texts.join(hits, F.col("doc_id").eqNullSafe(F.col("hit_id")), "left_semi")
    return texts.select("doc_id", normalised(F.col("text")).alias("norm")).select(
        "doc_id", "norm", F.unhex(F.sha2(F.col("norm").cast("binary"), 256)).alias("digest"))


def _by_text(texts: DataFrame) -> DataFrame:
    """Groups of rows under colliding digests, by the full text."""
    by_text = texts.groupBy("digest", "norm").agg(F.min(_less("doc_id")).alias("first"),
                                                  F.count(F.lit(1)).alias("group_size"))
    by_text = by_text.select("digest", "norm", F.col("first.doc_id").alias("keep_id"), "group_size")
    return texts.join(by_text, ["digest", "norm"]).select("doc_id", "keep_id", "group_size", "digest")


def dedup_documents(docs: DataFrame) -> DataFrame:
    """The rows that stay, one of each group of equal texts, with all their columns.

    The smallest id stays; of rows that repeat this id and text, one stays."""
    rows = materialize(stateful_dedup(docs), "dedup-rows")
    gone = rows.filter(~F.col("kept")).select(F.col("doc_id").alias("__id"), F.col("digest").alias("__gone")).distinct()
    gone = counted_broadcast(materialize(gone, "dedup-gone"))
    marked = docs.withColumn("__digest", F.unhex(F.sha2(normalised(F.col("text")).cast("binary"), 256)))
    kept = marked.join(gone, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__digest") == F.col("__gone")),
                       "left_anti")
    if not rows.filter("kept").groupBy("doc_id", "digest").count().filter("count > 1").isEmpty():
        kept = kept.dropDuplicates(["doc_id", "__digest"])
    return kept.drop("__digest")
