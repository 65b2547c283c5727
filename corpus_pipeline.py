"""From raw documents to token ids in five stages, each of which is written as
Parquet and read again as the next one's documents.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripspark.llm.compression_quality import fit, score_quality
from tripspark.llm.parity_join import one_per_component
from tripspark.llm.registry import tokenizer_path
from tripspark.llm.source_mixing import mix
from tripspark.llm.stateful_dedup import dedup_documents
from tripspark.llm.word_bpe import encode_words
from tripspark.session import new_scratch_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier, fitted on the labels, does not reject."""
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score_quality(docs, model).filter("predicted = 1").select(*docs.columns)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the smallest id."""
    return dedup_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group linked by word shingles, the document with the smallest id."""
    return one_per_component(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources, by shard and shuffled within it; a row appears once for each time it is drawn."""
    return mix(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (little-endian unsigned 32-bit integers) of every drawn document."""
    return encode_words(docs, tokenizer_path(), ("doc_id", "source")).drop("decoded")


STAGES = [("quality", quality), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("mixing", mixing),
          ("encoding", encoding)]

#: The classifier's fit, the mix's draws and the token ids have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_scratch_dir(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
