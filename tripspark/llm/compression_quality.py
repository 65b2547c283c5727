"""Quality scores from compression with class dictionaries (operator 2).

Method: two zstandard dictionaries are built, one from text labelled good and
one from text labelled bad. Every whole text is cut into blocks and each block
is compressed with either dictionary; the difference of the summed sizes,
divided by the text's length, says which class the text resembles. A logistic
curve fitted on further labelled rows turns the difference into a score.

Bounds. Training uses a sample of labelled rows that does not grow with the
data: per class, ``dictionary_rows`` rows give one block of ``block_bytes``
characters each to the dictionary, and ``calibration_rows`` further rows are
scored on executors over their whole texts, of which the driver gets two
numbers a row. Rows are taken in the order of a hash of their id; of rows that repeat an
id the smallest text counts. Scoring
covers every row and every byte in one narrow pass without a shuffle; the
model (two dictionaries) is a constant size.

Cases. Null and empty texts get the score of a difference of zero. Labels that
are null or contradict one another are not learned from. Without labelled
documents of both classes every text gets the same score, the smoothed share
of label 1. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripspark.llm.common import held_out, python_stages, text_bytes, tidy

#: A document is predicted good from this score on.
THRESHOLD = 0.7


@dataclass(frozen=True)
class Training:
    """Parameters of the fit; the two row counts bound the sample of each class."""
    dictionary_rows: int = 1500
    calibration_rows: int = 2000
    dictionary_bytes: int = 262_144
    block_bytes: int = 4096
    level: int = 3
    #: Added to the length, so that a few bytes of difference in a very short text count for little.
    smoothing: int = 40


@dataclass(frozen=True)
class QualityModel:
    good: bytes
    bad: bytes
    weight: float
    bias: float
    training: Training

    def compressors(self) -> list[zstandard.ZstdCompressor]:
        out = []
        for raw in (self.good, self.bad):
            d = zstandard.ZstdCompressionDict(raw)
            d.precompute_compress(level=self.training.level)
            out.append(zstandard.ZstdCompressor(level=self.training.level, dict_data=d, write_content_size=False,
                                                write_dict_id=False))
        return out

    def difference(self, text: bytes, compressors: list[zstandard.ZstdCompressor]) -> float:
        """(size with the bad dictionary - size with the good one) per byte."""
        good, bad = compressors
        step, gap = self.training.block_bytes, 0
        for at in range(0, len(text), step):
            block = text[at:at + step]
            gap += len(bad.compress(block)) - len(good.compress(block))
        return gap / (len(text) + self.training.smoothing)

    def score(self, difference: float) -> float:
        z = self.weight * difference + self.bias
        return 1 / (1 + math.exp(-z)) if z >= 0 else math.exp(z) / (1 + math.exp(z))


def _differences(model: QualityModel, to_score: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressors = model.compressors()
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("__text"))
            values = [model.difference(t.as_py() or b"", compressors) for t in texts]
            if to_score:
                values = [model.score(v) for v in values]
            rest = [i for i, n in enumerate(batch.schema.names) if n != "__text"]
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in rest] + [pa.array(values, pa.float64())],
                                             names=[batch.schema.names[i] for i in rest] + ["value"])
    return run


def _fit_curve(x: np.ndarray, y: np.ndarray, weights: np.ndarray) -> tuple[float, float]:
    """Weighted logistic regression of y on x by Newton's method, lightly regularised."""
    scale = float(np.std(x)) or 1.0
    design = np.stack([x / scale, np.ones_like(x)], axis=1)
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        slope = design.T @ (weights * (y - p)) - np.array([1e-2, 0.0]) * beta
        curve = (design * (weights * p * (1 - p))[:, None]).T @ design + np.diag([1e-2, 1e-9])
        step = np.linalg.solve(curve, slope)
        beta = beta + step
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0] / scale), float(beta[1])


def fit(docs: DataFrame, labels: DataFrame, training: Training = Training()) -> QualityModel:
    """Train on labelled rows that are not held out. ``labels`` has doc_id and quality (0 or 1)."""
    spark = docs.sparkSession
    python_stages(spark)
    known = (labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("other"))
             .filter("quality = other").select("doc_id", "quality"))
    rows = training.dictionary_rows + training.calibration_rows
    order = (F.xxhash64("doc_id"), F.col("doc_id"))
    sample = None
    for quality in (1, 0):
        part = known.filter(F.col("quality") == quality).orderBy(*order).limit(rows)
        sample = part if sample is None else sample.unionByName(part)
    # At most 2 * rows pairs of numbers: a bound that does not depend on the data.
    picked = sorted((int(r["quality"]), int(r["doc_id"])) for r in sample.collect())
    totals = {int(r["quality"]): r["count"] for r in known.groupBy("quality").count().collect()}
    sample = spark.createDataFrame(picked, "quality int, doc_id bigint")
    # One text for each labelled id, however many rows repeat it: what is collected below stays bounded.
    chosen = (docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
              .groupBy("doc_id", "quality").agg(F.min("text").alias("text")))
    turn = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(rows)) < training.dictionary_rows
    start = 1 + F.pmod(F.xxhash64("doc_id", F.lit(2)),
                       F.greatest(F.lit(1), F.length("text") - training.block_bytes + 1)).cast("int")
    blocks = (chosen.filter(turn & (F.length("text") > 0))
              .select("quality", "doc_id", F.substr(F.col("text"), start, F.lit(training.block_bytes))
                      .cast("binary").alias("block")))
    samples: dict[int, list[bytes]] = {0: [], 1: []}
    for r in sorted(blocks.collect(), key=lambda r: (r["doc_id"], bytes(r["block"]))):
        samples[r["quality"]].append(bytes(r["block"]))
    good, bad = (_dictionary(samples[q], training) for q in (1, 0))
    model = QualityModel(good, bad, 1.0, 0.0, training)
    scored = (chosen.filter(~turn).select("quality", text_bytes(F.col("text")).alias("__text"))
              .mapInArrow(tidy(_differences(model, False)), "quality int, value double"))
    found = scored.collect()
    y = np.array([r["quality"] for r in found], dtype=np.float64)
    if not 0 < y.sum() < len(y):
        share = (totals.get(1, 0) + 1) / (sum(totals.values()) + 2)
        return QualityModel(good, bad, 0.0, math.log(share / (1 - share)), training)
    x = np.array([r["value"] for r in found])
    weights = np.where(y == 1, totals[1] / y.sum(), totals[0] / (len(y) - y.sum()))
    weight, bias = _fit_curve(x, y, weights / weights.mean())
    return QualityModel(good, bad, weight, bias, training)


def _dictionary(blocks: list[bytes], training: Training) -> bytes:
    """A trained dictionary; with too few blocks to train on, their plain concatenation."""
    try:
        return zstandard.train_dictionary(training.dictionary_bytes, blocks, level=training.level).as_bytes()
    except zstandard.ZstdError:
        return b"".join(blocks)[:training.dictionary_bytes] or b"\0" * 8


def score_quality(docs: DataFrame, model: QualityModel, keep: tuple[str, ...] | None = None) -> DataFrame:
    """The columns ``keep`` (default: all) of every row, with ``score`` and ``predicted`` added."""
    python_stages(docs.sparkSession)
    names = list(keep if keep is not None else docs.columns)
    given = docs.select(*[F.col(n).alias(f"c{i}") for i, n in enumerate(names)],
                        text_bytes(F.col("text")).alias("__text"))
    schema = ", ".join([f"c{i} {given.schema[f'c{i}'].dataType.simpleString()}" for i in range(len(names))]
                       + ["value double"])
    out = given.mapInArrow(tidy(_differences(model, True)), schema)
    return out.select(*[F.col(f"c{i}").alias(n) for i, n in enumerate(names)], F.col("value").alias("score"),
                      (F.col("value") >= THRESHOLD).cast("int").alias("predicted"))
