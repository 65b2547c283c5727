"""Helpers shared by the text operators: shared-folder tables, Arrow batches
with a bounded number of rows, byte views of a text column."""

from __future__ import annotations

import ctypes
import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripspark.session import new_scratch_dir

ArrowStage = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]

#: Rows of one Arrow batch handed to Python. Texts may be long, so a batch is
#: kept far below Spark's default of 10,000 rows.
ROWS_PER_BATCH = 512
#: Bytes of such a batch; a longer text is a batch by itself.
BYTES_PER_BATCH = 16 << 20

#: Held out rows: crc32 of the id as text, modulo 4, equal to this.
HELD_OUT_REMAINDER = 2


def python_stages(spark: SparkSession, rows: int = ROWS_PER_BATCH) -> None:
    """Bound the rows and bytes of the Arrow batches that this session's Python stages get,
    and let workers that start from now on find this package where the driver has it.

    The settings stay, as they are read when a stage runs; smaller ones of the session are kept."""
    for name, most in (("maxRecordsPerBatch", rows), ("maxBytesPerBatch", BYTES_PER_BATCH)):
        key = f"spark.sql.execution.arrow.{name}"
        now = spark.conf.get(key).strip().lower().removesuffix("b")
        if not now.isdigit() or not 0 < int(now) <= most:
            spark.conf.set(key, str(most))
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(x for x in (known, root) if x)


def tidy(run: ArrowStage) -> ArrowStage:
    """A Python stage that gives freed memory back to the system when its partition ends: Spark
    reuses its workers, which would otherwise keep what their largest partition took."""
    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            del batches
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
            if trim is not None:
                trim(0)
    return tidied


def materialize(df: DataFrame, kind: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared scratch folder and read it
    back: cuts the lineage in storage that survives a lost executor."""
    spark = df.sparkSession
    path = new_scratch_dir(spark, kind)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def held_out(doc_id: Column) -> Column:
    """crc32(doc_id as text) mod 4 is 2; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == HELD_OUT_REMAINDER


def text_bytes(text: Column) -> Column:
    """The text's UTF-8 bytes, empty for null."""
    return F.coalesce(text, F.lit("")).cast("binary")


def as_text(raw: bytes | None) -> str:
    """UTF-8 bytes as text; bytes that are no UTF-8 become U+FFFD."""
    return "" if raw is None else raw.decode("utf-8", errors="replace")


def byte_view(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a binary Arrow array without nulls, without a copy.

    Row ``i`` is ``bytes[offsets[i]:offsets[i + 1]]``; the first offset is 0.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=kind, count=len(column) + 1, offset=column.offset * kind().itemsize)
    at = at.astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8)[at[0]:at[-1]] if data is not None and at[-1] else np.zeros(0, np.uint8)
    return raw, at - at[0]


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (bijective), element by element, wrapping."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Rows up to which a list of ids or digests (below 100 bytes a row) is broadcast;
#: a longer one goes through a shuffle join.
BROADCAST_ROWS = 100_000


def counted_broadcast(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for a broadcast join if a count proves that it is small.

    ``df`` should be a materialized table: it is counted here and read again by the join."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df
