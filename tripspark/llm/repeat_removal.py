"""Removal of long repeats with run-length indexes (operator 1).

Every byte that lies in a WINDOW-byte string which also begins anywhere else in
the corpus is found; matches stay within documents.

Method. The corpus is dealt into blocks small enough for one task, so that all
places of a repeated string meet in one block: a window is sent where its
minimizer (the smallest hash of the GRAM-byte strings inside, the first of
equals) says, and a window's content alone decides on that. Windows with the
same minimizer are sent together as one segment. A block builds a run-length
index over its segments (``run_length_index``), streams the matching statistics
of all positions from the samples at run ends, and marks windows whose longest
match elsewhere has WINDOW bytes.

Before bytes are moved, hashes are: minimizers that occur once in the corpus
drop out, and where all segments of a minimizer are equal, they are one string of
the index with a count above one, and are marked without building it. Texts that
are equal as a whole count once per task; they are repeats altogether.

Skew. A minimizer inside a common passage has equal segments. At a passage's
edge the segments differ: beyond HOT segments, a minimizer's windows are dealt
again by CORE_STEP offsets and the content that all windows of such an offset
range share, and those beyond HOT of these window by window. So no block depends on how
often a passage occurs, and nothing is capped.

Cases. Null text is empty; texts shorter than WINDOW bytes have no repeats. Rows
that repeat are copies like others. Extra columns are not read. An empty table gives
an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripspark.llm.common import byte_view, materialize, mix64, python_stages, text_bytes
from tripspark.llm.run_length_index import RunLengthIndex

WINDOW, GRAM = 200, 64
#: Minimizer candidates in a window.
SPAN = WINDOW - GRAM + 1
#: Segments of one minimizer that one index takes; offsets dealt together beyond that.
HOT, CORE_STEP = 400, 16
#: Bytes and strings of one index, beyond which no further minimizer joins it.
INDEX_BYTES, INDEX_STRINGS = 1 << 20, 20_000
#: Bytes hashed at a time; a longer text is hashed by itself.
HASH_BYTES = 2 << 20
#: Ranges of bytes up to which the ranges' table (16 bytes each) is broadcast to the texts.
BROADCAST_RANGES = 1_000_000

_CODE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
_STEPS = mix64(np.arange(1, 8, dtype=np.uint64)) | np.uint64(1)
_LOW = np.uint64(0xFFFFFFFF)


def gram_hashes(raw: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes at each position."""
    h = _CODE[raw]
    for k in range(6):
        h = h[:-(1 << k)] * _STEPS[k] + h[1 << k:]
        h ^= h >> np.uint64(29)
    return mix64(h)


def segments(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of windows with the same minimizer: (row, minimizer hash, segment hash,
    first window, number of windows, minimizer's distance from it)."""
    none = np.zeros(0, dtype=np.int64)
    if len(raw) < WINDOW:
        return none, none.astype(np.uint64), none.astype(np.uint64), none, none, none
    grams = gram_hashes(raw)
    low = (grams & ~_LOW) | np.arange(len(grams), dtype=np.uint64)
    step = 1
    while 2 * step <= SPAN:
        low = np.minimum(low[:-step], low[step:])
        step *= 2
    low = np.minimum(low[:len(low) - (SPAN - step)], low[SPAN - step:])
    turn = np.zeros(len(low) + 1, dtype=np.int64)
    lengths = np.diff(offsets)
    full = lengths >= WINDOW
    np.add.at(turn, offsets[:-1][full], 1)
    np.add.at(turn, (offsets[1:] - WINDOW + 1)[full], -1)
    windows = np.flatnonzero(np.cumsum(turn[:-1]) > 0)
    place = (low[windows] & _LOW).astype(np.int64)
    new = np.flatnonzero(np.append(True, place[1:] != place[:-1])) if len(place) else none
    first, last = windows[new], windows[np.append(new[1:], len(windows)) - 1] if len(new) else none
    place = place[new]
    count, distance = last - first + 1, place - first
    content = np.full(len(first), 7, dtype=np.uint64) + (count * 256 + distance).astype(np.uint64)
    end = last + WINDOW - GRAM
    for k in range(-(-(WINDOW + SPAN) // GRAM)):
        content = mix64(content * _STEPS[6] + grams[np.minimum(first + k * GRAM, end)])
    row = np.searchsorted(offsets, first, side="right") - 1
    return row, grams[place], content, first - offsets[row], count, distance


def _pieces(batch_bytes: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of rows of HASH_BYTES or a single longer row."""
    begin = 0
    for i in range(1, len(offsets)):
        if i == len(offsets) - 1 or offsets[i + 1] - offsets[begin] > HASH_BYTES:
            yield begin, i
            begin = i


def _list(ends: np.ndarray, values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(values))


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, mark, text) to (doc_id, mark, row, digest, bytes, segments); equal texts
    of a task have their segments once."""
    row = TaskContext.get().partitionId() << 33
    seen: set[bytes] = set()
    for batch in batches:
        raw, offsets = byte_view(batch.column(2))
        for lo, hi in _pieces(raw, offsets):
            part, at = raw[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
            digests, new = [], np.zeros(hi - lo, dtype=bool)
            for i in range(hi - lo):
                d = hashlib.blake2b(part[at[i]:at[i + 1]], digest_size=16).digest()
                new[i] = d not in seen
                seen.add(d)
                digests.append(d)
            own, gram, content, first, count, distance = segments(part, at)
            use = new[own] if len(own) else np.zeros(0, dtype=bool)
            own, gram, content, first, count, distance = (x[use] for x in (own, gram, content, first, count, distance))
            ends = np.searchsorted(own, np.arange(hi - lo + 1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo),
                 pa.array(np.arange(row, row + hi - lo)), pa.array(digests, pa.binary()), pa.array(np.diff(at)),
                 _list(ends, gram.view(np.int64)), _list(ends, content.view(np.int64)), _list(ends, first),
                 _list(ends, (count * 256 + distance).astype(np.int32))],
                names=["doc_id", "mark", "row", "digest", "n_bytes", "gram", "content", "first", "shape"])
            row += hi - lo


_ANCHORS = ("row bigint, digest binary, n_bytes bigint, gram array<bigint>, content array<bigint>, "
            "first array<bigint>, shape array<int>")


def _hash64(raw: bytes, salt: int) -> int:
    return int.from_bytes(hashlib.blake2b(raw, digest_size=8, salt=salt.to_bytes(8, "little")).digest(), "little", signed=True)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (text, row, wanted segments) to the segments' bytes (key, row, first, count,
    level, bytes); those of hot minimizers as ranges of CORE_STEP offsets."""
    for batch in batches:
        out: list[tuple] = []
        for text, row, wanted in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
            for w in wanted:
                first, count, distance = w["first"], w["shape"] >> 8, w["shape"] & 255
                if not w["hot"]:
                    out.append((w["gram"], row, first, count, 1, text[first:first + count - 1 + WINDOW]))
                    continue
                anchor = first + distance
                for k in range((distance - count + 1) // CORE_STEP, distance // CORE_STEP + 1):
                    lo = max(first, anchor - k * CORE_STEP - CORE_STEP + 1)
                    hi = min(first + count - 1, anchor - k * CORE_STEP)
                    core = text[anchor - k * CORE_STEP:anchor - (k + 1) * CORE_STEP + 1 + WINDOW]
                    out.append((_hash64(core, k), row, lo, hi - lo + 1, 2, text[lo:hi + WINDOW]))
        yield _records(out)


def _single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments (row, first, count, bytes) window by window: (digest, row, first)."""
    for batch in batches:
        digests, rows, firsts = [], [], []
        for row, first, count, raw in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
            digests += [hashlib.blake2b(raw[i:i + WINDOW], digest_size=16).digest() for i in range(count)]
            rows += [row] * count
            firsts += range(first, first + count)
        yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array(rows, pa.int64()),
                                          pa.array(firsts, pa.int64())], names=["window", "row", "first"])


_RECORD = {"key": pa.int64(), "row": pa.int64(), "first": pa.int64(), "count": pa.int32(), "level": pa.int32(),
           "bytes": pa.binary()}
_RECORD_SCHEMA = "key bigint, row bigint, first bigint, count int, level int, bytes binary"


def _records(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(_RECORD)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _RECORD.values(), strict=True)],
                                      names=list(_RECORD))


class _Block:
    """Segments of whole minimizers, until one index has enough."""

    def __init__(self) -> None:
        self.groups: list[dict[bytes, list[tuple[int, int, int]]]] = []
        self.size = self.strings = 0

    def add(self, group: dict[bytes, list[tuple[int, int, int]]]) -> None:
        if len(group) > 1 or any(len(v) > 1 for v in group.values()):
            self.groups.append(group)
            self.size += sum(map(len, group))
            self.strings += len(group)

    def full(self) -> bool:
        return self.size > INDEX_BYTES or self.strings > INDEX_STRINGS

    def ranges(self) -> tuple[list[int], list[int], list[int]]:
        """(row, begin, end) of the byte ranges whose windows are repeats."""
        rows, begins, ends = [], [], []
        strings = [s for g in self.groups for s in g]
        if not strings:
            return rows, begins, ends
        index = RunLengthIndex(strings)
        long = index.matching_statistics() >= WINDOW
        places = [p for g in self.groups for p in g.values()]
        for start, segments_ in zip(index.starts.tolist(), places, strict=True):
            for row, first, count in segments_:
                marked = long[start:start + count] if len(segments_) == 1 else np.ones(count, dtype=bool)
                edges = np.flatnonzero(np.diff(np.concatenate([[0], marked, [0]])))
                for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
                    rows.append(row)
                    begins.append(first + a)
                    ends.append(first + b - 1 + WINDOW)
        return rows, begins, ends


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ranges (row, begin, end) of segments (key, row, first, count, bytes) that arrive by key."""
    block, key, group = _Block(), None, {}

    def packed() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in block.ranges()], names=["row", "begin", "end"])

    for batch in batches:
        for k, row, first, count, raw in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
            if k != key:
                block.add(group)
                key, group = k, {}
                if block.full():
                    yield packed()
                    block = _Block()
            group.setdefault(raw, []).append((row, first, count))
    block.add(group)
    yield packed()


def _union(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted ranges of each row, those that touch or overlap as one."""
    for batch in batches:
        spans = []
        for ranges in batch.column(1).to_pylist():
            out: list[list[int]] = []
            for r in ranges:
                if out and r["begin"] <= out[-1][1]:
                    out[-1][1] = max(out[-1][1], r["end"])
                else:
                    out.append([r["begin"], r["end"]])
            spans.append([{"begin": a, "end": b} for a, b in out])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, _SPANS)], names=["row", "spans"])


_SPANS = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, text, spans) with the bytes outside the spans added."""
    for batch in batches:
        kept, sizes = [], []
        for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            sizes.append(len(text))
            if spans:
                edges = [0, *[x for s in spans for x in (s["begin"], s["end"])], len(text)]
                text = b"".join([text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)])
            kept.append(text)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), batch.column(2),
                                          pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "spans", "kept"])


def _attached(texts: DataFrame, extra: DataFrame, how: str, small: bool = False) -> DataFrame:
    """``texts`` joined with a table by (doc_id, mark)."""
    extra = extra.withColumnsRenamed({"doc_id": "__id", "mark": "__mark"})
    extra = F.broadcast(extra) if small else extra
    return texts.join(extra, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("mark") == F.col("__mark")), how)


def find_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(texts, spans): the rows as (doc_id, mark, text bytes), and for those with repeats
    (doc_id, mark, spans), spans being sorted maximal ranges of bytes."""
    spark = docs.sparkSession
    python_stages(spark)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(id_col), F.col(text_col)).alias("mark"),
                        text_bytes(F.col(text_col)).alias("t"))
    id_type = texts.schema["doc_id"].dataType.simpleString()
    signed = materialize(texts.mapInArrow(_anchors, f"doc_id {id_type}, mark bigint, {_ANCHORS}"), "repeats-signed")
    each = signed.select("row", F.explode(F.arrays_zip("gram", "content", "first", "shape")).alias("s")).select("row", "s.*")
    shared = (each.groupBy("gram").agg(F.count(F.lit(1)).alias("n"), F.min("content").alias("c1"), F.max("content").alias("c2"))
              .filter("n > 1").select("gram", (F.col("c1") == F.col("c2")).alias("same"), (F.col("n") > HOT).alias("hot")))
    shared = materialize(each.join(shared, "gram"), "repeats-shared")
    length = F.shiftright("shape", 8).cast("bigint")
    ranges = shared.filter("same").select("row", F.col("first").alias("begin"), (F.col("first") + length - 1 + WINDOW).alias("end"))

    # Minimizers whose segments differ: fetch the bytes, index them.
    wanted = (shared.filter("NOT same").groupBy("row").agg(F.collect_list(F.struct("gram", "first", "shape", "hot")).alias("wanted"))
              .join(signed.select("row", "doc_id", "mark"), "row"))
    wanted = materialize(wanted, "repeats-wanted")
    cut = materialize(_attached(texts, wanted, "inner").select("t", "row", "wanted")
                      .mapInArrow(_cut, _RECORD_SCHEMA), "repeats-segments")
    hot = cut.filter("level = 2").groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > HOT).select("key")
    hot = materialize(hot, "repeats-hot")
    normal = cut.join(hot, "key", "left_anti") if not hot.isEmpty() else cut
    indexed = (normal.select("key", "row", "first", "count", "bytes").repartition("key").sortWithinPartitions("key")
               .mapInArrow(_index, "row bigint, begin bigint, end bigint"))
    ranges = ranges.unionByName(indexed)
    if not hot.isEmpty():
        one = (cut.filter("level = 2").join(hot, "key").select("row", "first", "count", "bytes")
               .mapInArrow(_single, "window binary, row bigint, first bigint"))
        one = materialize(one, "repeats-windows")
        twice = one.groupBy("window").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
        ranges = ranges.unionByName(one.join(twice, "window").select(
            "row", F.col("first").alias("begin"), (F.col("first") + WINDOW).alias("end")))
    spans = (ranges.groupBy("row").agg(F.sort_array(F.collect_set(F.struct("begin", "end"))).alias("ranges"))
             .mapInArrow(_union, "row bigint, spans array<struct<begin:bigint,end:bigint>>"))

    copies = (signed.filter(F.col("n_bytes") >= WINDOW).groupBy("digest").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
              .select("digest", F.lit(True).alias("whole")))
    all_ = F.array(F.struct(F.lit(0).cast("bigint").alias("begin"), F.col("n_bytes").alias("end")))
    found = (signed.select("doc_id", "mark", "row", "digest", "n_bytes").join(copies, "digest", "left").join(spans, "row", "left")
             .select("doc_id", "mark", F.when(F.col("whole"), all_).otherwise(F.col("spans")).alias("spans"))
             .filter("spans IS NOT NULL").dropDuplicates(["doc_id", "mark"]))
    return texts, materialize(found, "repeats-found")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_bytes, spans (begin, end of each maximal removed
    run of bytes) and kept (the remaining bytes)."""
    texts, found = find_repeats(docs, id_col, text_col)
    id_type = texts.schema["doc_id"].dataType.simpleString()
    ranges = found.agg(F.sum(F.size("spans") + 1)).first()[0] or 0
    rows = _attached(texts, found, "left", ranges <= BROADCAST_RANGES).select("doc_id", "t", "spans")
    out = rows.mapInArrow(_remove, f"doc_id {id_type}, n_bytes bigint, spans array<struct<begin:bigint,end:bigint>>, kept binary")
    return out.withColumn("spans", F.coalesce("spans", F.array().cast("array<struct<begin:bigint,end:bigint>>")))
