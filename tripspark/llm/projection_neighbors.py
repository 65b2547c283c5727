"""Near-duplicate vectors by sorted projection passes (operator 5).

Method. In each pass every vector gets a key of BITS random hyperplane signs,
concatenated; vectors are ordered by that key and each is compared with the
WINDOW vectors before it and with all that share the first bits of its key (its
prefix), however many they are. Pairs whose cosine reaches the threshold in
double precision are links; links of all passes are united to components. So that
a dense group's links are not capped by the window, the pairs inside each
component are then compared in tiles, and every link in it is counted.

Passes. The hyperplanes go through the origin, so a pair at the threshold agrees
on one bit with probability 1 - acos(t)/pi wherever the other vectors lie, and
meets in a pass if it agrees on the prefix. The number of passes follows from the
bits of the prefix alone, so that such a pair is missed with a probability of MISS
at most, before other members of its group help; that holds for any distribution
of the vectors. Their density only decides what is cheapest: the prefix has
log2(n / WINDOW) bits, or more where a sample of the vectors is crowded enough
that longer prefixes in more passes take fewer cosines.

Scale. Equal vectors are one node from the start, with a count, so a vector that
makes up a third of all rows costs nothing further. A pass is a range
partitioning by (pass, key, node). Vectors of one prefix stay together up to TILE
of them; a larger prefix is split like any other run, and what its windows have
not connected is then compared in tile pairs, which go to different tasks: its
cosines grow with the square of the vectors that share a prefix. A task
unites what it links, and emits at most one edge a vector. A component of m
different vectors is dealt as tile pairs of TILE vectors each, spread over all
tasks: the count of links in a dense group of m vectors is a matter of m * m / 2
cosines, which the tiles share out, but neither pairs nor groups are gathered.

Cases. A vector that is null, empty, zero or holds null or non-finite components
links with nothing and is its own component. Vectors of different lengths don't
link. Rows that repeat an id are vectors of their own with that id; a component
of rows without ids has a null component_id. Extra columns are not read. An
empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripspark.llm.common import counted_broadcast, materialize, python_stages
from tripspark.llm.components import connected_components

THRESHOLD = 0.9
BITS, WINDOW, TILE = 48, 256, 1024
MISS = 0.002
SEED = 5
#: Vectors and passes of the sample that the bits of the prefix are chosen by, and the cosines
#: that take as long as moving one vector through a pass. They decide the cost, not the result.
SAMPLE, TRIALS, MOVE = 50_000, 4, 1024


def passes_of(bits: float, threshold: float = THRESHOLD, miss: float = MISS) -> int:
    """Passes after which a pair at the threshold has agreed on the first bits of a key."""
    meet = (1 - math.acos(threshold) / math.pi) ** bits
    return 1 if meet >= 1 else math.ceil(math.log(miss) / math.log1p(-meet))


def bits_for(nodes: int, window: int = WINDOW) -> int:
    """Bits of a prefix that evenly spread vectors share with a window of others."""
    return min(BITS, math.ceil(max(0.0, math.log2(max(1, nodes) / window))))


def passes_for(nodes: int, threshold: float = THRESHOLD, window: int = WINDOW, miss: float = MISS) -> int:
    """Passes for evenly spread vectors."""
    return passes_of(bits_for(nodes, window), threshold, miss)


def _prefix_bits(groups: DataFrame, nodes: int, threshold: float) -> int:
    """Bits of the prefix that take the least work, from bits_for(nodes) on: passes times
    the moves of vectors and the pairs that share a prefix, as a sample has them."""
    least = bits_for(nodes, WINDOW)
    if not least:
        return 0
    step = max(1, math.ceil(nodes / SAMPLE))
    sample = groups.filter(F.pmod(F.xxhash64("node"), F.lit(step)) == 0).select("node", "vector")
    keys = sample.mapInArrow(_keys(TRIALS), "node bigint, vector array<double>, keys array<bigint>")
    keys = keys.select(F.size("vector").alias("dims"), F.posexplode("keys").alias("pass", "key"))
    cut = keys.select("dims", "pass", "key", F.explode(F.sequence(F.lit(least), F.lit(BITS))).alias("bits"))
    cut = cut.withColumn("prefix", F.expr(f"shiftright(key, {BITS} - bits)"))
    pairs = (cut.groupBy("bits", "dims", "pass", "prefix").agg(F.count(F.lit(1)).alias("n"))
             .groupBy("bits").agg(F.sum(F.col("n").cast("double") * (F.col("n") - 1)).alias("pairs")))
    found = {r["bits"]: r["pairs"] * step * step / TRIALS for r in pairs.collect()}
    return min(range(least, BITS + 1), key=lambda k: passes_of(k, threshold) * (MOVE * nodes + found.get(k, 0.0)))


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of an Arrow list column of equal lengths as doubles."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _by_length(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, matrix) for each vector length in a batch."""
    lengths = np.diff(column.offsets.to_numpy())
    for n in np.unique(lengths):
        own = np.flatnonzero(lengths == n)
        yield own, _matrix(column.take(pa.array(own)))


def _unit(x: np.ndarray) -> np.ndarray:
    scale = np.abs(x).max(axis=1, keepdims=True)
    x = x / np.where(scale > 0, scale, 1)
    norm = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return x / np.where(norm > 0, norm, 1)


def _keys(passes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        weights = 1 << np.arange(BITS - 1, -1, -1, dtype=np.int64)
        for batch in batches:
            keys = np.zeros((batch.num_rows, passes), dtype=np.int64)
            for own, x in _by_length(batch.column(1)):
                d = x.shape[1]
                if d not in planes:
                    planes[d] = np.random.default_rng([SEED, d]).standard_normal((d, passes * BITS))
                bits = (_unit(x) @ planes[d] >= 0).reshape(len(x), passes, BITS)
                keys[own] = bits @ weights
            ends = pa.array(np.arange(0, passes * batch.num_rows + 1, passes, dtype=np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1),
                                              pa.ListArray.from_arrays(ends, pa.array(keys.ravel()))],
                                             names=["node", "vector", "keys"])
    return run


class _Forest:
    """Union of nodes within one task."""

    def __init__(self) -> None:
        self.root: dict[int, int] = {}

    def find(self, a: int) -> int:
        root = self.root
        while (b := root.get(a, a)) != a:
            root[a] = root.get(b, b)
            a = b
        return a

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self.root[max(a, b)] = min(a, b)
        return True


def _windows(threshold: float):
    """Edges that connect each vector with linked ones among the WINDOW before it and among
    all before it in its group, over rows (pass, dims, group, node, vector) in order; a
    group of -1 is none."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest, turn, before_ids, before_groups, before = None, None, None, None, None
        for batch in batches:
            turns = batch.column(0).to_numpy() * (1 << 32) + batch.column(1).to_numpy()
            given, nodes = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            edges: list[tuple[int, int]] = []
            for lo, hi in _runs(turns):
                x, ids, groups = _unit(_matrix(batch.column(4).slice(lo, hi - lo))), nodes[lo:hi], given[lo:hi]
                if turn != turns[lo]:
                    forest, turn, before_ids, before_groups, before = _Forest(), turns[lo], ids[:0], groups[:0], x[:0]
                skip = len(before)
                x, ids, groups = (np.concatenate(p) for p in ((before, x), (before_ids, ids), (before_groups, groups)))
                start = _group_starts(groups)
                for at in range(skip, len(x), WINDOW):
                    stop, begin = min(at + WINDOW, len(x)), max(0, min(at - WINDOW, int(start[at])))
                    i, j = np.nonzero(x[at:stop] @ x[begin:stop].T >= threshold)
                    i, j = i + at, j + begin
                    near = (j < i) & ((i - j <= WINDOW) | (j >= start[i]))
                    edges += [(a, b) for a, b in zip(ids[i[near]].tolist(), ids[j[near]].tolist(), strict=True)
                              if forest.join(a, b)]
                held = max(0, min(len(x) - WINDOW, int(start[-1])))
                before_ids, before_groups, before = ids[held:], groups[held:], x[held:]
            a, b = zip(*edges, strict=True) if edges else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
    return run


def _group_starts(groups: np.ndarray) -> np.ndarray:
    """The place at which each row's group begins, its own for rows of no group."""
    place = np.arange(len(groups))
    new = np.ones(len(groups), dtype=bool)
    new[1:] = groups[1:] != groups[:-1]
    return np.where(groups < 0, place, np.maximum.accumulate(np.where(new, place, 0)))


def _runs(values: np.ndarray) -> list[tuple[int, int]]:
    """Borders of the runs of equal values."""
    cuts = np.flatnonzero(values[1:] != values[:-1]) + 1
    return list(zip([0, *cuts.tolist()], [*cuts.tolist(), len(values)], strict=True)) if len(values) else []


def _tiles(found: Callable[[pa.Table, np.ndarray, np.ndarray, bool], pa.RecordBatch], keys: int):
    """What ``found`` makes of each tile pair, over rows that begin with ``keys`` columns, the
    last two being i and j, and have a column ``tile``; rows of a pair arrive together. It
    gets the pair's rows, the places of those in i and in j, and whether i is j."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        key = None

        def close() -> pa.RecordBatch:
            rows = pa.Table.from_batches(held).combine_chunks()
            tile = rows.column("tile").to_numpy()
            return found(rows, np.flatnonzero(tile == key[-2]), np.flatnonzero(tile == key[-1]), key[-2] == key[-1])

        for batch in batches:
            turns = list(zip(*(batch.column(k).to_pylist() for k in range(keys)), strict=True))
            begin = 0
            for i, k in enumerate(turns):
                if k != key:
                    if begin < i:
                        held.append(batch.slice(begin, i - begin))
                    if held:
                        yield close()
                    held, key, begin = [], k, i
            held.append(batch.slice(begin))
        if held:
            yield close()
    return run


def _link_counts(threshold: float):
    """Links of each vector (node, copies, vector) within a tile pair."""
    def found(rows: pa.Table, first: np.ndarray, second: np.ndarray, same: bool) -> pa.RecordBatch:
        nodes, copies = (rows.column(n).to_numpy() for n in ("node", "copies"))
        x = _unit(_matrix(rows.column("vector")))
        near = x[first] @ x[second].T >= threshold
        if same:
            np.fill_diagonal(near, False)
            links = near @ copies[second]
            ids = nodes[first]
        else:
            links = np.concatenate([near @ copies[second], near.T @ copies[first]])
            ids = np.concatenate([nodes[first], nodes[second]])
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(links, pa.int64())], names=["node", "links"])
    return found


def _new_edges(threshold: float):
    """Edges between linked vectors (component, vector) of a tile pair that are in different
    components so far: one for each two components that they connect."""
    def found(rows: pa.Table, first: np.ndarray, second: np.ndarray, same: bool) -> pa.RecordBatch:
        component = rows.column("component").to_numpy()
        x, forest, edges = _unit(_matrix(rows.column("vector"))), _Forest(), []
        near = x[first] @ x[second].T >= threshold
        for k in np.flatnonzero(near.any(axis=1)).tolist():
            own = int(component[first[k]])
            for other in np.unique(component[second[near[k]]]).tolist():
                if other != own and forest.join(own, other):
                    edges.append((own, other))
        a, b = zip(*edges, strict=True) if edges else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
    return found


def _dealt(rows: DataFrame, within: list[str], columns: list[str]) -> DataFrame:
    """Rows (``within``, members, node, ...) as (``within``, i, j, tile, ``columns``) once for
    each tile pair that they are in, those of a pair together."""
    tiles = F.ceil(F.col("members") / TILE).cast("int")
    rows = rows.withColumns({"tiles": tiles, "tile": F.pmod(F.xxhash64("node"), tiles).cast("int")})
    dealt = rows.select(*within, "tile", *columns, F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other"))
    dealt = dealt.select(*within, F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j"), "tile", *columns)
    return dealt.repartition(*within, "i", "j").sortWithinPartitions(*within, "i", "j")


def _components(groups: DataFrame, threshold: float) -> DataFrame:
    """(node, component) of the vectors (node, vector) that links of the passes connect."""
    spark = groups.sparkSession
    nodes = groups.count()
    bits = _prefix_bits(groups, nodes, threshold)
    keyed = groups.select("node", "vector").mapInArrow(_keys(passes_of(bits, threshold)),
                                                       "node bigint, vector array<double>, keys array<bigint>")
    placed = keyed.select(F.posexplode("keys").alias("pass", "key"), F.size("vector").alias("dims"), "node", "vector")
    placed = placed.withColumn("prefix", F.shiftright("key", BITS - bits))

    # Prefixes of more vectors than one tile: their rows are not kept together.
    prefix = ["pass", "dims", "prefix"]
    large = placed.groupBy(*prefix).agg(F.count(F.lit(1)).alias("members")).filter(F.col("members") > TILE)
    large = materialize(large, "vectors-large")
    some = not large.isEmpty()
    if some:
        large = counted_broadcast(large)
        marked = placed.join(large, prefix, "left").withColumn("split", F.col("members").isNotNull())
    else:
        marked = placed.withColumn("split", F.lit(False))
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    together = [F.when(F.col("split"), F.col(c)).otherwise(F.lit(0)) for c in ("key", "node")]
    order = ("pass", "dims", "key", "node")
    edges = (marked.repartitionByRange(partitions, *prefix, *together).sortWithinPartitions(*order)
             .select(F.col("pass").cast("bigint").alias("pass"), F.col("dims").cast("bigint").alias("dims"),
                     F.when(F.col("split"), F.lit(-1)).otherwise(F.col("prefix")).cast("bigint").alias("group"), "node", "vector")
             .mapInArrow(_windows(threshold), "a bigint, b bigint"))
    if not some:
        return connected_components(edges)

    # Large prefixes, in tiles, where the windows have left more than one component.
    edges = materialize(edges, "vectors-edges")
    component = materialize(connected_components(edges), "vectors-united")
    rows = placed.select("pass", "dims", "prefix", "node").join(large, prefix).join(component, "node", "left")
    rows = materialize(rows.withColumn("component", F.coalesce("component", "node")), "vectors-crowded")
    apart = (rows.groupBy(*prefix).agg(F.min("component").alias("c1"), F.max("component").alias("c2"))
             .filter("c1 <> c2").select(*prefix))
    rows = rows.join(counted_broadcast(materialize(apart, "vectors-apart")), prefix).join(groups.select("node", "vector"), "node")
    more = materialize(_dealt(rows, prefix, ["component", "vector"])
                       .mapInArrow(_tiles(_new_edges(threshold), 5), "a bigint, b bigint"), "vectors-more")
    return connected_components(edges.union(more)) if not more.isEmpty() else component


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    threshold: float = THRESHOLD) -> DataFrame:
    """One row per input row: vec_id, n_links, component_id, kept (see module docstring)."""
    spark = vectors.sparkSession
    python_stages(spark, 2048)
    v = F.col("vector")
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    usable = F.coalesce(F.forall(v, finite) & F.exists(v, lambda x: x != 0), F.lit(False))
    rows = rows.withColumn("usable", usable)
    groups = (rows.filter("usable").groupBy("vector").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies"))
              .withColumn("node", F.monotonically_increasing_id()))
    groups = materialize(groups.select("node", "least", "copies", "vector"), "vectors-nodes")
    component = materialize(_components(groups, threshold), "vectors-components")

    members = groups.join(component, "node")
    sizes = component.groupBy("component").agg(F.count(F.lit(1)).alias("members"))
    counted = (_dealt(members.join(sizes, "component"), ["component"], ["node", "copies", "vector"])
               .mapInArrow(_tiles(_link_counts(threshold), 3), "node bigint, links bigint")
               .groupBy("node").agg(F.sum("links").alias("links")))
    named = (groups.select("node", "least", "copies", "vector").join(component, "node", "left")
             .withColumn("component", F.coalesce("component", "node")))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    found = named.join(least, "component").join(counted, "node", "left").select(
        F.col("vector").alias("v"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    out = rows.filter("usable").join(found, F.col("vector") == F.col("v")).select("vec_id", "n_links", "component_id")
    alone = rows.filter("NOT usable").select("vec_id", F.lit(0).cast("bigint").alias("n_links"),
                                             F.col("vec_id").alias("component_id"))
    return out.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
