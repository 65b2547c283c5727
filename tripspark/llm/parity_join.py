"""N-gram Jaccard join through parity sketches (operator 4).

Method. A document's set holds its distinct five-word shingles. Sets of a size
band are hashed into K blocks, and every shingle toggles one bit of a wide bit
sketch in its block, so that the Hamming distance of two sketches is at most
the symmetric difference of the sets. Sets with Jaccard similarity of at least
0.8 differ in at most n / 4 elements, n being the size of either, hence in at
most n / 4 blocks. By the pigeonhole principle two such sets agree on a block
that is among the first n / 4 + 1 non-empty blocks of both in any fixed order
of (block, content). Those blocks are join keys: a block's bits are carried as
the XOR of one 64-bit code per set bit. Pairs that meet are first compared on
folded sketches of two to four bits a shingle, whose Hamming distance is still at
most the symmetric difference, and those that may link on their full sets.

Bands. Band p covers sizes from 2^p to 2.5 * 2^p, so that every pair that can
link shares a band (a set is in one or two). From size 64 on, K is 2^p: one to
two and a half shingles a block, and far more than n / 4 + 1 blocks are
non-empty (by over nine standard deviations). Smaller sets use 2^20 blocks.

Skew. Equal sets share one node from the start: each task emits the keys of a
set once, and tasks' repeats merge before verification. The order of blocks
puts those that are frequent in a sample of documents last; the order
never changes the result, but keeps shared passages out of the keys. Documents
that share a key are not paired with one another, but with one centre, and only
for what is not connected after that the other pairs of the key are verified.
In a large key this is done in rounds: a row meets at most one further centre of
its tile pair in a round, and what the links found connect is left out of the next
one. A last round takes all pairs that are left then. Keys that the same rows share,
as near copies do, are taken once.
Hence every pair that can link is either verified or already connected.

Cases. Null text and text without words have the empty set, link with nothing
and are their own component. Rows that repeat an id are separate rows with the
same id. A component of rows without ids has a null component_id. Extra
columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripspark.llm.common import byte_view, counted_broadcast, materialize, mix64, python_stages, text_bytes, tidy
from tripspark.llm.components import component_stars
from tripspark.llm.shingles import shingle_sets

#: Least documents of the sample that finds frequent blocks, the share of larger tables that is
#: taken, and the documents of the sample in which a block must occur to be put last. The sample grows
#: with the table, so that the keys left have few rows whatever its size.
SAMPLE_ROWS, SAMPLE_SHARE, FREQUENT = 16_000, 4, 4
#: Frequent keys that the driver and the tasks get, the most frequent ones. Any choice gives the same links.
FREQUENT_KEYS = 1_000_000

_SMALL = 64
_BIT = np.uint64(0xD6E8FEB86659FD93)
_BAND = np.uint64(0xA0761D6478BD642F)


def set_hash(s: np.ndarray) -> int:
    """A 64-bit hash of a set of hashes, as a signed integer."""
    total = np.array([np.add.reduce(mix64(s ^ _BIT), dtype=np.uint64)])
    return int(mix64(total + np.array([len(s)], dtype=np.uint64) * _BAND).view(np.int64)[0])


def block_keys(s: np.ndarray) -> np.ndarray:
    """Keys (band, block, bits) of all non-empty blocks of a sorted set, all bands, as (bands, list of arrays)."""
    n = len(s)
    p = n.bit_length() - 1
    bands = [p] if p == 0 or 4 * n >= 5 << p else [p, p - 1]
    codes = mix64(s ^ _BIT)
    out = []
    for band in bands:
        bits = band if n >= _SMALL and band >= 6 else 20
        block = s >> np.uint64(64 - bits)
        starts = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
        sketch = np.bitwise_xor.reduceat(codes, starts)
        out.append(mix64(sketch + mix64(block[starts] * _BAND + np.uint64(band + 1))))
    return out


def folded_sketch(s: np.ndarray) -> bytes:
    """The parity sketch in the power of two of bits that is two to four times the size."""
    bits = max(64, 1 << (len(s).bit_length() + 1))
    where = (mix64(s ^ _BIT) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits(np.bincount(where, minlength=bits).astype(np.uint8) & 1, bitorder="little").tobytes()


def hamming(x: bytes, y: bytes) -> int:
    """Distance of two folded sketches; the longer one is folded to the shorter one's bits."""
    u, v = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    while len(u) != len(v):
        if len(u) < len(v):
            u, v = v, u
        u = u[:len(u) // 2] ^ u[len(u) // 2:]
    return int(np.bitwise_count(u ^ v).sum())


def signature(s: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """The keys of the first n / 4 + 1 blocks of each band, frequent ones last."""
    need, out = len(s) // 4 + 1, []
    for keys in block_keys(s):
        keys = np.sort(keys)
        if len(frequent):
            at = np.minimum(np.searchsorted(frequent, keys), len(frequent) - 1)
            last = frequent[at] == keys
            keys = np.concatenate([keys[~last], keys[last]])
        out.append(keys[:need])
    return np.concatenate(out)


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.zeros(len(arrays) + 1, dtype=np.int32)
    np.cumsum([len(a) for a in arrays], out=ends[1:])
    values = np.concatenate(arrays).view(np.int64) if arrays else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values))


def _values(lists: pa.ListArray) -> tuple[np.ndarray, list[int]]:
    """(values, offsets) of an array of lists of hashes."""
    return lists.values.to_numpy().view(np.uint64), lists.offsets.to_numpy().tolist()


def _sample_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: set[int] = set()
    for batch in batches:
        out = []
        for s in shingle_sets(*byte_view(batch.column(0))):
            if len(s) and (h := set_hash(s)) not in seen:
                seen.add(h)
                out.extend(block_keys(s))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out).view(np.int64) if out else [], pa.int64())],
                                         names=["key"])


def _sign(frequent: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        seen: set[int] = set()
        for batch in batches:
            sizes, hashes, rows, keys, sketches = [], [], [], [], []
            for s in shingle_sets(*byte_view(batch.column(1))):
                h = set_hash(s)
                new = len(s) > 0 and h not in seen
                seen.add(h)
                sizes.append(len(s))
                hashes.append(h)
                rows.append(row)
                row += 1
                keys.append(signature(s, frequent) if new else s[:0])
                sketches.append(folded_sketch(s) if new else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(hashes, pa.int64()),
                 pa.array(rows, pa.int64()), _lists(keys), pa.array(sketches, pa.binary())],
                names=["doc_id", "n_shingles", "node", "row", "keys", "sketch"])
    return run


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: set[int] = set()
    for batch in batches:
        hashes, sets = [], []
        for s in shingle_sets(*byte_view(batch.column(0))):
            if len(s) and (h := set_hash(s)) not in seen:
                seen.add(h)
                hashes.append(h)
                sets.append(s)
        yield pa.RecordBatch.from_arrays([pa.array(hashes, pa.int64()), _lists(sets)], names=["node", "items"])


def _may_link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of pairs (a, b, sizes of both, x, y, ids of both) those whose sketches x and y don't rule out a similarity of 0.8."""
    for batch in batches:
        sizes = batch.column(2).to_pylist()
        x, y = batch.column(3).to_pylist(), batch.column(4).to_pylist()
        keep = [9 * hamming(u, v) <= n for n, u, v in zip(sizes, x, y, strict=True)]
        yield batch.select([0, 1, 5, 6]).filter(pa.array(keep, pa.bool_()))


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b, x, y) whose sorted sets x and y have a similarity of 0.8 or more."""
    for batch in batches:
        (u, at), (v, on) = (_values(batch.column(k)) for k in (2, 3))
        keep = []
        for i in range(batch.num_rows):
            both = np.concatenate([u[at[i]:at[i + 1]], v[on[i]:on[i + 1]]])
            both.sort()
            common = int(np.count_nonzero(both[1:] == both[:-1]))
            keep.append(100 * common >= 80 * (len(both) - common))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))


def frequent_blocks(docs: DataFrame, rows: int = SAMPLE_ROWS) -> np.ndarray:
    """Sorted keys of blocks that are frequent in a sample: ``rows`` documents, in larger tables one of SAMPLE_SHARE."""
    ids = docs.select("doc_id")
    if ids.limit(SAMPLE_SHARE * rows + 1).count() <= SAMPLE_SHARE * rows:
        ids = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
        picked = docs.join(F.broadcast(ids.distinct()), "doc_id")
    else:
        picked = docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(SAMPLE_SHARE)) == 0)
    sample = picked.select(text_bytes(F.col("text")).alias("t"))
    keys = sample.mapInArrow(tidy(_sample_keys), "key bigint").groupBy("key").count()
    found = keys.filter(F.col("count") >= FREQUENT).orderBy(F.desc("count"), "key").limit(FREQUENT_KEYS)
    found = found.select("key").toArrow().column(0)
    return np.sort(found.to_numpy().view(np.uint64))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id (see module docstring)."""
    return _placed(docs, id_col, text_col).select(
        "doc_id", "n_shingles",
        F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def _placed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per input row: doc_id, n_shingles, node, component (a node; null for empty
    sets) and component_id, its smallest id."""
    spark = docs.sparkSession
    python_stages(spark)
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    bytes_ = docs.select("doc_id", text_bytes(F.col("text")).alias("t"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    signed = materialize(bytes_.mapInArrow(
        tidy(_sign(frequent_blocks(docs))),
        f"doc_id {id_type}, n_shingles bigint, node bigint, row bigint, keys array<bigint>, sketch binary"), "jaccard-signed")
    nodes = signed.filter("sketch IS NOT NULL").select("row", "node", "n_shingles", "sketch", "doc_id")

    # Rows that share a key, each with the smallest of them.
    met = materialize(_meetings(signed.select("row", F.explode("keys").alias("key"))), "jaccard-met")
    used = materialize(met.select("row").distinct().join(nodes, "row"), "jaccard-used")

    # Equal sets in different tasks are one node, so nodes carry the links.
    links = _verified(bytes_, used, met.filter("row <> lo").select(F.col("lo").alias("a"), F.col("row").alias("b")))
    component = _stars_of(links)
    apart = materialize(_apart(met, _components_of(used, component)), "jaccard-apart")
    small, large = apart.filter(F.col("members") <= SMALL_KEY), apart.filter(F.col("members") > SMALL_KEY)
    pairs = materialize(_remaining(small, used, None, split=False), "jaccard-tried")
    component, linked = _joined(bytes_, used, component, pairs)
    if linked:
        large = materialize(_apart(large, _components_of(used, component)), "jaccard-large")
    attempt: int | None = 0
    while not large.isEmpty():
        component, linked = _joined(bytes_, used, component, materialize(_remaining(large, used, attempt), "jaccard-tried"))
        if attempt is None or linked is None:
            break
        # Components only grow, so keys that are within one stay out of later attempts.
        large = materialize(_apart(large, _components_of(used, component)), "jaccard-large")
        # Without a link, another round would only try the same rows one by one.
        attempt = attempt + 1 if linked and attempt + 1 < ROUNDS else None
    least = (signed.filter("n_shingles > 0").groupBy("node").agg(F.min("doc_id").alias("doc_id"))
             .join(component, "node", "left").withColumn("component", F.coalesce("component", "node")))
    named = least.join(least.groupBy("component").agg(F.min("doc_id").alias("component_id")), "component").select(
        "node", "component", "component_id")
    return signed.select("doc_id", "n_shingles", "node").join(named, "node", "left")


def _meetings(keys: DataFrame) -> DataFrame:
    """Rows (key, row, lo) of the keys in ``keys`` (row, key) that several rows have; lo is the smallest of them.

    Near copies share many keys, so keys that the same rows have become one, named by these rows. Should
    different rows get one name, they meet under it together: more meet, and none less."""
    share = Window.partitionBy("key")
    rows = keys.withColumns({"lo": F.min("row").over(share), "hi": F.max("row").over(share),
                             "name": F.bit_xor(F.xxhash64("row")).over(share)}).filter("lo <> hi")
    return rows.select(F.col("name").alias("key"), "row", "lo").distinct()


def _verified(texts: DataFrame, used: DataFrame, pairs: DataFrame) -> DataFrame:
    """Links (a, b) between nodes among pairs (a, b) of rows: sizes are compared, then
    sketches, then the sets of what is left."""
    side = used.select("row", "node", "n_shingles", "sketch", "doc_id")
    id_type = used.schema["doc_id"].dataType.simpleString()
    pairs = (pairs.distinct().join(side.toDF("a", "na", "sa", "xa", "ia"), "a").join(side.toDF("b", "nb", "sb", "xb", "ib"), "b")
             .filter("na <> nb AND 5 * least(sa, sb) >= 4 * greatest(sa, sb)")
             .select(F.least("na", "nb").alias("a"), F.greatest("na", "nb").alias("b"), (F.col("sa") + F.col("sb")).alias("n"),
                     "xa", "xb", F.expr("if(na < nb, ia, ib)").alias("ia"), F.expr("if(na < nb, ib, ia)").alias("ib"))
             .mapInArrow(tidy(_may_link), f"a bigint, b bigint, ia {id_type}, ib {id_type}"))
    pairs = materialize(pairs.groupBy("a", "b").agg(F.min("ia").alias("ia"), F.min("ib").alias("ib")), "jaccard-pairs")
    if pairs.isEmpty():
        return pairs.select("a", "b")
    nodes = pairs.select(F.col("a").alias("node"), F.col("ia").alias("used_id")).union(pairs.select("b", "ib"))
    nodes = materialize(nodes.groupBy("node").agg(F.min("used_id").alias("used_id")), "jaccard-nodes")
    ids = counted_broadcast(nodes.select("used_id"))
    nodes = counted_broadcast(nodes.select("node"))
    rows = texts.join(ids, F.col("doc_id").eqNullSafe(F.col("used_id")), "left_semi")
    items = rows.select("t").mapInArrow(tidy(_sets), "node bigint, items array<bigint>")
    items = materialize(items.join(nodes, "node", "left_semi"), "jaccard-sets")
    full = pairs.select("a", "b").join(items.toDF("a", "x"), "a").join(items.toDF("b", "y"), "b").select("a", "b", "x", "y")
    return materialize(full.mapInArrow(tidy(_verify), "a bigint, b bigint"), "jaccard-links")


def _joined(texts: DataFrame, used: DataFrame, component: DataFrame, pairs: DataFrame) -> tuple[DataFrame, bool | None]:
    """(components with the links among pairs of rows, whether there are links); None if there are no pairs."""
    if pairs.isEmpty():
        return component, None
    more = _verified(texts, used, pairs)
    if more.isEmpty():
        return component, False
    return _stars_of(component.toDF("a", "b").union(more)), True


def _stars_of(links: DataFrame) -> DataFrame:
    """(node, component) of nodes with links; the smallest node of a component may be left out."""
    return component_stars(links).toDF("node", "component")


def _components_of(used: DataFrame, component: DataFrame) -> DataFrame:
    """(row, n, comp) of each row that shares a key."""
    return used.join(component, "node", "left").select("row", F.coalesce("component", "node").alias("comp"),
                                                       F.col("n_shingles").alias("n"))


def _apart(met: DataFrame, of: DataFrame) -> DataFrame:
    """Rows (key, row, n, comp, members) of the keys whose rows are in different components
    so far, ``of`` giving each row's."""
    share = Window.partitionBy("key")
    rows = met.select("key", "row").join(of, "row").withColumns({
        "c1": F.min("comp").over(share), "c2": F.max("comp").over(share), "members": F.count(F.lit(1)).over(share)})
    return rows.filter("c1 <> c2").select("key", "row", "n", "comp", "members")


def _remaining(rows: DataFrame, used: DataFrame, attempt: int | None, split: bool = True) -> DataFrame:
    """Pairs of rows that share a key, are in different components so far, and may be
    similar by their sizes and short sketches. Rows of a key are compared in tiles; the
    tiles of a large key go to different tasks. Without ``split`` a key is one tile.

    An attempt gives all such pairs of small keys. Of large ones it gives at most one pair
    for each row of a tile pair (none only if none is left), and ``None`` all of them."""
    dealt = rows.join(used.select("row", "sketch"), "row")
    if split:
        tiles = F.ceil(F.col("members") / TILE).cast("int")
        dealt = (dealt.withColumns({"tile": F.pmod(F.xxhash64("row"), tiles).cast("int"), "tiles": tiles})
                 .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))))
    else:
        dealt = dealt.withColumns({"tile": F.lit(0), "other": F.lit(0)})
    dealt = dealt.select("key", F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j"), "n", "tile", "row",
                         "comp", "sketch")
    return (dealt.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "n")
            .mapInArrow(tidy(_tile_pairs(attempt)), "a bigint, b bigint"))


#: Rows of a key that are compared in one tile, and the most 64-bit words of a sketch there.
TILE, TILE_WORDS = 2048, 64
#: Rows up to which all pairs of a key are taken at once, and rounds in which the rows of
#: larger keys meet one centre. Neither changes the links.
SMALL_KEY, ROUNDS = 32, 2


def _short(sketch: bytes) -> np.ndarray:
    words = np.frombuffer(sketch, np.uint64)
    while len(words) > TILE_WORDS:
        words = words[:len(words) // 2] ^ words[len(words) // 2:]
    return words


def _tile_pairs(attempt: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pairs that may link, of rows (key, i, j, n, tile, row, comp, sketch) by key, tile pair and size."""
        key, held = None, []
        for batch in batches:
            out: list[tuple[np.ndarray, np.ndarray]] = []
            for values in zip(*(batch.column(k).to_pylist() for k in range(8)), strict=True):
                if values[:3] != key:
                    out += _compared(key, held, attempt)
                    key, held = values[:3], []
                held.append((*values[3:7], _short(values[7])))
            if out:
                yield _pair_batch(out)
        yield _pair_batch(_compared(key, held, attempt))
    return run


def _pair_batch(pairs: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    a, b = (np.concatenate([p[k] for p in pairs]) if pairs else np.zeros(0, np.int64) for k in range(2))
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _compared(key: tuple | None, held: list[tuple], attempt: int | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
    """Pairs of one tile pair, by size: a row meets those up to 5 / 4 of its size.

    With an ``attempt`` and many rows, those are taken in an order that differs between
    attempts, and one that was met is neither met again nor a centre itself."""
    out = []
    if key is None or len(held) < 2:
        return out
    n, tile, row, comp = (np.array([h[k] for h in held], dtype=np.int64) for k in range(4))
    words = np.array([len(h[4]) for h in held])
    sketches = {w: np.stack([h[4] for h, k in zip(held, words.tolist(), strict=True) if k == w]) for w in np.unique(words).tolist()}
    place = np.zeros(len(held), dtype=np.int64)
    for w in sketches:
        place[words == w] = np.arange((words == w).sum())
    few = attempt is None or len(held) <= SMALL_KEY
    stop = np.searchsorted(n, n * 5 // 4, side="right")
    start = np.arange(1, len(held) + 1) if few else np.searchsorted(n * 5 // 4, n)
    order = np.arange(len(held)) if few else np.argsort(mix64(row.view(np.uint64) + np.uint64(attempt)))
    met = np.zeros(len(held), dtype=bool)
    for i in order.tolist():
        if met[i]:
            continue
        j = np.arange(start[i], stop[i])
        j = j[~met[j] & (comp[j] != comp[i]) & ((key[1] == key[2]) | (tile[j] != tile[i]))]
        for w in np.unique(words[j]).tolist():
            own = j[words[j] == w]
            x, y = held[i][4], sketches[w][place[own]]
            while y.shape[1] > len(x):
                y = y[:, :y.shape[1] // 2] ^ y[:, y.shape[1] // 2:]
            while len(x) > y.shape[1]:
                x = x[:len(x) // 2] ^ x[len(x) // 2:]
            near = own[9 * np.bitwise_count(y ^ x).sum(axis=1, dtype=np.int64) <= n[own] + n[i]]
            if len(near):
                out.append((np.full(len(near), row[i]), row[near]))
                met[near] = not few
    return out


def _set_nodes(texts: pa.Array) -> pa.Array:
    """The node of each text, null for empty sets."""
    return pa.array([set_hash(s) if len(s) else None for s in shingle_sets(*byte_view(texts))], pa.int64())


def one_per_component(docs: DataFrame) -> DataFrame:
    """The input rows that stay: of every component the row with the smallest id, null ids
    last; of its rows with this id the one with the smallest node, then text. Rows
    with the empty set stay.

    A row whose id is null or repeated is told by its id and node."""
    rows = materialize(_placed(docs, "doc_id", "text"), "jaccard-rows")
    several = rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("doc_id IS NULL OR n > 1")
    several = materialize(several.select(F.col("doc_id").alias("__id")), "jaccard-several")
    gone = rows.filter((F.col("n_shingles") > 0) & ~F.col("doc_id").eqNullSafe(F.col("component_id")))
    gone = materialize(gone.select(F.col("doc_id").alias("__id")).union(several).distinct(), "jaccard-gone")
    kept = docs.join(counted_broadcast(gone), F.col("doc_id").eqNullSafe(F.col("__id")), "left_anti")
    if several.isEmpty():
        return kept

    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "node")).alias("first")
    stay = rows.filter("n_shingles > 0").groupBy("component").agg(first).select("first.doc_id", "first.node")
    several = counted_broadcast(several)
    same = F.col("doc_id").eqNullSafe(F.col("__id"))
    stay = materialize(stay.join(several, same, "left_semi").toDF("__id", "__stays"), "jaccard-stay")
    marked = docs.join(several, same, "left_semi").withColumn("__node", F.arrow_udf(_set_nodes, "bigint")(text_bytes(F.col("text"))))
    marked = materialize(marked, "jaccard-marked")
    empty = marked.filter("__node IS NULL").select(*docs.columns)
    marked = marked.join(counted_broadcast(stay), same & (F.col("__node") == F.col("__stays")), "left_semi")
    row = F.min_by(F.struct(*docs.columns), F.coalesce("text", F.lit(""))).alias("row")
    return kept.union(empty).union(marked.groupBy("doc_id", "__node").agg(row).select("row.*"))
