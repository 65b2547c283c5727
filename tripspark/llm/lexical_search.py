"""The best documents for each query text by a lexical score (operator 12).

Method: the Best Position Algorithm. Each query term has an impact list: the
documents that hold it by falling share of the score. Lists are read from the
top, and every document met is looked up in the query's other lists at once
(direct access), which gives its score and marks its positions there as seen. A
list's best position is the end of its seen positions that follow one another
from the top, whether they were read or looked up; it is never above the last
position read and often far below it. No unseen document can score more than the
sum of the shares at the best positions, so reading stops when that sum is
strictly below the k-th score found (an equal one could win by its id).

Scale. Documents are read twice as rows and once as texts: the first pass counts
the terms of the queries in each whole text and writes these counts, from which
the corpus figures (N, L, df) are aggregated, combined before they are shuffled.
The second pass forms blocks of documents from these light rows; each block has
its own impact lists, so a term that all documents hold is spread over all
blocks. A task carries each query's k best from block to block, which lets later
blocks stop early, and gives only those k to the final ranking. Queries are
taken in groups of at most QUERY_TERMS terms; a group's words and weights are
the only data sent to all tasks. Memory is bounded by a block.

Cases. Null and empty texts have no terms; a query without terms, or none of
whose terms scores above 0, has no rows. Each row of the queries is a query, also
where it repeats an id; each row of the documents is a document. Documents
without an id rank behind equal scores with one. Empty tables give no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripspark.llm.common import materialize, python_stages, text_bytes

#: Distinct terms, or queries, of one group of queries.
QUERY_TERMS = 200_000
QUERY_ROWS = 20_000
#: A block of documents ends at this many postings (a document, a term) or documents.
BLOCK_POSTINGS, BLOCK_DOCS = 2_000_000, 32_768
#: Positions that are read of every list at first; each further round doubles them.
FIRST_DEPTH = 32
#: Long texts are cut into words by pieces of this many bytes.
PIECE = 4 << 20

#: A-Z become lower case; every other ASCII byte that is no letter or digit becomes a space.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text (UTF-8), in pieces: runs of ASCII letters and digits and of other characters, A-Z lower-cased."""
    folded, at = text.translate(_FOLD), 0
    while at < len(folded):
        end = len(folded) if len(folded) - at <= PIECE else folded.find(b" ", at + PIECE)
        end = len(folded) if end < 0 else end
        yield folded[at:end].split()
        at = end


def _count_terms(vocabulary: dict[bytes, int]):
    """For each document the number of its terms, and numbers and counts of those in the vocabulary."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = vocabulary.get
        for batch in batches:
            lengths, known, times = [], [], []
            for raw in batch.column(1):
                seen, n = Counter(), 0
                for words in terms(raw.as_py()):
                    n += len(words)
                    seen.update(words)
                hits = sorted((k, c) for w, c in seen.items() if (k := find(w)) is not None)
                lengths.append(n)
                known.append([k for k, _ in hits])
                times.append([c for _, c in hits])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lengths, pa.int64()), pa.array(known, pa.list_(pa.int32())),
                 pa.array(times, pa.list_(pa.int64()))], names=["doc_id", "n", "terms", "times"])
    return run


class Best:
    """The k best (score, document) of a query: highest score first, then the smallest id, those without an id last."""

    def __init__(self, k: int) -> None:
        self.k, self.rows = k, []

    def kth(self) -> int:
        """The score that a further document must reach; 0 while there are fewer than k."""
        return self.rows[-1][0] if len(self.rows) == self.k else 0

    def add(self, scores: np.ndarray, ids: list) -> None:
        least = self.kth()
        new = [(s, i) for s, i in zip(scores.tolist(), ids, strict=True) if s > 0 and s >= least]
        self.rows = sorted(self.rows + new, key=lambda r: (-r[0], r[1] is None, r[1] or 0))[:self.k]


class ImpactList:
    """A term's documents in a block by falling share of the score, and their positions by document."""

    def __init__(self, docs: np.ndarray, shares: np.ndarray) -> None:
        order = np.argsort(-shares, kind="stable")
        self.docs, self.shares = docs[order], shares[order]
        self.by_doc = docs  # ascending
        self.position = np.empty(len(docs), dtype=np.int64)
        self.position[order] = np.arange(len(docs))

    def look_up(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the documents are in the list, and the positions of those."""
        at = np.minimum(np.searchsorted(self.by_doc, docs), len(self.by_doc) - 1)
        there = self.by_doc[at] == docs
        return there, self.position[at[there]]


def best_positions(lists: list[tuple[ImpactList, int]], n_docs: int, best: Best, ids: list, first: int = FIRST_DEPTH) -> int:
    """Add a block's best documents to ``best``. ``lists`` has each query term's list and how often the query
    has the term. Returns the number of documents that were scored."""
    seen = [np.zeros(len(li.docs), dtype=bool) for li, _ in lists]
    upto = [0] * len(lists)
    met = np.zeros(n_docs, dtype=bool)
    begin, end = 0, first
    while True:
        heads = [li.docs[begin:end] for li, _ in lists]
        new = np.unique(np.concatenate(heads))
        new = new[~met[new]]
        met[new] = True
        scores = np.zeros(len(new), dtype=np.int64)
        for (li, times), marks in zip(lists, seen, strict=True):
            there, position = li.look_up(new)
            scores[there] += times * li.shares[position]
            marks[position] = True
        best.add(scores, [ids[d] for d in new.tolist()])
        bound = 0
        for j, ((li, times), marks) in enumerate(zip(lists, seen, strict=True)):
            rest = marks[upto[j]:]
            gap = int(np.argmin(rest)) if len(rest) else 0
            upto[j] += len(rest) if len(rest) and rest[gap] else gap
            if upto[j] < len(marks):  # a list whose positions are all seen has no unseen document
                bound += times * int(li.shares[max(upto[j] - 1, 0)])
        if bound < best.kth() or all(u == len(m) for u, m in zip(upto, seen, strict=True)):
            return int(met.sum())
        begin, end = end, 2 * end


def _blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[list, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, terms a document, document of each posting, its term, its count) of blocks of bounded size."""
    held, postings = [], 0

    def close():
        table = pa.Table.from_batches(held)
        flat = table.column("terms").combine_chunks()
        if isinstance(flat, pa.ChunkedArray):
            flat = flat.chunk(0)
        counts = flat.value_lengths().to_numpy(zero_copy_only=False)
        docs = np.repeat(np.arange(len(counts)), counts)
        times = pa.concat_arrays([c.flatten() for c in table.column("times").chunks])
        return (table.column("doc_id").to_pylist(), table.column("n").to_numpy(), docs,
                flat.flatten().to_numpy(zero_copy_only=False), times.to_numpy(zero_copy_only=False))

    rows = 0
    for batch in batches:
        if held and (rows + batch.num_rows > BLOCK_DOCS or postings > BLOCK_POSTINGS):
            yield close()
            held, postings, rows = [], 0, 0
        held.append(batch)
        rows += batch.num_rows
        postings += len(batch.column(2).flatten())
    if rows:
        yield close()


def _search(queries: list[Counter], weights: np.ndarray, n_all: int, length_all: int, k: int):
    """The k best documents of the partition for each query."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k) for _ in queries]
        for ids, lengths, docs, numbers, times in _blocks(batches):
            m = 75 + (25 * lengths * n_all) // max(length_all, 1)
            shares = weights[numbers] * ((1_000_000_000 * times) // (1000 * times + 12 * m[docs]))
            order = np.argsort(numbers, kind="stable")
            numbers, docs, shares = numbers[order], docs[order], shares[order]
            own, begins = np.unique(numbers, return_index=True)
            ends = [*begins[1:].tolist(), len(numbers)]
            lists = {t: ImpactList(docs[b:e], shares[b:e])
                     for t, b, e in zip(own.tolist(), begins.tolist(), ends, strict=True) if weights[t] > 0}
            for query, found in zip(queries, best, strict=True):
                mine = [(lists[t], c) for t, c in query.items() if t in lists]
                if mine:
                    best_positions(mine, len(ids), found, ids)
        rows = [(q, i, s) for q, found in enumerate(best) for s, i in found.rows]
        if rows:
            q, i, s = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(q, pa.int32()), pa.array(i, pa.int64()), pa.array(s, pa.int64())],
                                             names=["query", "doc_id", "score"])
    return run


def _groups(items: Iterable) -> Iterator[list[tuple[object, Counter]]]:
    """Queries (id, terms with their counts) in groups of bounded size."""
    group, size = [], 0
    for row in items:
        words = Counter()
        for piece in terms(bytes(row["t"])):
            words.update(piece)
        if not words:
            continue
        if group and (size + len(words) > QUERY_TERMS or len(group) == QUERY_ROWS):
            yield group
            group, size = [], 0
        group.append((row["item_id"], words))
        size += len(words)
    if group:
        yield group


def _search_group(docs: DataFrame, group: list[tuple[object, Counter]], k: int) -> DataFrame:
    spark = docs.sparkSession
    vocabulary = {w: i for i, w in enumerate(sorted({w for _, words in group for w in words}))}
    counted = materialize(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes(F.col("text")).alias("t"))
                          .mapInArrow(_count_terms(vocabulary), "doc_id bigint, n bigint, terms array<int>, times array<bigint>"),
                          "term-counts")
    figures = counted.agg(F.count_if(F.col("n") > 0).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("length")).first()
    df = np.zeros(len(vocabulary), dtype=np.int64)
    for r in counted.select(F.explode("terms").alias("term")).groupBy("term").count().toLocalIterator():
        df[r["term"]] = r["count"]  # a row for each term of the group at most
    n_all, length_all = int(figures["docs"]), int(figures["length"])
    weights = np.array([math.floor(1000 * math.log((2 * n_all + 2) / (2 * d + 1))) for d in df.tolist()], dtype=np.int64)
    queries = [Counter({vocabulary[w]: c for w, c in words.items()}) for _, words in group]
    found = counted.filter(F.size("terms") > 0).mapInArrow(_search(queries, weights, n_all, length_all, k),
                                                           "query int, doc_id bigint, score bigint")
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    names = spark.createDataFrame([(i, item) for i, (item, _) in enumerate(group)], "query int, item_id bigint")
    return ranked.join(F.broadcast(names), "query").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """item_id, rank, doc_id and score of the ``k`` best of ``docs`` (doc_id, text) for each of ``items`` (item_id, text)."""
    spark = docs.sparkSession
    python_stages(spark)
    out = spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), text_bytes(F.col("text")).alias("t"))
    for group in _groups(rows.toLocalIterator()):
        out = out.unionByName(_search_group(docs, group, k))
    return out
