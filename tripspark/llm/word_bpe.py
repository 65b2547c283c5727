"""BPE encoding and decoding through a distinct-word table (operator 8).

Method. Texts are split at white space, which no token of this kind of tokenizer
crosses: its normaliser and pre-tokenizer work within words, and its special
strings hold no white space. Rows are gathered into blocks of bounded size; a
block emits its distinct words, dealt by a hash of the word, and its rows as
numbers of words. Where equal words of all blocks meet, each is encoded once:
the distinct-word table. Its ids go back to the blocks that asked, and are joined
to the rows by position. Decoding joins ids to the vocabulary's pieces, once for
each distinct word of a block. ``check_word_wise`` tells whether a tokenizer
file has the parts that this rests on.

A block keeps its distinct words' bytes once and four bytes for each word of its
texts (``word_blocks``); the texts themselves pass by, a batch at a time.

Scale. Nothing is broadcast but the tokenizer's path. Shuffled are a block's
distinct words (a row for each bucket), their ids, and two to three bytes for
each word of a text; texts are not. Buckets are even whatever word is frequent,
as a block sends each word once. A block holds BLOCK_BYTES of text or a single
longer one. A block's key is a digest of its texts, so equal blocks may share
their words' ids. Both passes over the texts must form the same blocks, which
they do over stable input such as Parquet files; other input fails with an
error, not with wrong ids.

Cases. Null text is empty: no ids and an empty decoded text. Rows that repeat,
also with the same id, are encoded row by row. An empty table gives an empty
result.
"""

from __future__ import annotations

import os
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tripspark.llm.common import as_text, python_stages, text_bytes, tidy
from tripspark.llm.word_blocks import WordBlock, gather

BLOCK_BYTES = 16 << 20
#: Words whose ids or pieces are gathered at a time.
JOIN_WORDS = 1 << 17
#: Distinct words are dealt to this many buckets for each shuffle partition, MAX_BUCKETS at most.
BUCKETS_PER_PARTITION, MAX_BUCKETS = 8, 1 << 16
#: Bytes of ids in one Arrow batch of the result, beyond which it is closed.
OUTPUT_BYTES = 8 << 20
#: In the order of a block's records: its words' numbers, the ids of its buckets, its rows.
_FIRST, _LAST = -1, 2**31 - 1

#: White space as the tokenizer's patterns have it. Python's own split() also cuts at the four
#: control characters in _NOT_SPACE.
_SPACE = regex.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
_NOT_SPACE = regex.compile(r"[\x1c-\x1f]")

_tokenizers: dict[str, Tokenizer] = {}


def load(path: str) -> Tokenizer:
    """The tokenizer without truncation and padding, once for each process. It keeps to the thread that
    asks: a task has one core, and the memory of further threads would stay with the worker."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    if path not in _tokenizers:
        t = Tokenizer.from_file(path)
        t.no_truncation()
        t.no_padding()
        _tokenizers[path] = t
    return _tokenizers[path]


def check_word_wise(tokenizer: Tokenizer) -> None:
    """Raise if white space could be part of a token or change one."""
    probe = "Aa bb\t\n cc.dd  \u3000ee's"
    ids = [i for w in split(probe) for i in tokenizer.encode(w, add_special_tokens=False).ids]
    special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    if ids != tokenizer.encode(probe, add_special_tokens=False).ids or any(_SPACE.search(s) for s in special):
        raise ValueError("this tokenizer does not encode texts word by word")
    if tokenizer.decoder is not None:
        raise ValueError("this tokenizer's decoder is not a join of its pieces")


def split(text: str) -> list[str]:
    if _NOT_SPACE.search(text) is None:
        return text.split()
    return [w for w in _SPACE.split(text) if w]


def _blocks(batches: Iterator[pa.RecordBatch]):
    """Blocks of rows: (key, block of words, the batches' parts that hold the rows' key columns)."""
    block, size, digest = WordBlock(), 0, xxhash.xxh3_128()
    kept: list[pa.RecordBatch] = []

    for batch in batches:
        begin, keys = 0, batch.select(list(range(batch.num_columns - 1)))
        for i, raw in enumerate(batch.column(batch.num_columns - 1)):
            raw = valid_utf8(raw.as_py())
            if block.rows and size + len(raw) > BLOCK_BYTES:
                kept.append(keys.slice(begin, i - begin))
                full = [(digest.hexdigest(), block, kept)]
                del block, kept  # the caller lets go of a block before it asks for the next one
                yield full.pop()
                block, size, digest, kept, begin = WordBlock(), 0, xxhash.xxh3_128(), [], i
            size += len(raw)
            digest.update(len(raw).to_bytes(8, "little") + raw)
            block.add(raw)
        kept.append(keys.slice(begin))
    if block.rows:
        yield digest.hexdigest(), block, kept


def valid_utf8(raw: bytes) -> bytes:
    """The bytes themselves if they are UTF-8; otherwise with U+FFFD for what is not."""
    try:
        raw.decode()
    except UnicodeDecodeError:
        return as_text(raw).encode()
    return raw


def _ask(buckets: int):
    """The words of each block, a row for each bucket that has some; words are joined by spaces."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, block, _ in _blocks(batches):
            order, bucket = block.close(buckets)
            own, lists = [], []
            for b, joined in block.lists(order, bucket):
                own.append(b)
                lists.append(joined)
            yield pa.RecordBatch.from_arrays(
                [pa.array([f"{len(order)}-{key}"] * len(own), pa.string()), pa.array(own, pa.int32()),
                 pa.array(lists, pa.binary()).cast(pa.string())], names=["block", "bucket", "words"])
            del block, lists  # before the next block is formed
    return run


def _id_type(tokenizer: Tokenizer) -> type:
    return np.uint16 if max(tokenizer.get_vocab(with_added_tokens=True).values()) < 1 << 16 else np.uint32


def _encode(path: str):
    """The distinct-word table of each bucket, whose rows arrive together: a word is encoded when
    it is first seen, and every block gets its words' ids and how many each word has."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, bucket, table = load(path), None, {}
        kind = _id_type(tokenizer)
        for batch in batches:
            ids, lengths = [], []
            for at, joined in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if at != bucket:
                    bucket, table = at, {}
                words = joined.split(" ")
                new = [w for w in words if w not in table]
                for w, e in zip(new, tokenizer.encode_batch(new, add_special_tokens=False), strict=True):
                    table[w] = array("H" if kind is np.uint16 else "I", e.ids)
                found = [table[w] for w in words]
                ids.append(b"".join(found))
                lengths.append(array("i", map(len, found)).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ids, pa.binary()),
                                              pa.array(lengths, pa.binary())], names=["block", "bucket", "low", "high"])
    return run


def _numbered(buckets: int):
    """Each block's numbers in the order of its words, then its rows as words' numbers. Numbers are
    written as two planes, the low 16 bits and the high ones, as most of the latter are zero."""
    def planes(numbers: np.ndarray) -> tuple[bytes, bytes]:
        return numbers.astype(np.uint16).tobytes(), (numbers >> 16).astype(np.uint16).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for digest, block, kept in _blocks(batches):
            order, _ = block.close(buckets)
            key = f"{len(order)}-{digest}"
            names, kinds = kept[0].schema.names, kept[0].schema.types

            def record(at: int, parts: list[tuple[bytes, bytes]], columns: list[pa.Array]) -> pa.RecordBatch:
                low, high = zip(*parts, strict=True)
                return pa.RecordBatch.from_arrays(
                    [pa.array([key] * len(parts)), pa.array([at] * len(parts), pa.int32()), pa.array(low, pa.binary()),
                     pa.array(high, pa.binary()), *columns], names=["block", "bucket", "low", "high", *names])

            yield record(_FIRST, [planes(order)], [pa.nulls(1, k) for k in kinds])
            rows = block.numbers()
            for part in kept:
                if part.num_rows:
                    yield record(_LAST, [planes(next(rows)) for _ in range(part.num_rows)], part.columns)
            del block, kept, rows  # before the next block is formed
    return run


def _join(path: str, columns: int):
    """Blocks in order: the numbers of their words, the words' ids by bucket, then the rows."""
    def numbers(low: bytes, high: bytes) -> np.ndarray:
        return np.frombuffer(low, np.uint16) + (np.frombuffer(high, np.uint16).astype(np.int32) << 16)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = load(path)
        kind = _id_type(tokenizer)
        vocabulary = tokenizer.get_vocab(with_added_tokens=True)
        pieces = _Strings.of([p for p, _ in sorted(vocabulary.items(), key=lambda x: x[1])], sorted(vocabulary.values()))
        block, last, order, found, ids, decoded = None, None, None, [], None, None
        for batch in batches:
            id_out, text_out, rows, size = [], [], [], 0

            def packed():
                kept = batch.take(pa.array(rows, pa.int32()))
                return pa.RecordBatch.from_arrays(
                    [*[kept.column(4 + j) for j in range(columns)], pa.array([len(r) // 4 for r in id_out], pa.int64()),
                     pa.array(id_out, pa.binary()), pa.array(text_out, pa.binary()).cast(pa.string())],
                    names=[f"c{j}" for j in range(columns)] + ["n_tokens", "ids", "decoded"])

            low, high = batch.column(2), batch.column(3)
            for i, (key, at) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
                if key != block:
                    block, last, order, found, ids, decoded = key, None, None, [], None, None
                if at == _FIRST:
                    order = numbers(low[i].as_py(), high[i].as_py())
                    continue
                if at != _LAST:
                    if at != last:  # an equal block asks for the same words again
                        found.append((low[i].as_py(), high[i].as_py()))
                    last = at
                    continue
                if ids is None:
                    ids, decoded = _by_number(key, order, found, kind, pieces)
                    found = []
                take = numbers(low[i].as_py(), high[i].as_py())
                id_out.append(ids.join(take))
                text_out.append(decoded.join(take[decoded.lengths[take] > 0]).removesuffix(b" "))
                rows.append(i)
                size += len(id_out[-1]) + len(text_out[-1])
                if size > OUTPUT_BYTES:
                    yield packed()
                    id_out, text_out, rows, size = [], [], [], 0
            if rows:
                yield packed()
    return run


class _Strings:
    """Byte strings by number, in one buffer."""

    def __init__(self, flat: np.ndarray, lengths: np.ndarray) -> None:
        self.flat, self.lengths = flat, lengths
        self.begins = np.cumsum(lengths, dtype=np.int64) - lengths

    @classmethod
    def of(cls, strings: list[str], numbers: list[int]) -> _Strings:
        """Each string with a space behind it, under the given ascending numbers."""
        raw = [s.encode() + b" " for s in strings]
        lengths = np.zeros(numbers[-1] + 1 if numbers else 0, dtype=np.int64)
        lengths[numbers] = [len(r) for r in raw]
        return cls(np.frombuffer(b"".join(raw), np.uint8), lengths)

    def join(self, numbers: np.ndarray) -> bytes:
        """The concatenated strings, gathered JOIN_WORDS at a time."""
        parts = [gather(self.flat, self.begins[n], self.lengths[n]).tobytes()
                 for n in (numbers[i:i + JOIN_WORDS] for i in range(0, len(numbers), JOIN_WORDS))]
        return parts[0] if len(parts) == 1 else b"".join(parts)

    def reordered(self, places: np.ndarray) -> _Strings:
        """The strings under other numbers: the i-th one gets number ``places[i]``."""
        back = np.empty(len(places), dtype=np.int64)
        back[places] = np.arange(len(places))
        return _Strings(np.frombuffer(self.join(back), np.uint8), self.lengths[back])


def _by_number(key: str, order: np.ndarray, found: list[tuple[bytes, bytes]], kind: type, pieces: _Strings):
    """The ids (bytes) and decoded pieces (each with a space behind it) of a block's words, by the words' numbers."""
    flat = np.frombuffer(b"".join(i for i, _ in found), kind)
    lengths = np.frombuffer(b"".join(n for _, n in found), np.int32).astype(np.int64)
    if len(lengths) != int(key.split("-")[0]) or order is None or len(order) != len(lengths):
        raise RuntimeError("the input's rows changed between two passes; write them to a table first")
    ids = _Strings(np.frombuffer(flat.astype("<u4").tobytes(), np.uint8), 4 * lengths)
    bounds = np.concatenate([[0], np.cumsum(pieces.lengths[flat])])
    ends = np.cumsum(lengths)
    decoded = _Strings(np.frombuffer(pieces.join(flat), np.uint8), bounds[ends] - bounds[ends - lengths])
    return ids.reordered(order), decoded.reordered(order)


def encode_words(docs: DataFrame, path: str, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """The columns ``keep`` of every row with n_tokens, ids (little-endian unsigned
    32-bit integers) and decoded (the text decoded from the ids) added.

    ``path`` names the tokenizer file on every machine."""
    spark = docs.sparkSession
    python_stages(spark)
    check_word_wise(load(path))
    buckets = min(MAX_BUCKETS, BUCKETS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions")))
    given = docs.select(*[F.col(n).alias(f"c{i}") for i, n in enumerate(keep)], text_bytes(F.col(text_col)).alias("t"))
    types = [given.schema[f"c{i}"].dataType.simpleString() for i in range(len(keep))]
    columns = "".join(f", c{i} {t}" for i, t in enumerate(types))
    asked = given.select("t").mapInArrow(tidy(_ask(buckets)), "block string, bucket int, words string")
    known = (asked.repartition("bucket").sortWithinPartitions("bucket")
             .mapInArrow(tidy(_encode(path)), "block string, bucket int, low binary, high binary"))
    known = known.select("*", *[F.lit(None).cast(t).alias(f"c{i}") for i, t in enumerate(types)])
    rows = given.mapInArrow(tidy(_numbered(buckets)), f"block string, bucket int, low binary, high binary{columns}")
    both = known.unionByName(rows).repartition("block").sortWithinPartitions("block", "bucket")
    out = both.mapInArrow(tidy(_join(path, len(keep))), f"{columns[2:]}{', ' if columns else ''}n_tokens bigint, ids binary, decoded string")
    return out.select(*[F.col(f"c{i}").alias(n) for i, n in enumerate(keep)], "n_tokens", "ids", "decoded")
