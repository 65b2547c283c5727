from __future__ import annotations

import numpy as np
import pytest
from tokenizers import Tokenizer

from tripspark.llm import registry
from tripspark.llm import word_blocks as blocks
from tripspark.llm import word_bpe as op


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(registry.tokenizer_path())
    t.no_truncation()
    t.no_padding()
    return t


def want(tokenizer, texts):
    out = []
    for i, t in texts:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids
        out.append((i, ids, tokenizer.decode(ids, skip_special_tokens=False)))
    return sorted(out, key=str)


def got(df):
    return sorted(((r["doc_id"], np.frombuffer(r["ids"], np.uint32).tolist(), r["decoded"]) for r in df.collect()), key=str)


def rows(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_small_corpus_equals_the_library(docs, tokenizer):
    out = op.encode_words(docs, registry.tokenizer_path())
    assert got(out) == want(tokenizer, rows(docs))
    assert all(r["n_tokens"] * 4 == len(r["ids"]) for r in out.collect())


def test_table_equals_the_library_over_many_blocks(sf_docs, tokenizer, monkeypatch):
    assert got(op.encode_words(sf_docs, registry.tokenizer_path())) == want(tokenizer, rows(sf_docs))


ODD = ["", " ", "'", "''s", "don't'll 'S", "a'b'c", "  x　y", "ΟΔΟΣ ΣΑΣ Σ", "İstanbul ǅ Ǆ ᾳ ß ẞ", "ẹ́ Å Å K",
       "१२३ ½ ² Ⅻ", "<|startoftext|>", "<|startoftext|", "a<|endoftext|><|endoftext|> b<|ENDOFTEXT|>", "\x00\x01\x1c\x85|",
       "👩‍👩‍👧 🇩🇪", "한국어 漢字かな", "a" * 3000, "!?" * 700, "﻿​", "naïve Œuvre ĳ ŉ ſ", "__init__ x_1 2021-03-04"]


def test_odd_texts_equal_the_library(spark, tokenizer, tmp_path):
    data = list(enumerate(ODD)) + [(900, None), (901, ODD[4]), (901, ODD[4])]
    df = spark.createDataFrame(data, "doc_id long, text string")
    assert got(op.encode_words(df, registry.tokenizer_path())) == want(tokenizer, data)


def test_blocks_of_one_row_and_equal_blocks(spark, tokenizer, monkeypatch):
    """Equal rows in blocks of their own share a key; a longer text is a block by itself."""
    rows_ = [(i, "the same words") for i in range(20)] + [(50, "other words"), (51, "x " * 300)]
    path = registry.tokenizer_path()
    batches = [__import__("pyarrow").RecordBatch.from_pydict({"c0": [i], "t": [t.encode()]}) for i, t in rows_]
    monkeypatch.setattr(op, "BLOCK_BYTES", 10)
    keys = [b[0] for b in op._blocks(iter(batches))]
    assert len(keys) == 22 and len(set(keys)) == 3
    df = spark.createDataFrame(rows_, "doc_id long, text string")
    assert got(op.encode_words(df, path)) == want(tokenizer, rows_)


def test_empty_table(empty_docs):
    out = op.encode_words(empty_docs, registry.tokenizer_path())
    assert out.columns == ["doc_id", "n_tokens", "ids", "decoded"] and out.count() == 0


def test_word_wise_tokenizers_are_told_from_others(tokenizer):
    op.check_word_wise(tokenizer)
    import public_tokenizers

    with pytest.raises(ValueError):
        op.check_word_wise(Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")))


def test_numbers_beyond_16_bits(spark, tokenizer):
    many = " ".join(f"w{i}" for i in range(70_000))
    df = spark.createDataFrame([(1, many), (2, "w69999 w1 w65536")], "doc_id long, text string").coalesce(1)
    assert got(op.encode_words(df, registry.tokenizer_path())) == want(tokenizer, [(1, many), (2, "w69999 w1 w65536")])


SPACES = ["\t", "\n", "\x0b", "\x0c", "\r", " ", "\x85", "\xa0", "\u1680", *map(chr, range(0x2000, 0x200B)), "\u2028", "\u2029",
          "\u202f", "\u205f", "\u3000"]


@pytest.mark.parametrize("chunk", [1, 7, 64, 1 << 20])
def test_blocks_hold_the_words_in_order(monkeypatch, chunk):
    """Numbers and distinct words of a block give back every row's words, however the texts are cut."""
    monkeypatch.setattr(blocks, "CHUNK_BYTES", chunk)
    texts = ["", " ", "a b a", "\u2000".join("xyzx"), "".join(f"w{i}{s}" for i, s in enumerate(SPACES)), "\x1c \x1f\u200b x\x85",
             "é ê é \u00c2 \u2080", "x" * 200 + " " + "x" * 199 + "y " + "x" * 200, "one", "two\n" * 50, "\ufffd"]
    block = blocks.WordBlock()
    for t in texts:
        block.add(t.encode())
    order, bucket = block.close(5)
    words = [w for _, joined in block.lists(order, bucket) for w in joined.decode().split(" ")]
    assert len(set(words)) == len(words) == len(order) and (np.diff(bucket) >= 0).all()
    by_number = dict(zip(order.tolist(), words, strict=True))
    assert [[by_number[n] for n in row.tolist()] for row in block.numbers()] == [op.split(t) for t in texts]


def test_words_whose_first_hashes_agree(monkeypatch):
    """Words are told apart by the second hash if the first one does not."""
    real = blocks._hashes
    monkeypatch.setattr(blocks, "_hashes", lambda *a: [real(*a)[0] % np.uint64(2), real(*a)[1]])
    monkeypatch.setattr(blocks, "CHUNK_BYTES", 40)
    texts = [" ".join(f"w{(i * j) % 23}" for j in range(30)) for i in range(9)]
    block = blocks.WordBlock()
    for t in texts:
        block.add(t.encode())
    order, bucket = block.close(3)
    words = [w for _, joined in block.lists(order, bucket) for w in joined.decode().split(" ")]
    by_number = dict(zip(order.tolist(), words, strict=True))
    assert len(words) == 23 and [[by_number[n] for n in row.tolist()] for row in block.numbers()] == [t.split() for t in texts]


def test_bytes_that_are_no_utf8(spark, tokenizer):
    df = spark.createDataFrame([(1, b"ab \xff\xe2\x80 c\xc2")], "doc_id long, raw binary").selectExpr("doc_id", "CAST(raw AS string) AS text")
    assert got(op.encode_words(df, registry.tokenizer_path())) == want(tokenizer, [(1, "ab \ufffd\ufffd c\ufffd")])


def test_long_rows_are_joined_in_parts(spark, tokenizer, monkeypatch):
    monkeypatch.setattr(op, "JOIN_WORDS", 10)
    rows_ = [(i, " ".join(f"Word{j % (i + 3)}" for j in range(i * 7))) for i in range(12)]
    batches = [__import__("pyarrow").RecordBatch.from_pydict({"c0": [i], "t": [t.encode()]}) for i, t in rows_]
    asked = list(op._ask(3)(iter(batches)))
    known = __import__("pyarrow").Table.from_batches(list(op._encode(registry.tokenizer_path())(iter(asked))))
    nothing = __import__("pyarrow").nulls(known.num_rows, "int64")
    given = [b for t in (known.append_column("c0", nothing),) for b in t.to_batches()]
    numbered = list(op._numbered(3)(iter(batches)))
    out = list(op._join(registry.tokenizer_path(), 1)(iter([numbered[0], *given, *numbered[1:]])))
    seen = sorted((i, np.frombuffer(raw, np.uint32).tolist(), d) for b in out for i, raw, d in zip(
        b.column(0).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist()))
    assert seen == want(tokenizer, rows_) or sorted(seen, key=str) == want(tokenizer, rows_)
