from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept boolean, size string, node int"


def words(seed: int, n: int) -> list[str]:
    r = random.Random(seed)
    return ["".join(r.choice(["th", "er", "on", "an", "re", "he", "in", "ed"]) for _ in range(r.randint(1, 4)))
            for _ in range(n)]


def corpus() -> list[tuple]:
    """Texts with nulls, empty and very long ones, ties, repeated rows, copies and near copies."""
    rows: list[tuple] = []

    def add(text, source="s1", lang="en", doc_id="next"):
        rows.append((len(rows) if doc_id == "next" else doc_id, text, lang, source, None if text is None else len(text),
                     None, "clash", 7))

    base = [words(i, n) for i, n in enumerate((3, 5, 6, 12, 40, 80, 200, 300, 700, 5000))]
    for w in base:
        add(" ".join(w))
        add("\n".join(w).upper() if len(w) < 50 else " \t ".join(w))
        for k, edits in enumerate((1, 2, 6, 15)):
            v, r = list(w), random.Random(k)
            for _ in range(max(1, len(w) * edits // 100)):
                v[r.randrange(len(v))] = f"edit{r.randrange(10**6)}"
            add(" ".join(v), source=("s0", "s1", None, "Ş")[k])
    add(None)
    add(None, source=None, lang=None)
    add("")
    add(" \n\t ")
    add("one")
    add("one two")
    add("ONE  two")
    add("One\x0btwo", source="s9")
    add("\x85  x y", lang="xx")
    add("<|startoftext|> it's <|endoftext|>we'll 12 ΑΣ İ ﬁ é ẞ 漢字 !!?'s", source="s9")
    add(" ".join(base[4]), doc_id=3)
    add(" ".join(base[4]), doc_id=3)
    add(" ".join(base[5]), doc_id=None)
    add("no id here at all, none", doc_id=None)
    add("x" * 5000 + " long word " + "y" * 70)
    for _ in range(3):
        add("the very same row again and again", doc_id=500)
    return rows


@pytest.fixture(scope="session")
def docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "documents.parquet")
    spark.createDataFrame(corpus(), SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def sf_docs(spark, sf_small):
    return spark.read.parquet(f"{sf_small}/documents.parquet")
