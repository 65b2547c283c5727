"""What five text filters remove, in every order and as Shapley shares (operator 13).

Method. A document's failures are a bit mask of five conditions, and a part of
the table (a language) needs only the number of its documents under each mask.
From them all 32 coalitions of filters are tabulated: a coalition removes the
documents that fail one of its filters. The exact Shapley shares are the
solution of the constrained least squares problem over the coalitions: shares
that sum to what all filters remove, fitted to the removals of all others under
the Shapley kernel. Its normal equations are solved in rationals, so the sums
over all orders come out as whole numbers. The counts of a step of an order are
differences of two coalitions' removals.

Scale. Texts are read once, by built-in functions, for the four conditions that
a text decides alone and for its SHA-256 digest, which stands for the text from
then on. The fifth condition (an equal text under a smaller id) needs the least
id of each digest, an aggregate that is combined before it is shuffled, and a
join by id and digest: the rows of a group of copies have different ids, so a
group that holds a third of the table is spread like any other rows. The rest is
32 rows of counts a part.

Cases. A null text is empty: it has no words and fails A (and E behind a smaller
id). A null language is the empty part, as is an empty one. Rows without an id
never fail E and have no labels; they are not anyone's smaller id. Rows that
repeat an id are counted one by one; equal rows of one id don't fail E by each
other. A document is good (toxic) if any label row of its id says so. An empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction
from itertools import permutations
from math import comb, factorial

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripspark.llm.common import materialize, python_stages

FILTERS = "ABCDE"
_SPACES = " \t\n\x0b\x0c\r"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
COLUMNS = "part string, filter_order string, step int, kept bigint, removed bigint, redundant bigint, " \
          "unique_fails bigint, good_lost bigint, toxic_lost bigint, shapley bigint"


@dataclass(frozen=True)
class Limits:
    """A: fewer words than this. B: a smaller percentage of distinct words. C: a greater percentage of
    capitals A-Z. D: one of these characters."""
    words: int = 200
    distinct_percent: int = 50
    capitals_percent: int = 3
    marks: str = "[#$%&*|]"


def text_failures(text: Column, limits: Limits) -> Column:
    """Bits 0 to 3: conditions A to D, which a text decides alone."""
    inner = F.btrim(text, F.lit(_SPACES))
    words = F.split(inner, r"[\x20\x09-\x0D]+")
    n = F.when(inner == "", 0).otherwise(F.size(words))
    distinct = F.when(inner == "", 0).otherwise(F.size(F.array_distinct(words)))
    chars = F.length(text)
    capitals = chars - F.length(F.translate(text, _UPPER, ""))
    failed = [n < limits.words, 100 * distinct.cast("long") < limits.distinct_percent * n.cast("long"),
              100 * capitals.cast("long") > limits.capitals_percent * chars.cast("long"), text.rlike(limits.marks)]
    bits = [F.when(f, 1 << i).otherwise(0) for i, f in enumerate(failed)]
    return bits[0] + bits[1] + bits[2] + bits[3]


def failures(docs: DataFrame, labels: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """part, mask (bit i: condition i of FILTERS fails), good and toxic (0 or 1) of every document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    light = materialize(docs.select(
        F.col("doc_id").alias("id"), F.coalesce("lang", F.lit("")).alias("part"),
        text_failures(text, limits).alias("mask"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest")),
        "filter-failures")
    known = light.filter("id IS NOT NULL")
    first = known.groupBy("digest").agg(F.min("id").alias("id")).withColumn("first", F.lit(True))
    marks = (labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("id"))
             .agg(*[F.max(F.when(F.col(c) == 1, 1).otherwise(0)).alias(name)
                    for c, name in (("quality", "good"), ("toxic", "toxic"))]))
    copy = F.when(F.col("first").isNull(), 1 << 4).otherwise(0)
    told = (known.join(first, ["id", "digest"], "left").join(marks, "id", "left")
            .select("part", (F.col("mask") + copy).alias("mask"), F.coalesce("good", F.lit(0)).alias("good"),
                    F.coalesce("toxic", F.lit(0)).alias("toxic")))
    rest = light.filter("id IS NULL").select("part", "mask", F.lit(0).alias("good"), F.lit(0).alias("toxic"))
    return told.unionByName(rest)


def coalitions(failed: DataFrame, filters: int = len(FILTERS)) -> DataFrame:
    """For each part and each coalition of filters (a bit mask, the empty one included): the part's documents,
    and how many of all, the good and the toxic ones the coalition removes."""
    masks = failed.groupBy("part", "mask").agg(F.count("*").alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic"))
    each = masks.withColumn("coalition", F.explode(F.sequence(F.lit(0), F.lit((1 << filters) - 1))))
    hit = F.col("mask").bitwiseAND(F.col("coalition")) != 0
    return each.groupBy("part", "coalition").agg(
        F.sum("n").alias("docs"), *[F.sum(F.when(hit, F.col(c)).otherwise(0)).alias(f"removed_{c}") for c in ("n", "good", "toxic")])


def solve(rows: list[list[Fraction]]) -> list[Fraction]:
    """The solution of a regular linear system in rationals; each row ends with its right-hand side."""
    rows = [list(r) for r in rows]
    n = len(rows)
    for i in range(n):
        pivot = next(j for j in range(i, n) if rows[j][i])
        rows[i], rows[pivot] = rows[pivot], rows[i]
        rows[i] = [x / rows[i][i] for x in rows[i]]
        for j in range(n):
            if j != i and rows[j][i]:
                rows[j] = [x - rows[j][i] * y for x, y in zip(rows[j], rows[i], strict=True)]
    return [r[-1] for r in rows]


def shapley(value: dict[int, int], n: int) -> list[Fraction]:
    """Shapley values of a game given by the value of each coalition (bit mask; the empty one's is 0).

    Least squares over the proper coalitions under the Shapley kernel, with the shares bound to sum to the value
    of all: the last unknown is the multiplier of that condition."""
    pairs = [[Fraction(0)] * n for _ in range(n)]
    right = [Fraction(0)] * n
    for s in range(1, (1 << n) - 1):
        members = [i for i in range(n) if s >> i & 1]
        weight = Fraction(n - 1, comb(n, len(members)) * len(members) * (n - len(members)))
        for i in members:
            right[i] += weight * value[s]
            for j in members:
                pairs[i][j] += weight
    one = Fraction(1)
    rows = [[*pairs[i], one, right[i]] for i in range(n)] + [[one] * n + [Fraction(0), Fraction(value[(1 << n) - 1])]]
    return solve(rows)[:n]


def _orders(part: str, table: pd.DataFrame, filters: str) -> Iterator[tuple]:
    """The steps of all orders of the filters from the part's coalitions."""
    n, everything = len(filters), (1 << len(filters)) - 1
    lost = {name: dict(zip(table["coalition"].tolist(), table[f"removed_{name}"].tolist(), strict=True))
            for name in ("n", "good", "toxic")}
    removed, docs = lost["n"], int(table["docs"].iloc[0])
    shares = [s * factorial(n) for s in shapley(removed, n)]
    assert all(s.denominator == 1 for s in shares), "sums over all orders are whole numbers"
    for order in permutations(range(n)):
        name, before = "".join(filters[i] for i in order), 0
        for step, i in enumerate(order, 1):
            after = before | 1 << i
            here = removed[after] - removed[before]
            yield (part, name, step, docs - removed[after], here, removed[1 << i] - here,
                   removed[everything] - removed[everything & ~(1 << i)], lost["good"][after] - lost["good"][before],
                   lost["toxic"][after] - lost["toxic"][before], int(shares[i]))
            before = after


def interactions(table: DataFrame, filters: str = FILTERS) -> DataFrame:
    """A row for each part, order of the filters and step, from the parts' coalitions."""
    python_stages(table.sparkSession)
    names = [c.split()[0] for c in COLUMNS.split(", ")]

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(list(_orders(key[0], rows, filters)), columns=names)

    return table.groupBy("part").applyInPandas(run, COLUMNS)


def audit(docs: DataFrame, labels: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The steps of all 120 orders of the five filters over each language of ``docs``."""
    return interactions(coalitions(failures(docs, labels, limits)))
