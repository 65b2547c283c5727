"""Language identification by cross-parsing (operator 10).

Method. For each language, a suffix automaton is built over labelled text. A
text is parsed greedily against it: a phrase is the longest match with the
training text from where the last one ended. The language that needs the fewest
phrases per byte wins; the lead over the second gives the score.

Training takes, per language, the ``rows`` labelled documents with the smallest
hashes of their ids and one piece of ``chars`` characters of each, so the model
does not grow with the data. The driver holds only these pieces; each Python
worker builds the automata from them once. Every text is parsed whole: it is cut
into lanes of LANE bytes that run side by side through the automaton's
transition table, and the lanes' phrases are added up. One narrow pass, no
shuffle.

Text is lower-cased; bytes other than ASCII letters and those of non-ASCII
characters count as spaces.

Cases. A text that is null or has no letter is ``und`` with score 0, as is every
text if no language was learned. With one language learned the score is 1. Ties
go to the first language in code point order. An empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripspark.llm.common import as_text, held_out, python_stages

UNKNOWN = "und"
TRAIN_ROWS, TRAIN_CHARS = 80, 400
LANE = 512
#: Bytes of lanes parsed together.
TOGETHER = 1 << 21

_CLASS = np.full(256, 0x20, dtype=np.uint8)
_CLASS[0x61:0x7B] = np.arange(0x61, 0x7B)
_CLASS[0x80:] = np.arange(0x80, 0x100)


def symbols(text: str) -> np.ndarray:
    return _CLASS[np.frombuffer(text.lower().encode("utf-8", errors="replace"), dtype=np.uint8)]


class SuffixAutomaton:
    """The minimal automaton of all substrings of the given texts."""

    def __init__(self, texts: list[np.ndarray]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        last = 0
        for k, text in enumerate(texts):
            for c in text.tolist():
                last = self._extend(last, c)
            last = self._extend(last, 256 + k)  # a border that no text contains
        del texts

    def _extend(self, last: int, c: int) -> int:
        new = len(self.next)
        self.next.append({})
        self.length.append(self.length[last] + 1)
        self.link.append(0)
        p = last
        while p != -1 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        if p != -1:
            q = self.next[p][c]
            if self.length[p] + 1 == self.length[q]:
                self.link[new] = q
            else:
                copy = len(self.next)
                self.next.append(dict(self.next[q]))
                self.length.append(self.length[p] + 1)
                self.link.append(self.link[q])
                while p != -1 and self.next[p].get(c) == q:
                    self.next[p][c] = copy
                    p = self.link[p]
                self.link[q] = self.link[new] = copy
        return new

    def table(self, alphabet: np.ndarray) -> np.ndarray:
        """Flat transitions for the greedy parse: entry [state * width + symbol] holds
        4 * next state * width plus the number of phrases that end: the one before a
        symbol that doesn't go on, and a symbol that the training text lacks. Symbol
        ``width - 2`` is such a byte, ``width - 1`` leaves all as it is."""
        width = int(alphabet.max()) + 2
        state, symbol, to = [], [], []
        for s, edges in enumerate(self.next):
            for c, t in edges.items():
                if c < 256:
                    state.append(s)
                    symbol.append(alphabet[c])
                    to.append(t)
        out = np.full((len(self.next), width), 2, dtype=np.int64)
        out[0] = 1
        for c, t in self.next[0].items():
            if c < 256:
                out[:, alphabet[c]] = 4 * t * width + 1
        out[state, symbol] = 4 * np.array(to, dtype=np.int64) * width
        out[:, width - 1] = 4 * np.arange(len(self.next)) * width
        return out.astype(np.int32).ravel()


class Model:
    """Languages with their training pieces; automata and tables are built on first use."""

    def __init__(self, pieces: dict[str, list[str]]):
        self.pieces = {k: pieces[k] for k in sorted(pieces)}
        self.languages = list(self.pieces)

    def build(self) -> tuple[np.ndarray, list[np.ndarray]]:
        texts = {k: [symbols(t) for t in v] for k, v in self.pieces.items()}
        seen = np.unique(np.concatenate([t for v in texts.values() for t in v] or [np.zeros(0, np.uint8)]))
        alphabet = np.full(257, len(seen), dtype=np.int32)
        alphabet[seen] = np.arange(len(seen))
        return alphabet, [SuffixAutomaton(v).table(alphabet) for v in texts.values()]


def phrases(lanes: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Phrases of each column of ``lanes`` (symbols, one step a row)."""
    state = np.zeros(lanes.shape[1], dtype=np.int32)
    count = np.zeros_like(state)
    value = np.empty_like(state)
    for step in lanes:
        np.add(state, step, out=state)
        np.take(table, state, out=value)
        np.bitwise_and(value, 3, out=state)
        count += state
        np.right_shift(value, 2, out=state)
    return count + (state != 0)


_built: dict[int, tuple] = {}


def _count(texts: list[str], model: Model) -> np.ndarray:
    """Phrases of each text (rows) for each language (columns)."""
    key = hash(tuple((k, tuple(v)) for k, v in model.pieces.items()))
    if key not in _built:
        _built.clear()
        _built[key] = model.build()
    alphabet, tables = _built[key]
    width = int(alphabet.max()) + 2
    out = np.zeros((len(texts), len(tables)), dtype=np.int64)

    def flush(owner: list[int], pieces: list[np.ndarray]) -> None:
        lanes = np.full((len(pieces), LANE), width - 1, dtype=np.int32)
        for row, p in zip(lanes, pieces, strict=True):
            row[:len(p)] = alphabet[p]
        lanes = np.ascontiguousarray(lanes.T)
        for k, table in enumerate(tables):
            np.add.at(out[:, k], owner, phrases(lanes, table))

    owner: list[int] = []
    pieces: list[np.ndarray] = []
    for i, text in enumerate(texts):
        s = symbols(text)
        for at in range(0, len(s), LANE):
            owner.append(i)
            pieces.append(s[at:at + LANE])
            if len(pieces) * LANE >= TOGETHER:
                flush(owner, pieces)
                owner, pieces = [], []
    if pieces:
        flush(owner, pieces)
    return out


def _predict(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [as_text(t.as_py()) for t in batch.column(batch.num_columns - 1)]
            known = [any(map(str.isalpha, t)) for t in texts]
            languages, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
            if model.languages:
                own = [i for i, k in enumerate(known) if k]
                counts = _count([texts[i] for i in own], model)
                for i, row in zip(own, counts, strict=True):
                    best = int(np.argmin(row))
                    second = np.partition(row, 1)[1] if len(row) > 1 else 0
                    languages[i] = model.languages[best]
                    scores[i] = 1.0 if len(row) == 1 else float(1 - row[best] / second)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(j) for j in range(batch.num_columns - 1)], pa.array(languages, pa.string()),
                 pa.array(scores, pa.float64())],
                names=[*batch.schema.names[:-1], "lang_pred", "score"])
    return run


def fit(docs: DataFrame, rows: int = TRAIN_ROWS, chars: int = TRAIN_CHARS) -> Model:
    """Train on documents with a language that are not held out."""
    spark = docs.sparkSession
    python_stages(spark)
    known = docs.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))
                        & F.col("text").rlike(r"\p{L}"))
    first = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    picked = (known.select("lang", "doc_id").withColumn("n", F.row_number().over(first)).filter(F.col("n") <= rows)
              .select(F.col("lang").alias("of"), F.col("doc_id").alias("id")).distinct())
    start = 1 + F.pmod(F.xxhash64("doc_id", F.lit(3)), F.greatest(F.lit(1), F.length("text") - chars + 1)).cast("int")
    found = (known.join(F.broadcast(picked), (F.col("lang") == F.col("of")) & (F.col("doc_id") == F.col("id")))
             .select("lang", "doc_id", F.substr("text", start, F.lit(chars)).alias("piece")))
    pieces: dict[str, list[str]] = {}
    for r in sorted(found.collect(), key=lambda r: (r["lang"], r["doc_id"], r["piece"])):
        pieces.setdefault(r["lang"], []).append(r["piece"])
    return Model({k: v[:rows] for k, v in pieces.items()})


def identify(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """The columns ``keep`` of every row with lang_pred and score added."""
    python_stages(docs.sparkSession)
    given = docs.select(*[F.col(n).alias(f"c{i}") for i, n in enumerate(keep)], F.col(text_col).cast("binary").alias("t"))
    columns = "".join(f"c{i} {given.schema[f'c{i}'].dataType.simpleString()}, " for i in range(len(keep)))
    out = given.mapInArrow(_predict(model), f"{columns}lang_pred string, score double")
    return out.select(*[F.col(f"c{i}").alias(n) for i, n in enumerate(keep)], "lang_pred", "score")
