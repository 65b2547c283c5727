"""Toxicity scores from misspelled lexicon terms in their context (operator 11).

Method. A lexicon is learned from labelled text: whole words and stems that occur
in far more toxic than clean rows. The Levenshtein automata of its terms,
intersected with its trie (``fuzzy_lexicon``), find the terms in every text, also
misspelled ones. Each hit has a weight, learned for the term and the number of
edits; a context window around it adds what the words there say (words that stand
by hits in toxic rows, or by hits in clean ones), and takes away if the hit stands
between quotation marks, as what is quoted is not said. A logistic curve over the
strongest hit, the sum of all and the text's length gives the score.

Bounds. Training uses ``rows`` labelled rows of each class that are not held out,
taken in the order of a hash of their id; half of them give the lexicon, half the
weights. The driver gets at most ``candidates`` prefixes, a row for each term,
edits and context word, and three numbers for each training row. Scoring covers
every row and whole text in one narrow pass without a shuffle; the model (the
automaton's table) has a bounded number of terms. Texts beyond PIECE characters
are matched by pieces cut between words; a context window ends at its piece.

Cases. Null and empty texts get the score of a text without hits. Labels that are
null or contradict one another are not learned from; of the rows that repeat a
labelled id one text is learned from. Without labelled rows of both classes every
text gets the same score, the smoothed share of label 1. An empty table gives an
empty result.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripspark.llm.common import materialize, python_stages
from tripspark.llm.fuzzy_lexicon import Automaton, Term, TooManyStates, fold

#: A document is predicted toxic from this score on.
THRESHOLD = 0.7
#: Characters of texts that are matched together.
PIECE = 2 << 20
#: Quotation marks open and close by turns within a line.
_QUOTES = regex.compile('["«»‘‚“”„‹›「」]')
_QUOTED = regex.compile(rf"{_QUOTES.pattern}[^\n{_QUOTES.pattern[1:]}*{_QUOTES.pattern}")
_SPACE = regex.compile(r"\s")
_WORD_END = "$"


@dataclass(frozen=True)
class Training:
    """Parameters of the fit; ``rows`` bounds the sample of each class."""
    rows: int = 6000
    candidates: int = 20_000
    #: Terms of the lexicon and states of its automaton at most.
    terms: int = 300
    states: int = 50_000
    #: Least rows with a term, and the least square root of the likelihood ratio statistic.
    support: int = 3
    evidence: float = 3.2
    #: Letters of a stem at least, and of a whole word.
    stem_letters: int = 4
    word_letters: int = 3
    #: Terms with fewer letters allow no edit, one edit; longer ones two.
    one_edit_letters: int = 5
    two_edit_letters: int = 9
    #: Words of context on either side.
    window: int = 6
    context_words: int = 2000
    #: What a quotation takes from a hit as long as the labels say nothing else.
    quoted: float = -1.0


@dataclass(frozen=True)
class ToxicityModel:
    automaton: Automaton
    #: By term and number of edits.
    weights: np.ndarray
    context: dict[str, float] = field(default_factory=dict)
    quoted: float = 0.0
    #: Of the strongest hit, the logarithm of the hits' sum and of the number of words, and the constant.
    curve: tuple[float, float, float, float] = (0.0, 0.0, 0.0, 0.0)
    training: Training = Training()

    def features(self, text: str) -> tuple[float, float, float]:
        """Strongest hit, logarithm of the sum of hits, logarithm of the number of words."""
        strongest, total, words = 0.0, 0.0, 0
        for n, hits in find_hits(self.automaton, text, self.training.window):
            words += n
            for term, edits, quoted, near in hits:
                said = self.weights[term, edits] + (self.quoted if quoted else 0.0)
                if self.context:
                    said += sum(self.context.get(w, 0.0) for w in near) / max(1, len(near))
                if said > 0:
                    strongest, total = max(strongest, said), total + said
        return strongest, math.log1p(total), math.log1p(words)

    def score(self, features: tuple[float, float, float]) -> float:
        z = sum(c * f for c, f in zip(self.curve, (*features, 1.0), strict=True))
        return 1 / (1 + math.exp(-z)) if z >= 0 else math.exp(z) / (1 + math.exp(z))


def held_out(doc_id: Column) -> Column:
    """crc32(doc_id as text) mod 3 is 1; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def pieces(text: str) -> Iterator[str]:
    """A text cut at white space into pieces of about PIECE characters."""
    at = 0
    while len(text) - at > PIECE:
        space = _SPACE.search(text, at + PIECE)
        if space is None:
            break
        yield text[at:space.end()]
        at = space.end()
    yield text[at:] if at else text


def find_hits(automaton: Automaton, text: str, window: int) -> Iterator[tuple[int, list[tuple[int, int, bool, list[str]]]]]:
    """For each piece of a text its number of words and its hits: (term, edits, quoted, words of the window)."""
    for part in pieces(text):
        begins, ends, outcome = automaton.match(part)
        hits = []
        marks, lines = None, None
        for i in np.flatnonzero(outcome >= 0).tolist():
            if marks is None:
                marks = np.array([m.start() for m in _QUOTES.finditer(part)], dtype=np.int64)
                lines = np.array([m.start() for m in regex.finditer("\n", part)], dtype=np.int64)
            lo, hi = max(0, i - window), min(len(begins), i + window + 1)
            near = [fold(part[begins[j]:ends[j]]) for j in range(lo, hi) if j != i]
            hits.append((int(outcome[i]) // 3, int(outcome[i]) % 3, _quoted(marks, lines, int(begins[i])), near))
        yield len(begins), hits


def _quoted(marks: np.ndarray, lines: np.ndarray, at: int) -> bool:
    """An odd number of quotation marks before the place in its line, and one behind it."""
    line = int(np.searchsorted(lines, at))
    first = int(np.searchsorted(marks, lines[line - 1])) if line else 0
    last = int(np.searchsorted(marks, lines[line])) if line < len(lines) else len(marks)
    before = int(np.searchsorted(marks, at))
    return (before - first) % 2 == 1 and before < last


# -- fit ---------------------------------------------------------------------------


def _prefix_counts(training: Training):
    """(prefix, toxic rows, clean rows) of the words outside quotations; a whole word ends with a mark."""
    word = regex.compile(r"[\p{L}\p{N}\p{M}]+")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: tuple[Counter, Counter] = Counter(), Counter()
            for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                seen = set()
                for w in set(word.findall(_QUOTED.sub(" ", fold(text or "")))):
                    if len(w) >= training.word_letters:
                        seen.add(w + _WORD_END)
                    seen.update(w[:n] for n in range(training.stem_letters, len(w) + 1))
                counts[toxic].update(seen)
            keys = list(counts[0].keys() | counts[1].keys())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array([counts[1][k] for k in keys], pa.int64()),
                                              pa.array([counts[0][k] for k in keys], pa.int64())], names=["prefix", "toxic", "clean"])
    return run


def _evidence(a: Column, b: Column, toxic: int, clean: int) -> Column:
    """Square root of the likelihood ratio statistic of a prefix in ``a`` toxic and ``b`` clean rows."""
    n = a + b
    share = toxic / (toxic + clean)

    def part(x: Column, expected: Column) -> Column:
        return F.when(x > 0, x * F.log(x / expected)).otherwise(0.0)

    more = a / toxic > b / clean
    return F.when(more, F.sqrt(F.greatest(F.lit(0.0), 2 * (part(a, n * share) + part(b, n * (1 - share)))))).otherwise(0.0)


def build(terms: list[Term], most: int) -> Automaton:
    """The automaton of the terms, strongest first. If it would have more than ``most`` states, terms get by with
    one edit, then the weaker half of them with none, and so on."""
    edits, kept = max((t.edits for t in terms), default=0), len(terms)
    while True:
        try:
            return Automaton([replace(t, edits=min(t.edits, edits) if i < kept else 0) for i, t in enumerate(terms)], most)
        except TooManyStates:
            if edits > 1:
                edits -= 1
            elif kept:
                kept //= 2
            else:
                raise


def choose_terms(found: list[tuple[str, int, int, float]], training: Training) -> list[Term]:
    """Terms, strongest first, from prefixes (prefix, toxic rows, clean rows, evidence): of the prefixes along a
    branch of the trie the one of most evidence, made as long as nearly all of its toxic rows allow."""
    toxic = {p: a for p, a, _, _ in found}
    strength = {p: e for p, _, _, e in found}
    below = defaultdict(list)
    for p in toxic:
        below[p[:-1]].append(p)

    def longest(p: str) -> str:
        while True:
            child = max(below[p], key=lambda q: (toxic[q], q), default=None)
            if child is None or toxic[child] < 0.9 * toxic[p]:
                return p
            p = child

    def best(p: str) -> list[str]:
        """The terms chosen at or below a prefix."""
        todo, chosen = [p], []
        while todo:
            q = todo.pop()
            stack, strongest = list(below[q]), strength[q]
            while stack:
                r = stack.pop()
                strongest = max(strongest, strength[r])
                stack += below[r]
            if strongest <= 1.02 * strength[q]:
                chosen.append(longest(q))
            else:
                todo += below[q]
        return chosen

    roots = [p for p in toxic if p[:-1] not in toxic]
    out = []
    for t in sorted({t for p in roots for t in best(p)}, key=lambda t: (-strength[t], t))[:training.terms]:
        letters, whole = t.rstrip(_WORD_END), t.endswith(_WORD_END)
        limits = (training.one_edit_letters + (not whole), training.two_edit_letters + (not whole))
        out.append(Term(letters, whole, sum(len(letters) >= n for n in limits)))
    return out


def _hit_counts(automaton: Automaton, window: int):
    """(kind, key, label, n) of the hits in each batch: rows that hold a term outside quotations, by its edits;
    hits with a context word; quoted hits and others."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: Counter = Counter()
            for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows = set()
                for _, hits in find_hits(automaton, text or "", window):
                    for term, edits, quoted, near in hits:
                        if not quoted:
                            rows.add(f"{term}:{edits}")
                        counts["all", "quoted" if quoted else "", toxic] += 1
                        counts.update(("word", w, toxic) for w in set(near))
                counts.update(("term", t, toxic) for t in rows)
            if counts:
                kind, key, label = zip(*counts.keys(), strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(kind), pa.array(key), pa.array(label, pa.int32()),
                                                  pa.array(list(counts.values()), pa.int64())], names=["kind", "key", "toxic", "n"])
    return run


def _log_odds(a: float, b: float, toxic: float, clean: float) -> float:
    return math.log(a / toxic) - math.log(b / clean)


def _fit_curve(x: np.ndarray, y: np.ndarray, weights: np.ndarray) -> tuple[float, ...]:
    """Weighted logistic regression by Newton's method with a small ridge; the constant comes last."""
    scale = np.where(x.std(axis=0) > 0, x.std(axis=0), 1.0)
    design = np.hstack([x / scale, np.ones((len(x), 1))])
    ridge = np.diag([0.05] * x.shape[1] + [1e-6])
    beta = np.zeros(design.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        slope = design.T @ (weights * (y - p)) - ridge @ beta
        curve = (design * (weights * p * (1 - p))[:, None]).T @ design + ridge
        step = np.linalg.solve(curve, slope)
        beta = beta + step * min(1.0, 2.0 / np.abs(step).max()) if np.abs(step).max() > 0 else beta
        if np.abs(step).max() < 1e-8:
            break
    return (*(beta[:-1] / scale).tolist(), float(beta[-1]))


def fit(docs: DataFrame, labels: DataFrame, training: Training = Training()) -> ToxicityModel:
    """Train on labelled rows that are not held out. ``labels`` has doc_id and toxic (0 or 1)."""
    python_stages(docs.sparkSession)
    known = (labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.min("toxic").cast("int").alias("toxic"), F.max("toxic").alias("other"))
             .filter("toxic = other").select("doc_id", "toxic"))
    totals = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    picked = [known.filter(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(training.rows) for y in (0, 1)]
    chosen = docs.select("doc_id", "text").join(F.broadcast(picked[0].unionByName(picked[1])), "doc_id")
    chosen = chosen.groupBy("doc_id", "toxic").agg(F.coalesce(F.min("text"), F.lit("")).alias("text"))
    chosen = materialize(chosen.withColumn("tuning", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(2)) == 1), "toxicity-sample")
    sizes = {(r["tuning"], r["toxic"]): r["count"] for r in chosen.groupBy("tuning", "toxic").count().collect()}
    share = (totals.get(1, 0) + 1) / (sum(totals.values()) + 2)
    flat = ToxicityModel(Automaton([]), np.zeros((0, 3)), curve=(0.0, 0.0, 0.0, math.log(share / (1 - share))), training=training)
    if len(sizes) < 4:
        return flat
    words, tuning = chosen.filter("NOT tuning").select("toxic", "text"), chosen.filter("tuning").select("toxic", "text")
    toxic, clean = sizes[False, 1], sizes[False, 0]
    a, b = F.col("toxic"), F.col("clean")
    counted = (words.mapInArrow(_prefix_counts(training), "prefix string, toxic bigint, clean bigint")
               .groupBy("prefix").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
               .filter(a >= training.support).withColumn("evidence", _evidence(a, b, toxic, clean))
               .filter(F.col("evidence") >= training.evidence).orderBy(F.desc("evidence"), "prefix").limit(training.candidates))
    found = [(r["prefix"], r["toxic"], r["clean"], r["evidence"]) for r in counted.collect()]
    terms = choose_terms(found, training)
    if not terms:
        return flat
    automaton = build(terms, training.states)
    terms = automaton.terms
    learned = {p: (a, b) for p, a, b, _ in found}
    prior = [learned[t.letters + _WORD_END * t.whole] for t in terms]
    hits = (tuning.mapInArrow(_hit_counts(automaton, training.window), "kind string, key string, toxic int, n bigint")
            .groupBy("kind", "key").agg(F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("toxic"),
                                        F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("clean")))
    hits = hits.persist()
    rows = {r["key"]: (r["toxic"], r["clean"]) for r in hits.filter("kind = 'term'").collect()}
    every = {r["key"]: (r["toxic"], r["clean"]) for r in hits.filter("kind = 'all'").collect()}
    near = hits.filter("kind = 'word' AND toxic + clean >= 5").orderBy(F.desc(F.least("toxic", "clean")), "key")
    near = [(r["key"], r["toxic"], r["clean"]) for r in near.limit(training.context_words).collect()]
    hits.unpersist()
    sizes_of = sizes[True, 1], sizes[True, 0]
    model = ToxicityModel(automaton, _term_weights(terms, prior, rows, sizes_of), _context(near, every),
                          _quote_weight(every, training), training=training)
    scored = tuning.mapInArrow(_values(model, None), "toxic int, strongest double, total double, words double").collect()
    x = np.array([[r["strongest"], r["total"], r["words"]] for r in scored])
    y = np.array([r["toxic"] for r in scored], dtype=np.float64)
    by_class = np.where(y == 1, totals[1] / sizes_of[0], totals[0] / sizes_of[1])
    return ToxicityModel(automaton, model.weights, model.context, model.quoted, _fit_curve(x, y, by_class / by_class.mean()), training)


def _term_weights(terms: list[Term], prior: list[tuple[int, int]], rows: dict[str, tuple[int, int]],
                  sizes: tuple[int, int]) -> np.ndarray:
    """Logarithm of the odds that a row with the term, misspelled by so many edits, is toxic; the rows that gave
    the lexicon count for a quarter. A misspelling starts from a part of what the term itself has shown.
    Weights that say little are 0."""
    out = np.zeros((len(terms), 3))
    for t, term in enumerate(terms):
        a, b = rows.get(f"{t}:0", (0, 0))
        a, b = 1 + a + 0.25 * prior[t][0], 1 + b + 0.25 * prior[t][1]
        out[t, 0] = _log_odds(a, b, sizes[0] + 2, sizes[1] + 2)
        toxic = a / sizes[0] / (a / sizes[0] + b / sizes[1])
        for edits in range(1, term.edits + 1):
            c, d = rows.get(f"{t}:{edits}", (0, 0))
            strength = 4 * 0.5 ** edits
            out[t, edits] = _log_odds((1 + strength * toxic) / sizes[0] + c / sizes[0],
                                      (1 + strength * (1 - toxic)) / sizes[0] + d / sizes[1], 1, 1)
    out[out < 0.4] = 0.0
    return out


def _context(near: list[tuple[str, int, int]], every: dict[str, tuple[int, int]]) -> dict[str, float]:
    """What a word in the window says of a hit: shrunk logarithms of odds between hits of toxic and of clean rows."""
    toxic, clean = (sum(v[i] for v in every.values()) for i in (0, 1))
    if min(toxic, clean) < 20:
        return {}
    out = {w: _log_odds(a + 2, b + 2 * clean / toxic, toxic, clean) * (a + b) / (a + b + 20) for w, a, b in near}
    return {w: max(-3.0, min(3.0, v)) for w, v in out.items() if abs(v) > 0.1}


def _quote_weight(every: dict[str, tuple[int, int]], training: Training) -> float:
    """What quotation marks take from a hit (or add to it), starting from the parameter as if by ten hits."""
    (tq, cq), (tu, cu) = every.get("quoted", (0, 0)), every.get("", (0, 0))
    seen = min(tq + cq, cq + cu)
    if not seen:
        return training.quoted
    told = math.log((tq + 1) / (cq + 1)) - math.log((tu + 1) / (cu + 1))
    return (10 * training.quoted + seen * max(-6.0, min(6.0, told))) / (10 + seen)


# -- scores ------------------------------------------------------------------------


def _values(model: ToxicityModel, to_score: bool | None):
    """The columns but the last, with the features (None) or the score of the text in the last column."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rest, names = batch.columns[:-1], batch.schema.names[:-1]
            values = [model.features(t.as_py() or "") for t in batch.column(batch.num_columns - 1)]
            if to_score:
                yield pa.RecordBatch.from_arrays([*rest, pa.array([model.score(v) for v in values], pa.float64())],
                                                 names=[*names, "value"])
            else:
                given = [pa.array([v[j] for v in values], pa.float64()) for j in range(3)]
                yield pa.RecordBatch.from_arrays([*rest, *given], names=[*names, "strongest", "total", "words"])
    return run


def score_toxicity(docs: DataFrame, model: ToxicityModel, keep: tuple[str, ...] | None = None) -> DataFrame:
    """The columns ``keep`` (default: all) of every row, with ``score`` and ``predicted`` added."""
    python_stages(docs.sparkSession)
    names = list(keep if keep is not None else docs.columns)
    given = docs.select(*[F.col(n).alias(f"c{i}") for i, n in enumerate(names)], F.col("text").alias("t"))
    schema = ", ".join([f"c{i} {given.schema[f'c{i}'].dataType.simpleString()}" for i in range(len(names))] + ["value double"])
    out = given.mapInArrow(_values(model, True), schema)
    return out.select(*[F.col(f"c{i}").alias(n) for i, n in enumerate(names)], F.col("value").alias("score"),
                      (F.col("value") >= THRESHOLD).cast("int").alias("predicted"))
