"""Secret scanning by assignment-aware lexing (operator 7).

Method. Texts are scanned for three fixed kinds of spans and, on top of them,
lexed for assignments as source and configuration files write them: a name
(identifier, dotted path, quoted key), an assignment sign and a value made of
string literals, bare words and other names, joined by + or following one
another. Literals that a name received are remembered, so a name on the right
of a later assignment stands for them (constant propagation, however many they
are); commas and line feeds in lists, tuples, tables and arguments go on with the
name before the bracket, which also gets the values of keys inside it. A literal is
scored by the most sensitive name it reaches and by its own shape, and those
that reach LITERAL_SCORE become spans of a fourth kind. Literals inside a fixed
span are not reported twice.

One narrow pass over whole texts on executors, no shuffle; a text whose letters
hold no word of SENSITIVE, or that has no assignment sign, is not lexed.

Cases. Null text counts as empty; bytes that are no UTF-8 as U+FFFD. Rows that
repeat are scanned one by one. An empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripspark.llm.common import as_text, python_stages, text_bytes

KINDS = ("assign", "access", "hex", "literal")
BASE_KINDS = KINDS[:3]
LITERAL_SCORE = 0.6

# The base kinds. The minimal lengths are counted by the patterns where
# a shorter run can hold no later match, and on the match otherwise.
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                     re.IGNORECASE | re.ASCII)
_ASSIGN_WORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")
_ASSIGN_LEAST = 6
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")

#: Words of a name and how sensitive they make it.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 0.9, "secret": 1.0, "token": 0.9, "apikey": 1.0,
    "credential": 0.9, "credentials": 0.9, "auth": 0.7, "bearer": 0.9, "private": 0.6, "signing": 0.6, "key": 0.5,
    "access": 0.4, "salt": 0.5, "cert": 0.4, "connection": 0.4, "dsn": 0.6, "webhook": 0.6,
}
#: What the letters of every name that has a score contain: the words that contain no other.
_STEMS = tuple(w for w in SENSITIVE if not any(v in w and v != w for v in SENSITIVE))
_BETWEEN = re.compile(r"[^A-Za-z\n]+")
_PLACEHOLDERS = ("example", "changeme", "your", "xxxx", "placeholder", "dummy", "none", "null", "true", "false", "todo",
                 "${", "{{", "<", "test", "sample", "redacted")

_NAME = r"[A-Za-z_$][\w$]*(?:[.\-][A-Za-z_$][\w$]*)*"
_LEXER = re.compile(rf"""
    (?P<string>"(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*'|`[^`\n]*`)
  | (?P<name>{_NAME})
  | (?P<sign>:=|=>|==|!=|<=|>=|[=:])
  | (?P<join>[+])
  | (?P<line>\n|;|,)
  | (?P<open>[\[({{])
  | (?P<close>[\])}}])
  | (?P<word>[A-Za-z0-9+/_.\-=~!@%^&*|]+)
  | (?P<comment>(?:\#|//)[^\n]*)
""", re.VERBOSE | re.ASCII)
_SIGNS = (":=", "=>", "=", ":")
_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")


def name_score(name: str) -> float:
    """Sensitivity of a name from its words, in any of the usual spellings."""
    parts = [p.lower() for p in _PARTS.findall(name)]
    joined = {"".join(parts[i:i + 2]) for i in range(len(parts))}
    best = max((SENSITIVE.get(p, 0.0) for p in (*parts, *joined)), default=0.0)
    if best < 0.9 and len([p for p in parts if p in SENSITIVE]) > 1:
        best += 0.4
    return min(1.0, best)


def may_be_sensitive(text: str) -> bool:
    """Whether a name in the text may have a score: a word of it may be spread over parts of
    the name, with anything but letters and line feeds between them."""
    letters = _BETWEEN.sub("", text).lower()
    return any(s in letters for s in _STEMS)


def literal_score(value: str) -> float:
    """How much a literal looks like a credential: length, kinds of characters, spread."""
    low = value.lower()
    if len(value) < 8 or any(c.isspace() for c in value) or any(p in low for p in _PLACEHOLDERS):
        return 0.0
    counts = Counter(value)
    entropy = -sum(n / len(value) * math.log2(n / len(value)) for n in counts.values())
    kinds = sum((any(c.islower() for c in value), any(c.isupper() for c in value), any(c.isdigit() for c in value),
                 any(not c.isalnum() for c in value)))
    return 0.4 * min(1.0, entropy / 3.5) + 0.25 * min(1.0, len(value) / 16) + 0.35 * (kinds - 1) / 2 if kinds > 1 else 0.0


class _Item:
    """An assignment while its value is read."""

    def __init__(self, name: str) -> None:
        self.name = name
        self.literals: list[tuple[int, int]] = []
        self.names: list[str] = []
        self.inner: list[int] = []

    def any(self) -> bool:
        return bool(self.literals or self.names or self.inner)


def _paired(text: str, tokens: list[tuple[str, int, int]]) -> set[int]:
    """Places of the brackets that have a partner."""
    found: set[int] = set()
    opened: list[int] = []
    count = Counter()
    for kind, start, _ in tokens:
        if kind == "open":
            opened.append(start)
            count[text[start]] += 1
        elif kind == "close":
            partner = "[({"["])}".index(text[start])]
            while count[partner]:
                at = opened.pop()
                count[text[at]] -= 1
                if text[at] == partner:
                    found |= {at, start}
                    break
    return found


def assignments(text: str) -> Iterator[tuple[str, list[tuple[int, int]], list[str], list[int]]]:
    """(name, spans of its literals, names used in its value, places in this sequence of the
    assignments inside its brackets) of each assignment, in order of their ends.

    Inside brackets that have a partner, what has no key of its own belongs to the name before the bracket."""
    tokens = [(m.lastgroup, m.start(), m.end()) for m in _LEXER.finditer(text)]
    paired = _paired(text, tokens)
    frames: list[tuple[_Item | None, _Item | None, int, str]] = []
    owner: _Item | None = None
    item: _Item | None = None
    bracket, strings, number = "", 0, 0
    pending: str | None = None
    took: list | None = None
    quoted = False
    for kind, start, end in [*tokens, ("end", len(text), len(text))]:
        target = item or owner
        done: _Item | None = None
        if kind == "open" and start in paired:
            frames.append((owner, item, strings, bracket))
            owner, item, strings, bracket, pending = target, None, 0, text[start], None
        elif kind == "close" and start in paired:
            done, parent = item, owner
            owner, item, strings, bracket = frames.pop()
        elif (kind == "sign" and text[start:end] in _SIGNS and pending is not None
              and (target is None or (strings <= quoted if bracket else not target.literals))):
            if took is not None:
                took.pop()
            done, parent = item, owner
            item, pending, took, strings = _Item(pending), None, None, 0
        elif kind in ("line", "comment", "end"):
            sign, pending = text[start:end], None
            if not bracket:
                if sign != "," or item is None or item.any():
                    done, parent, item = item, owner, None
            elif kind == "line":
                strings = 0
                if sign != "\n" or bracket == "{" and item is not None and item.any():
                    done, parent, item = item, owner, None
        elif kind in ("string", "name"):
            quoted = kind == "string"
            pending = text[start + 1:end - 1] if quoted else text[start:end]
            strings += quoted
            took = None
            if target is not None:
                took = target.literals if quoted else target.names
                took.append((start + 1, end - 1) if quoted else pending)
        elif kind == "word":
            pending = None
            strings += 1
            if target is not None:
                target.literals.append((start, end))
        elif kind == "sign":
            pending = None
        if done is not None and done.any():
            if parent is not None:
                parent.inner.append(number)
            number += 1
            yield done.name, done.literals, done.names, done.inner


def literal_spans(text: str) -> list[tuple[int, int, float]]:
    """(start, end, score) of literals that reach a sensitive name."""
    scores: list[float] = []
    values: list[tuple[list[tuple[int, int]], list[int]]] = []
    holds: dict[str, int] = {}
    for name, literals, names, inner in assignments(text):
        used = inner + [holds[n] for n in names if n in holds]
        if literals or used:
            holds[name] = len(values)
        scores.append(name_score(name))
        values.append((literals, used))
    # An assignment uses earlier ones only, so from the last one back each score is final when it is passed on.
    reached: dict[tuple[int, int], float] = {}
    for k in range(len(values) - 1, -1, -1):
        if scores[k]:
            for span in values[k][0]:
                reached[span] = max(reached.get(span, 0.0), scores[k])
            for j in values[k][1]:
                scores[j] = max(scores[j], scores[k])
    out = []
    for (start, end), score in sorted(reached.items()):
        score *= literal_score(text[start:end])
        if score >= LITERAL_SCORE:
            out.append((start, end, score))
    return out


def scan(text: str) -> list[tuple[str, int, int, float]]:
    """All spans of a text: (kind, start, end, score), by start, then kind as listed."""
    low = text.lower()
    found: list[tuple[str, int, int, float]] = []
    if any(w in low for w in _ASSIGN_WORDS):
        found += [("assign", m.start(), m.end(), 1.0) for m in _ASSIGN.finditer(text)
                  if m.end(2) - m.start(2) >= _ASSIGN_LEAST]
    if "AKIA" in text:
        found += [("access", *m.span(), 1.0) for m in _ACCESS.finditer(text)]
    found += [("hex", *m.span(), 1.0) for m in _HEX.finditer(text)]
    if ("=" in text or ":" in text) and may_be_sensitive(text):
        base = sorted((s, e) for _, s, e, _ in found)
        begins, reach = [s for s, _ in base], list(accumulate((e for _, e in base), max))
        for start, end, score in literal_spans(text):
            before = bisect_right(begins, start)
            if not before or reach[before - 1] < end:  # no base span holds it
                found.append(("literal", start, end, score))
    found.sort(key=lambda f: (f[1], KINDS.index(f[0]), f[2]))
    return found


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans = [[{"kind": k, "start": s, "end": e, "score": v} for k, s, e, v in scan(as_text(t.as_py()))]
                 for t in batch.column(batch.num_columns - 1)]
        yield pa.RecordBatch.from_arrays([*[batch.column(j) for j in range(batch.num_columns - 1)], pa.array(spans, _SPANS)],
                                         names=[*batch.schema.names[:-1], "spans"])


def find_secrets(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """The columns ``keep`` of every row with ``spans`` added: array of (kind, start,
    end, score) by start, then kind; code points, end exclusive."""
    python_stages(docs.sparkSession)
    given = docs.select(*[F.col(n).alias(f"c{i}") for i, n in enumerate(keep)], text_bytes(F.col(text_col)).alias("t"))
    columns = "".join(f"c{i} {given.schema[f'c{i}'].dataType.simpleString()}, " for i in range(len(keep)))
    out = given.mapInArrow(_scan, f"{columns}spans array<struct<kind:string,start:int,end:int,score:double>>")
    return out.select(*[F.col(f"c{i}").alias(n) for i, n in enumerate(keep)], "spans")
