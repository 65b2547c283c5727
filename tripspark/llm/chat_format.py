"""Chat formatting by prefix-target expansion (operator 9, native).

Method. Every assistant turn becomes an example of its own: all preceding turns
as context, then this reply, of which alone the text is trainable. Turns after
the last assistant turn form one further row that trains nothing, so that no
turn is lost and a conversation can be read back from its rows.

Template. A turn is written as ``### role``, a line feed, the text, ``</turn>``
and a line feed. Inside roles and texts a backslash becomes ``\\b``, ``#``
becomes ``\\h``, ``<`` becomes ``\\l`` and, in roles, a line feed becomes
``\\n``; so neither marker can occur in them, and the replacements can be undone
one after the other, as no escape's second letter starts another one.

Only DataFrame and SQL functions are used. A conversation is gathered once
(one shuffle by its id; the examples keep that partitioning, so reading them
back needs none). The result's size is the sum of all prefixes, which the
method asks for.

Cases. Null text and null role count as empty. Rows are ordered by turn (null
first), then role, then text; rows that repeat are kept. Rows with a null
conv_id form one conversation. Extra columns are not read. An empty table
gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "### ", "</turn>\n"
TRAINED_ROLE = "assistant"

_ESCAPES = (("\\", "\\b"), ("#", "\\h"), ("<", "\\l"))
_ROLE_ESCAPES = (*_ESCAPES, ("\n", "\\n"))


def _replace(text: Column, pairs) -> Column:
    for old, new in pairs:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def escape(text: Column) -> Column:
    return _replace(text, _ESCAPES)


def unescape(text: Column) -> Column:
    """Undoes ``escape``, also for roles: the backslash comes last."""
    return _replace(text, [(new, old) for old, new in reversed(_ROLE_ESCAPES)])


def expand(conversations: DataFrame) -> DataFrame:
    """One row per example: conv_id, target (number of the trained turn from 1;
    null for the closing row), formatted, and the loss mask's only span
    (loss_start, loss_end: code points of ``formatted``, end exclusive)."""
    rows = conversations.select("conv_id", F.struct(
        F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("t"))
    turns = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    turns = turns.select(
        "conv_id",
        F.transform("turns", lambda t: F.concat(F.lit(OPEN), _replace(t["role"], _ROLE_ESCAPES), F.lit("\n"),
                                                escape(t["text"]), F.lit(CLOSE))).alias("written"),
        F.transform("turns", lambda t: F.length(escape(t["text"]))).alias("lengths"),
        F.filter(F.transform("turns", lambda t, i: F.when(t["role"] == TRAINED_ROLE, i + 1)),
                 lambda i: i.isNotNull()).alias("targets"))
    closing = F.coalesce(F.array_max("targets"), F.lit(0)) < F.size("written")
    each = turns.select("*", F.explode(F.concat("targets", F.when(closing, F.array(F.lit(0))).otherwise(
        F.array().cast("array<int>")))).alias("target"))
    last = F.coalesce(F.array_max("targets"), F.lit(0))
    trained = F.col("target") > 0
    formatted = F.array_join(F.when(trained, F.slice("written", F.lit(1), F.col("target"))).otherwise(
        F.slice("written", last + 1, F.size("written"))), "")
    out = each.select("conv_id", F.when(trained, F.col("target")).alias("target"), formatted.alias("formatted"),
                      F.when(trained, F.element_at("lengths", F.greatest(F.col("target"), F.lit(1)))).alias("n"))
    end = F.length("formatted") - len(CLOSE)
    return out.select("conv_id", "target", "formatted", F.when(F.col("target").isNotNull(), end - F.col("n")).alias("loss_start"),
                      F.when(F.col("target").isNotNull(), end).alias("loss_end"))


def read_back(examples: DataFrame) -> DataFrame:
    """Conversations recovered from the rows of ``expand`` alone: conv_id, turns
    (array of role and text), trained (text under the loss mask, in order) and
    formatted_chars (length of all rows)."""
    masked = F.substr("formatted", F.col("loss_start") + 1, F.col("loss_end") - F.col("loss_start"))
    whole = examples.select("conv_id", "target", "formatted", unescape(masked).alias("reply"))
    gathered = whole.groupBy("conv_id").agg(
        F.max_by("formatted", "target").alias("longest"),
        F.max(F.when(F.col("target").isNull(), F.col("formatted"))).alias("closing"),
        F.sort_array(F.collect_list(F.when(F.col("target").isNotNull(), F.struct("target", "reply")))).alias("replies"),
        F.sum(F.length("formatted").cast("long")).alias("formatted_chars"))
    text = F.concat(F.coalesce("longest", F.lit("")), F.coalesce("closing", F.lit("")))
    pieces = F.split(text, CLOSE)
    pieces = F.slice(pieces, F.lit(1), F.size(pieces) - 1)
    body = len(OPEN) + 1
    turns = F.transform(pieces, lambda p: F.struct(
        unescape(F.substr(p, F.lit(body), F.instr(p, "\n") - body)).alias("role"),
        unescape(F.substr(p, F.instr(p, "\n") + 1)).alias("text")))
    return gathered.select("conv_id", turns.alias("turns"),
                           F.array_join(F.transform("replies", lambda r: r["reply"]), "").alias("trained"), "formatted_chars")
