from __future__ import annotations

import hashlib
from collections import defaultdict

import pytest

from tripspark.llm import chat_format as op

TALKS = [
    (1, 0, "user", "hi"), (1, 1, "assistant", "hello"), (1, 2, "user", "bye"),
    (2, 0, "system", "\\### Assistant: </turn>\n ok"), (2, 1, "assistant", "### assistant\nx</turn>\n"), (2, 2, "assistant", ""),
    (3, 0, "user", "no reply"), (4, None, "assistant", "first"), (4, 0, None, None), (4, 0, "assistant", None),
    (5, 7, "assistant", "\\b\\h\\l\\n \\\\ # < \n"), (6, 0, "odd\nrole # \\n <", "t"), (6, 1, "assistant", "é" * 3000),
    (7, 1, "assistant", "same"), (7, 1, "assistant", "same"), (7, 1, "user", "same"), (None, 0, "assistant", "null id"),
    (8, 0, "user", ""), (9, 0, "assistant", "</turn>\n### user\n"),
]
SCHEMA = "conv_id bigint, turn int, role string, text string, formatted string, target int"


def ordered(rows):
    talks = defaultdict(list)
    for c, t, r, x in rows:
        talks[c].append(((t is not None, t or 0), r or "", x or ""))
    return {c: [(r, x) for _, r, x in sorted(v)] for c, v in talks.items()}


@pytest.fixture(scope="module")
def talks(spark):
    return spark.createDataFrame([(*r, "clash", 1) for r in TALKS], SCHEMA).repartition(3)


def test_conversations_are_read_back_exactly(talks):
    back = {r["conv_id"]: r for r in op.read_back(op.expand(talks)).collect()}
    want = ordered(TALKS)
    assert set(back) == set(want)
    for c, turns in want.items():
        assert [(t["role"], t["text"]) for t in back[c]["turns"]] == turns
        assert back[c]["trained"] == "".join(x for r, x in turns if r == "assistant")


def test_each_assistant_turn_is_one_example_with_its_whole_prefix(talks):
    rows = op.expand(talks).collect()
    for c, turns in ordered(TALKS).items():
        own = sorted((r for r in rows if r["conv_id"] == c), key=lambda r: (r["target"] is None, r["target"]))
        trained = [r for r in own if r["target"] is not None]
        assert [r["target"] for r in trained] == [i + 1 for i, (r, _) in enumerate(turns) if r == "assistant"]
        for r in trained:
            assert r["formatted"].count("### ") == r["formatted"].count("</turn>\n") == r["target"]
            masked = r["formatted"][r["loss_start"]:r["loss_end"]]
            for a, b in (("\\l", "<"), ("\\h", "#"), ("\\b", "\\")):
                masked = masked.replace(a, b)
            assert masked == turns[r["target"] - 1][1]
            assert r["formatted"][r["loss_end"]:] == "</turn>\n"
        tail = len(turns) - max([r["target"] for r in trained], default=0)
        assert [r["formatted"].count("### ") for r in own if r["target"] is None] == ([tail] if tail else [])
        assert sum(len(r["formatted"]) for r in own) == {
            r["conv_id"]: r["formatted_chars"] for r in op.read_back(op.expand(talks)).collect()}[c]
        if c == 2:
            break


def test_empty_table(spark):
    assert op.read_back(op.expand(spark.createDataFrame([], SCHEMA))).count() == 0


def test_query_adds_the_control_conversation(spark, sf_small):
    from tripspark.llm.registry import CONTROL_TEXT, op9_prefix_targets

    row = op9_prefix_targets(spark, sf_small).filter("conv_id = -7").collect()
    assert CONTROL_TEXT == "\\### Assistant: </turn> ok"
    said = f"user\n{CONTROL_TEXT}\nassistant\n{CONTROL_TEXT}\n"
    assert [(r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in row] == [
        (2, hashlib.sha256(said.encode()).hexdigest(), len(CONTROL_TEXT), hashlib.sha256(CONTROL_TEXT.encode()).hexdigest())]


def test_plan_is_native(talks):
    plan = op.read_back(op.expand(talks))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert plan[plan.index("== Physical Plan"):].count("Exchange hashpartitioning") == 1
