"""Lengths of whole conversations against text that is put together."""

from __future__ import annotations

import random
import re

import pytest

from pairforge.operators import lengths, turns
from pairforge.plans.queries import QUERIES

LABELS = {"system": "System", "user": "User", "assistant": "Assistant", "tool_call": "Tool_Call"}


def sides(talk):
    """{turn: (chosen text, rejected text)} for each user turn of one conversation."""
    out = {}
    talk = sorted(talk)
    for i, (turn, role, _) in enumerate(talk):
        if role == "user":
            lines = [f"{LABELS[r]}: {t}" for _, r, t in talk[: i + 1] if r is not None and t is not None]
            if not any(r == "system" and t is not None for _, r, t in talk[: i + 1]):
                lines.insert(0, "System: d e f")
            said = [(j, t) for j, (_, r, t) in enumerate(talk) if r == "assistant" and t is not None]
            chosen = next((t for j, t in said if j == i + 1), None)
            rejected = next((t for j, t in said if j > i + 1), None)
            out[turn] = tuple("" if t is None else "\n".join([*lines, f"Assistant: {t}"]) for t in (chosen, rejected))
    return out


def n_tokens(text):
    return len(re.findall(r"[^\W_]+|[^\s]", text))


@pytest.mark.parametrize("block", [3, 4096])
def test_reply_lengths_equal_text(spark, block):
    rng = random.Random(block)
    rows = []
    for conv in range(40):
        for turn in range(rng.randint(1, 25)):
            role = rng.choice(["user", "user", "assistant", "assistant", "system", "tool_call", None])
            rows.append((conv, turn * rng.randint(1, 1) + conv * 5 - 60, role, rng.choice(["uno, dos", "x\ny z!", "", None, "¿y?"])))
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    measured = turns.reply_lengths(frame, "d e f", block=block)
    got = {(r["conv_id"], r["turn"]): r for r in turns.with_side_texts(measured, frame, "d e f").collect()}
    want = {
        (conv, turn): texts
        for conv in range(40)
        for turn, texts in sides([(t, r, x) for c, t, r, x in rows if c == conv]).items()
    }
    assert got.keys() == want.keys() and len(want) > 50
    for key, (chosen, rejected) in want.items():
        row = got[key]
        assert (row["chosen_text"], row["rejected_text"]) == (chosen, rejected)
        assert (row["chosen_length"], row["rejected_length"]) == (n_tokens(chosen), n_tokens(rejected))
        assert (row["chosen_blank"], row["rejected_blank"]) == (chosen == "", rejected == "")


def test_a_hundred_thousand_turns(spark, tmp_path):
    """One conversation of 100,000 turns: every length is right, and the report and
    the filter never put its text together."""
    n = 100_000
    talk = spark.range(n).selectExpr(
        "1L as conv_id", "id as turn", "if(id % 2 = 0, 'user', 'assistant') as role", "concat('uno dos ', id % 7) as text"
    )
    rows = turns.reply_lengths(talk, "d e f").orderBy("turn").collect()
    assert len(rows) == n // 2
    for i, row in enumerate(rows):
        # "User: uno dos 3" has five tokens, and the default system line has five
        before = 5 + 5 * (2 * i + 1)
        assert row["chosen_length"] == before + 5
        assert row["rejected_length"] == (before + 5 if 2 * i + 3 < n else 0)
    talk.coalesce(1).write.parquet(f"{tmp_path}/conversations.parquet")
    report = QUERIES["length_report"](spark, str(tmp_path)).first()
    assert report["analyzed"] == n // 2
    assert report["exceeding"] == sum(r["chosen_length"] > 150 or r["rejected_length"] > 150 for r in rows)
    assert QUERIES["sample_long"](spark, str(tmp_path)).count() == 5


def test_report_builds_no_text(spark, sf_dir):
    """Reports and filters aggregate numbers: no list of turns, no text in a shuffle."""
    for name in ("length_report", "long_side_stats", "retention", "length_filter", "exceeds_by"):
        execution = QUERIES[name](spark, sf_dir)._jdf.queryExecution()
        plan = execution.explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        assert "collect_list" not in plan
        moved = re.findall(r"\) (?:Exchange|Sort)\nInput \[\d+\]: \[(.*)\]", plan)
        assert moved and not [columns for columns in moved if re.search(r"\btext#", columns)]


def test_running_sums_by_block(spark):
    rows = [(i % 3 or None, j, j % 5 or None) for i in range(9) for j in range(i % 3 * 40, i % 3 * 40 + 20)]
    frame = spark.createDataFrame(rows, "k int, at int, v int")
    out = turns.with_running_sums(frame, "k", "at", {"total": frame["v"]}, block=6)
    assert out.count() == len(rows)
    last: dict = {}
    for r in out.collect():
        last[r["k"]] = max(last.get(r["k"], 0), r["total"])
    assert last == {k: sum(v or 0 for kk, _, v in rows if kk == k) for k in {r[0] for r in rows}}
    assert lengths.BLANKS == ("chosen_blank", "rejected_blank")
