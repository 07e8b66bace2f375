"""Conversation repair against exhaustive search, SQL, and one uncut search."""

from __future__ import annotations

import hashlib
import itertools
import random
import re

import pytest

from pairforge.llm import repair
from pairforge.llm.queries import ORACLE, QUERIES
from tests.compare import connect, difference, spark_rows, sql_rows

PATTERN = re.compile(r"(s?(ua)+)?")


def exhaustive(rows):
    """All edits of each row, with up to two insertions at each place."""
    best = None
    places = [["", "I", "II"]] * (len(rows) + 1)
    edits = [["D"] if fault in (1, 2) else ["D", "K", "Ru", "Ra"] for _, fault in rows]
    for edit in itertools.product(*edits):
        for extra in itertools.product(*places):
            for spoken in itertools.product("ua", repeat=sum(map(len, extra))):
                said, out, audit, cost = iter(spoken), "", "", 0
                for i in range(len(rows) + 1):
                    for _ in extra[i]:
                        out, audit, cost = out + next(said), audit + "I", cost + 3
                    if i < len(rows):
                        initial, fault = rows[i]
                        audit += edit[i][0]
                        cost += {"D": 4, "K": 0, "R": 3}[edit[i][0]] + (3 if fault == 3 and edit[i] != "D" else 0)
                        out += {"D": "", "K": initial}.get(edit[i], edit[i][-1])
                if PATTERN.fullmatch(out) and (best is None or (cost, audit) < best):
                    best = cost, audit
    return best


def test_cheapest_edits_equal_exhaustive_search():
    rng = random.Random(3)
    for _ in range(120):
        rows = [(rng.choice("suat "), rng.choice([0, 0, 0, 1, 2, 3])) for _ in range(rng.randint(0, 3))]
        assert repair.cheapest_edits(rows) == exhaustive(rows), rows


def by_rows(rows):
    """Least cost, least audit, by one pass over the rows with a label a state."""
    labels = {0: (0, "")}
    for initial, fault in [*rows, (None, None)]:
        for before, after in ((0, 2), (1, 2), (3, 2), (2, 3), (3, 2)):
            if before in labels:
                cost, audit = labels[before]
                labels[after] = min(labels.get(after, (10**9, "")), (cost + 3, audit + "I"))
        if initial is None:
            return min(labels[s] for s in (0, 3) if s in labels)
        new = {}
        for state, (cost, audit) in labels.items():
            steps = [(4, "D", state)]
            if fault not in (1, 2):
                more = 3 if fault == 3 else 0
                steps += [(more, "K", repair.KEEP[state, initial])] if (state, initial) in repair.KEEP else []
                steps += [(3 + more, "R", repair.SPEAK[state])]
            for more, letter, to in steps:
                new[to] = min(new.get(to, (10**9, "")), (cost + more, audit + letter))
        labels = new


def test_longer_rows_and_meeting_in_the_middle(monkeypatch):
    rng = random.Random(4)
    cases = [[(rng.choice("suuaat"), rng.choice([0, 0, 0, 0, 1, 2, 3])) for _ in range(rng.randint(4, 60))] for _ in range(200)]
    cases += [[("u", 0), ("u", 0)] * 20, [("t", 0)] * 30, [("a", 3)] * 25]
    assert [repair.cheapest_edits(rows) for rows in cases] == [by_rows(rows) for rows in cases]
    # both heaps take part
    settled = []
    settle = repair._Side.settle
    monkeypatch.setattr(repair._Side, "settle", lambda self: settled.append(self.sign) or settle(self))
    repair.cheapest_edits(cases[-1])
    assert settled.count(1) > 5 and settled.count(-1) > 5


@pytest.fixture
def odd(spark):
    rng = random.Random(8)
    texts = ["Yes.", "No?", "Maybe", "", " \t", None, "Long one!\n", "é…"]
    rows = [(None, None, "user", "Hi.", 1), (None, 3, "assistant", "Ho.", 1), (7, 1, None, None, 2), (7, 1, "user", "x.", 2), (7, 1, "user", "x.", 2)]
    for conv in range(60):
        for turn in range(rng.randint(1, 9)):
            at = rng.choice([turn, turn, turn, turn * 2, None])
            rows.append((conv, at, rng.choice(["user", "assistant", "system", "tool", "User", "", None]), rng.choice(texts), 3))
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, part int")


def test_query_equals_sql_on_odd_rows(spark, odd, tmp_path):
    odd.toPandas().astype({"conv_id": "Int64", "turn": "Int64"}).to_parquet(f"{tmp_path}/conversations.parquet")
    con = connect(str(tmp_path))
    ours = spark_rows(QUERIES["op11_conversation_repair"](spark, str(tmp_path)))
    assert difference(ours, sql_rows(con, ORACLE["op11_conversation_repair"])) is None
    assert sum(ours[1].values()) == odd.select("conv_id").distinct().count()


def test_repaired_turns_are_in_order(spark, odd):
    turns = repair.damaged(odd)
    summary = {r["conv_id"]: r for r in repair.repair_summary(turns).collect()}
    after: dict = {}
    for r in sorted(repair.repaired_turns(turns).collect(), key=lambda r: r["position"]):
        after.setdefault(r["conv_id"], []).append((r["position"], r["role"], r["text"]))
    assert set(after) <= set(summary)
    for conv, row in summary.items():
        rows = after.get(conv, [])
        assert [p for p, _, _ in rows] == list(range(len(rows)))
        assert PATTERN.fullmatch("".join(role[:1] for _, role, _ in rows))
        assert hashlib.sha256("\n".join(f"{r}:{t}" for _, r, t in rows).encode()).hexdigest() == row["repaired_sha256"]


def test_hot_conversation_is_cut_and_joined(spark):
    """Two thousand turns of one conversation, and the same as one search."""
    rng = random.Random(9)
    said = [(rng.choice(["user", "assistant", "assistant", "system", "tool"]), rng.choice(["a.", "b", f"{i} ok.", f"{i} and"])) for i in range(2000)]
    rows = [(1, i + (i > 900), *s) for i, s in enumerate(said)] + [(c, 0, "user", "Hello.") for c in range(2, 60)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    solved = repair.pieces(repair._plain(turns))
    assert solved.where("conv_id = 1").count() > 2000 // repair.PIECE_ROWS
    got = {r["conv_id"]: r for r in repair.repair_summary(turns).collect()}
    seen: set = set()
    marks = []
    for role, text in said:
        marks.append((role[0], 2 if (role, text) in seen else 0 if text[-1] == "." else 3))
        seen.add((role, text))
    cost, audit = by_rows(marks)
    assert (got[1]["cost"], got[1]["audit"], got[1]["gaps"]) == (cost, audit, 1)
    assert got[1]["duplicate"] == sum(f == 2 for _, f in marks)
    assert got[1]["illegal"] == sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in itertools.pairwise(marks))
    lines = "\n".join(f"{r}:{t}" for r, t in repair.repaired(said, audit))
    assert got[1]["repaired_sha256"] == hashlib.sha256(lines.encode()).hexdigest()
    assert {(got[c]["cost"], got[c]["audit"]) for c in range(2, 60)} == {(3, "KI")}
    after = repair.repaired_turns(turns).where("conv_id = 1").orderBy("position").collect()
    assert "\n".join(f"{r['role']}:{r['text']}" for r in after) == lines


def test_empty_table_and_conversations_without_rows(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert repair.repair_summary(empty).count() == 0
    assert repair.repaired_turns(empty).count() == 0
    gone = spark.createDataFrame([("c", 1, "user", "x.", True)], "conv_id string, turn int, role string, text string, gone boolean")
    row = repair.repair_summary(gone).drop("path").first()
    assert tuple(row) == ("c", 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
