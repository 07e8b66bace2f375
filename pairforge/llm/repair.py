"""Repair of conversation structure by bidirectional Dijkstra over the edit lattice.

A conversation is in order if the initials of its roles read ``(s?(ua)+)?``.  The
lattice has a node for each place between rows and each state of that pattern; an
edge keeps, re-roles or deletes the next row, or inserts an empty one.  A forward
heap grows from the start and a reverse heap from the end.  They stop when no
cheaper and no equally cheap path can be open, and of all crossings of least cost
the one with the least audit (initials of the edits) is taken.

A node's label is its least cost and, for that cost, its least audit.  Two audits
that lead to the same node at the same cost never begin one another (the longer one
would cost its extra insertions more), so least parts make least wholes.  Keeping
a row may cost nothing, and goes one row on, so among equal costs the heaps take
rows in order, and a label is final when its node leaves the heap.

Rows are dealt by ranges of (conversation, turn), so that one conversation may lie
in many tasks.  Conversations inside a range are solved there at once.  Those that
reach its border or have more than ``PIECE_ROWS`` rows are cut into pieces, a piece
is solved for each state before and after it, and a stream over the pieces of a
conversation joins them, with one label (cost, audit, running hash) a state.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairforge.llm.common import stored

#: States: nothing yet, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
ENDS = (START, ASSISTANT)
#: The state after a user or assistant row of the repair's own, by state before.
SPEAK = {START: USER, SYSTEM: USER, ASSISTANT: USER, USER: ASSISTANT}
ROLES = {USER: "user", ASSISTANT: "assistant"}
KEEP = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
SPEAK_BACK = {after: [before for before, to in SPEAK.items() if to == after] for after in (USER, ASSISTANT)}
KEEP_BACK = {(after, initial): [b for (b, i), to in KEEP.items() if (to, i) == (after, initial)] for (_, initial), after in KEEP.items()}

BLANK, DUPLICATE, TRUNCATED = 1, 2, 3
DELETE_COST, REROLE_COST, INSERT_COST, TRUNCATED_COST = 4, 3, 3, 3

#: A longer conversation is cut; so is one with more text than this.
PIECE_ROWS, PIECE_BYTES = 256, 4 << 20

WHITE = " \t\n\x0b\x0c\r"

Row = tuple[str, int]  # role initial, fault


def _steps(rows: list[Row], i: int, state: int) -> Iterator[tuple[int, str, int, int]]:
    """Edges out of a node: cost, letter, row and state after."""
    if i < len(rows):
        initial, fault = rows[i]
        yield DELETE_COST, "D", i + 1, state
        if fault not in (BLANK, DUPLICATE):
            more = TRUNCATED_COST if fault == TRUNCATED else 0
            if (state, initial) in KEEP:
                yield more, "K", i + 1, KEEP[state, initial]
            yield REROLE_COST + more, "R", i + 1, SPEAK[state]
    yield INSERT_COST, "I", i, SPEAK[state]


def _steps_back(rows: list[Row], i: int, state: int) -> Iterator[tuple[int, str, int, int]]:
    """Edges into a node: cost, letter, row and state before."""
    if i > 0:
        initial, fault = rows[i - 1]
        yield DELETE_COST, "D", i - 1, state
        if fault not in (BLANK, DUPLICATE):
            more = TRUNCATED_COST if fault == TRUNCATED else 0
            for before in KEEP_BACK.get((state, initial), ()):
                yield more, "K", i - 1, before
            for before in SPEAK_BACK.get(state, ()):
                yield REROLE_COST + more, "R", i - 1, before
    for before in SPEAK_BACK.get(state, ()):
        yield INSERT_COST, "I", i, before


class _Side:
    """One heap with its labels; ``sign`` is 1 forward and -1 in reverse."""

    def __init__(self, rows: list[Row], nodes: list[tuple[int, int]], sign: int):
        self.rows, self.sign = rows, sign
        self.label: dict[tuple[int, int], tuple[int, str]] = {node: (0, "") for node in nodes}
        self.done: set[tuple[int, int]] = set()
        self.heap = [(0, sign * i, state) for i, state in nodes]
        heapq.heapify(self.heap)

    def top(self) -> float:
        while self.heap and (self.sign * self.heap[0][1], self.heap[0][2]) in self.done:
            heapq.heappop(self.heap)
        return self.heap[0][0] if self.heap else float("inf")

    def settle(self) -> tuple[int, int]:
        _, i, state = heapq.heappop(self.heap)
        node = (self.sign * i, state)
        self.done.add(node)
        cost, audit = self.label[node]
        for more, letter, j, to in (_steps if self.sign > 0 else _steps_back)(self.rows, *node):
            new = (cost + more, audit + letter if self.sign > 0 else letter + audit)
            old = self.label.get((j, to))
            if old is None or new < old:
                self.label[j, to] = new
                if old is None or new[0] < old[0]:
                    heapq.heappush(self.heap, (new[0], self.sign * j, to))
        return node


def cheapest_edits(rows: list[Row], entry: int = START, exits: tuple[int, ...] = ENDS) -> tuple[int, str] | None:
    """Least cost and its least audit from a state before the rows to one of the
    states after them; None where no edits lead there."""
    ahead, back = _Side(rows, [(0, entry)], 1), _Side(rows, [(len(rows), e) for e in exits], -1)
    best = float("inf")
    while ahead.top() + back.top() <= best:
        if ahead.top() == back.top() == float("inf"):
            break
        side, other = (ahead, back) if ahead.top() <= back.top() else (back, ahead)
        node = side.settle()
        if node in other.label:
            best = min(best, side.label[node][0] + other.label[node][0])
    # paths that one side has walked to the other's first nodes
    audits = [ahead.label[node][1] for e in exits if (node := (len(rows), e)) in ahead.done and ahead.label[node][0] == best]
    if (0, entry) in back.done and back.label[0, entry][0] == best:
        audits.append(back.label[0, entry][1])
    for node in ahead.done:
        cost, audit = ahead.label[node]
        if node in back.done and cost + back.label[node][0] == best:
            audits.append(audit + back.label[node][1])
        for more, letter, j, to in _steps(rows, *node):
            if (j, to) in back.done and cost + more + back.label[j, to][0] == best:
                audits.append(audit + letter + back.label[j, to][1])
    return (int(best), min(audits)) if audits else None


def repaired(rows: list[tuple[str, str]], audit: str, state: int = START) -> list[tuple[str, str]]:
    """(role, text) after the edits of an audit."""
    out, given = [], iter(rows)
    for letter in audit:
        role, text = ("", "") if letter == "I" else next(given)
        if letter == "D":
            continue
        state = KEEP[state, role[:1]] if letter == "K" else SPEAK[state]
        out.append((role if letter == "K" else ROLES[state], text))
    return out


# --- Spark ------------------------------------------------------------------------


def damaged(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and ``gone``, after damage chosen by
    crc32(``conv_id:turn``) % 20: 0 drops the row, 1 empties its text, 2 takes out
    its ``.!?``, 3 repeats it, 4 makes its role user.  Nulls are one space, but for
    the turn itself."""
    space = F.lit(" ")
    kind = F.crc32(F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), space), F.coalesce(F.col("turn").cast("string"), space))) % 20
    text, role = F.coalesce("text", space), F.coalesce("role", space)
    rows = turns.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        (kind == 0).alias("gone"),
        kind.alias("kind"),
    )
    twice = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", "role", "text", "gone", F.explode(twice).alias("_copy")).drop("_copy")


def _faults(rows: DataFrame) -> DataFrame:
    """The rows with ``first``: the first turn at which role and text stand in the
    conversation, as 0 and a turn or, for a null turn, as -1 and 0."""
    order = F.struct(F.when(F.col("turn").isNull(), -1).otherwise(0).alias("has"), F.coalesce("turn", F.lit(0)).alias("turn"))
    keyed = rows.withColumns({"digest": F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")), "at": order})
    first = keyed.where(~F.col("gone")).groupBy("conv_id", "digest").agg(F.min("at").alias("first"))
    l, r = keyed.alias("l"), first.alias("r")
    joined = l.join(r, F.col("l.conv_id").eqNullSafe(F.col("r.conv_id")) & (F.col("l.digest") == F.col("r.digest")), "left")
    later: Column = F.col("l.at") != F.col("r.first")
    return joined.select("l.conv_id", "l.turn", "l.role", "l.text", "l.gone", F.coalesce(later, F.lit(False)).alias("later"))


_SUMMARY = (
    "n_blank long, n_duplicate long, n_truncated long, n_illegal long, lo long, hi long, n_turns long, "
    "first_turn long, last_turn long, head string, tail string"
)
_ROWS = "rows array<struct<role:string,text:string>>"
_CUT = "part long, seq long, whole boolean"
_SOLVED = "solved array<struct<entry:int,exit:int,cost:long,audit:string>>, n_rows long, sha256 string"


class _Piece:
    """Rows of one conversation as they come, in order."""

    def __init__(self, key):
        self.key, self.rows, self.texts, self.size = key, [], [], 0
        self.counts = {BLANK: 0, DUPLICATE: 0, TRUNCATED: 0}
        self.illegal, self.lo, self.hi, self.n_turns = 0, None, None, 0
        self.first = self.last = None

    def add(self, turn: int | None, role: str, text: str, duplicate: bool) -> None:
        bare = text.rstrip(WHITE)
        fault = BLANK if not bare else DUPLICATE if duplicate else TRUNCATED if bare[-1] not in ".!?" else 0
        if fault:
            self.counts[fault] += 1
        if self.rows and self.rows[-1][0] + role[:1] not in ("su", "ua", "au"):
            self.illegal += 1
        if turn is not None:
            if self.lo is None:
                self.lo = self.first = turn
            self.n_turns += turn != self.last
            self.hi = self.last = turn
        self.rows.append((role[:1], fault))
        self.texts.append((role, text))
        self.size += len(text)

    def full(self) -> bool:
        return len(self.rows) >= PIECE_ROWS or self.size >= PIECE_BYTES

    def record(self, part: int, seq: int, whole: bool, keep_rows: bool) -> dict:
        if whole:
            cost, audit = cheapest_edits(self.rows)
            solved = [(START, ASSISTANT, cost, audit)]
        else:
            pairs = ((a, b, cheapest_edits(self.rows, a, (b,))) for a in range(4) for b in range(4))
            solved = [(a, b, *found) for a, b, found in pairs if found is not None]
        out = repaired(self.texts, solved[0][3]) if whole else []
        return {
            "conv_id": self.key,
            "part": part,
            "seq": seq,
            "whole": whole,
            "n_blank": self.counts[BLANK],
            "n_duplicate": self.counts[DUPLICATE],
            "n_truncated": self.counts[TRUNCATED],
            "n_illegal": self.illegal,
            "lo": self.lo,
            "hi": self.hi,
            "n_turns": self.n_turns,
            "first_turn": self.first,
            "last_turn": self.last,
            "head": self.rows[0][0] if self.rows else None,
            "tail": self.rows[-1][0] if self.rows else None,
            "solved": [dict(zip(("entry", "exit", "cost", "audit"), s, strict=True)) for s in solved],
            "n_rows": len(self.rows),
            "sha256": hashlib.sha256(_lines(out)).hexdigest() if whole else None,
            "rows": [{"role": r, "text": t} for r, t in self.texts] if keep_rows or not whole else None,
        }


def _lines(rows: list[tuple[str, str]]) -> bytes:
    return "\n".join(f"{role}:{text}" for role, text in rows).encode()


def _batches(records: Iterator[dict], schema: pa.Schema, text: str) -> Iterator[pa.RecordBatch]:
    """Records as Arrow batches of at most 1,000, or of a few MB of rows."""
    some, size = [], 0
    for record in records:
        some.append(record)
        size += sum(len(r["text"]) for r in record.get(text) or ())
        if len(some) >= 1000 or size > PIECE_BYTES:
            yield pa.RecordBatch.from_pylist(some, schema)
            some, size = [], 0
    if some:
        yield pa.RecordBatch.from_pylist(some, schema)


def pieces(turns: DataFrame, keep_rows: bool = False) -> DataFrame:
    """Solved pieces of conversations given as (conv_id, turn, role, text, gone).

    A row that is ``gone`` only tells that there is such a conversation.  Rows are
    kept with a piece that has to be joined to others, or if asked for.
    """
    rows = _faults(turns)
    dealt = rows.repartitionByRange(F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), "role", "text")
    ordered = dealt.sortWithinPartitions(F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), "role", "text", "gone")
    key = f"`conv_id` {turns.schema['conv_id'].dataType.simpleString()}"
    schema = f"{key}, {_CUT}, {_SUMMARY}, {_SOLVED}, {_ROWS}"
    names = ["conv_id", "turn", "role", "text", "gone", "later"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        kind: list[pa.DataType] = []

        def records() -> Iterator[dict]:
            piece, seq, edge, before = None, 0, True, None
            for batch in batches:
                kind[:] = [batch.column("conv_id").type]
                for key, turn, role, text, gone, later in zip(*[batch.column(n).to_pylist() for n in names], strict=True):
                    if piece is None:
                        piece = _Piece(key)
                    elif piece.key != key:
                        yield piece.record(part, seq, not edge, keep_rows)
                        piece, seq, edge, before = _Piece(key), seq + 1, False, None
                    if gone:
                        continue
                    if piece.full():
                        yield piece.record(part, seq, False, keep_rows)
                        piece, seq, edge = _Piece(key), seq + 1, True
                    piece.add(turn, role, text, later or before == (turn, role, text))
                    before = (turn, role, text)
            if piece is not None:  # the conversation may go on in the next range
                yield piece.record(part, seq, False, keep_rows)

        stream = records()
        first = next(stream, None)
        if first is not None:
            yield from _batches(_again(first, stream), _arrow(kind[0], _PIECE_FIELDS), "rows")

    return ordered.mapInArrow(run, schema)


def _again(first: dict, rest: Iterator[dict]) -> Iterator[dict]:
    yield first
    yield from rest


_INT, _TEXT = pa.int64(), pa.string()
_SUMMARY_FIELDS = [
    *[(n, _INT) for n in ("n_blank", "n_duplicate", "n_truncated", "n_illegal", "lo", "hi", "n_turns", "first_turn", "last_turn")],
    ("head", _TEXT),
    ("tail", _TEXT),
]
_PIECE_FIELDS = [
    ("part", _INT),
    ("seq", _INT),
    ("whole", pa.bool_()),
    *_SUMMARY_FIELDS,
    ("solved", pa.list_(pa.struct([("entry", pa.int32()), ("exit", pa.int32()), ("cost", _INT), ("audit", _TEXT)]))),
    ("n_rows", _INT),
    ("sha256", _TEXT),
    ("rows", pa.list_(pa.struct([("role", _TEXT), ("text", _TEXT)]))),
]
_PATH = pa.list_(pa.struct([("part", _INT), ("seq", _INT), ("entry", pa.int32()), ("exit", pa.int32()), ("offset", _INT)]))
_RESULT_FIELDS = [
    *[(n, _INT) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
    ("audit", _TEXT),
    ("repaired_sha256", _TEXT),
    ("path", _PATH),
]
_RESULT = (
    "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
    "repaired_sha256 string, path array<struct<part:long,seq:long,entry:int,exit:int,offset:long>>"
)


def _arrow(key: pa.DataType, fields: list) -> pa.Schema:
    return pa.schema([("conv_id", key), *fields])


class _Join:
    """The labels of one conversation after the pieces so far: cost, audit, running
    hash, rows written and the pieces' states."""

    def __init__(self, key):
        self.key = key
        self.labels = {START: (0, "", hashlib.sha256(), 0, ())}
        self.sums = dict.fromkeys(("n_blank", "n_duplicate", "n_truncated", "n_illegal", "n_turns"), 0)
        self.lo = self.hi = self.last = self.tail = None

    def add(self, piece: dict) -> None:
        for name in self.sums:
            self.sums[name] += piece[name]
        if self.tail is not None and piece["head"] is not None:
            self.sums["n_illegal"] += self.tail + piece["head"] not in ("su", "ua", "au")
        self.tail = self.tail if piece["tail"] is None else piece["tail"]
        if piece["lo"] is not None:
            self.sums["n_turns"] -= piece["first_turn"] == self.last
            self.lo, self.hi, self.last = piece["lo"] if self.lo is None else self.lo, piece["hi"], piece["last_turn"]
        best: dict[int, tuple] = {}
        for s in piece["solved"]:
            if s["entry"] in self.labels:
                cost, audit = self.labels[s["entry"]][:2]
                new = (cost + s["cost"], audit + s["audit"], s)
                if s["exit"] not in best or new[:2] < best[s["exit"]][:2]:
                    best[s["exit"]] = new
        rows = [(r["role"], r["text"]) for r in piece["rows"]]
        labels = {}
        for state, (cost, audit, s) in best.items():
            _, _, digest, n, path = self.labels[s["entry"]]
            out = repaired(rows, s["audit"], s["entry"])
            digest = digest.copy()
            if out:
                digest.update((b"\n" if n else b"") + _lines(out))
            # a linked list: labels share their past
            labels[state] = (cost, audit, digest, n + len(out), (path, (piece["part"], piece["seq"], s["entry"], state, n)))
        self.labels = labels

    def record(self) -> dict:
        cost, audit, digest, _, path = min((self.labels[s] for s in ENDS if s in self.labels), key=lambda x: x[:2])
        steps = []
        while path:
            path, step = path
            steps.append(dict(zip(("part", "seq", "entry", "exit", "offset"), step, strict=True)))
        return {
            "conv_id": self.key,
            "gaps": 0 if self.lo is None else self.hi - self.lo + 1 - self.sums["n_turns"],
            "blank": self.sums["n_blank"],
            "duplicate": self.sums["n_duplicate"],
            "truncated": self.sums["n_truncated"],
            "illegal": self.sums["n_illegal"],
            "cost": cost,
            "audit": audit,
            "repaired_sha256": digest.hexdigest(),
            "path": steps[::-1],
        }


def joined(solved: DataFrame) -> DataFrame:
    """One row per conversation from its solved pieces."""
    one = F.get("solved", F.lit(0))
    path = F.array(F.struct("part", "seq", one["entry"].alias("entry"), one["exit"].alias("exit"), F.lit(0).cast("long").alias("offset")))
    gaps = F.coalesce(F.col("hi") - F.col("lo") + 1 - F.col("n_turns"), F.lit(0)).cast("long")
    whole = solved.where("whole").select(
        "conv_id",
        gaps.alias("gaps"),
        F.col("n_blank").alias("blank"),
        F.col("n_duplicate").alias("duplicate"),
        F.col("n_truncated").alias("truncated"),
        F.col("n_illegal").alias("illegal"),
        one["cost"].alias("cost"),
        one["audit"].alias("audit"),
        F.col("sha256").alias("repaired_sha256"),
        path.alias("path"),
    )
    cut = solved.where("not whole").repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind: list[pa.DataType] = []

        def records() -> Iterator[dict]:
            at = None
            for batch in batches:
                kind[:] = [batch.column("conv_id").type]
                for row in range(batch.num_rows):  # one piece at a time: pieces hold texts
                    piece = batch.slice(row, 1).to_pylist()[0]
                    if at is None or at.key != piece["conv_id"]:
                        if at is not None:
                            yield at.record()
                        at = _Join(piece["conv_id"])
                    at.add(piece)
            if at is not None:
                yield at.record()

        stream = records()
        first = next(stream, None)
        if first is not None:
            yield from _batches(_again(first, stream), _arrow(kind[0], _RESULT_FIELDS), "rows")

    key = f"`conv_id` {solved.schema['conv_id'].dataType.simpleString()}"
    return whole.unionByName(cut.mapInArrow(run, f"{key}, {_RESULT}"))


def repair_summary(turns: DataFrame) -> DataFrame:
    """One row per conversation of (conv_id, turn, role, text[, gone]): gaps, blank,
    duplicate, truncated, illegal, cost, audit, repaired_sha256, and the path that
    ``repaired_turns`` follows.

    Rows go by turn (null first), then role and text.  Null role and text are one
    space, a null conv_id is a conversation of its own.  A row's first fault counts:
    blank, duplicate (role and text stood earlier; of equal rows all but one),
    truncated (last character not ``.!?``).  Other columns are not read.  A
    conversation without rows (all ``gone``) has zeros, an empty audit and the hash
    of nothing; an empty table gives no rows.  Long conversations are cut, see above;
    their audit is one text, as the result asks for.
    """
    return joined(stored(pieces(_plain(turns))))


def _plain(turns: DataFrame) -> DataFrame:
    gone = F.coalesce("gone", F.lit(False)) if "gone" in turns.columns else F.lit(False)
    space = F.lit(" ")
    return turns.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), gone.alias("gone"))


def repaired_turns(turns: DataFrame) -> DataFrame:
    """conv_id, position (from 0), role, text: the conversations after the cheapest
    edits.  Input as for ``repair_summary``; a conversation of which nothing is left
    gives no rows."""
    solved = stored(pieces(_plain(turns), keep_rows=True))
    steps = joined(solved).select(F.explode("path").alias("at")).select("at.*")
    with_path = solved.select("conv_id", "part", "seq", "solved", "rows").join(steps, ["part", "seq"])
    key = f"`conv_id` {turns.schema['conv_id'].dataType.simpleString()}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind = batch.column("conv_id").type
            for row in range(batch.num_rows):
                piece = batch.slice(row, 1).to_pylist()[0]
                audit = next(s["audit"] for s in piece["solved"] if (s["entry"], s["exit"]) == (piece["entry"], piece["exit"]))
                out = repaired([(r["role"], r["text"]) for r in piece["rows"]], audit, piece["entry"])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([piece["conv_id"]] * len(out), kind),
                        pa.array([piece["offset"] + i for i in range(len(out))], _INT),
                        pa.array([r for r, _ in out], _TEXT),
                        pa.array([t for _, t in out], _TEXT),
                    ],
                    names=["conv_id", "position", "role", "text"],
                )

    return with_path.mapInArrow(run, f"{key}, position long, role string, text string")
