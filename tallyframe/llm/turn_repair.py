"""Conversation structure repair by Hirschberg's divide and conquer (operator 11).

The roles of a sound conversation read ``(s?(ua)+)?`` by their initials: an optional system turn,
then user and assistant in turn.  Rows are kept, given another role or deleted, and empty turns are
inserted, at least cost.  Where a conversation stands is one of four states (nothing yet, after
system, after user, after assistant), so the edits are a shortest path through rows x states.

The path is found in linear space: a forward vector of four costs over the first half of the rows
meets a backward one over the second half, the cheapest crossing in the middle is chosen, and both
halves are solved alike.  Of equal paths the one whose audit (the initials of its edits) is ASCII
least counts: the forward vector carries the order of its states' least audits.  These audits end
with a row's edit and consume the same rows, so none is the beginning of another and their order
alone decides between crossings.

A vector less its smallest cost takes few values, so a step is a look up in a table that is filled
as needed.  Only a conversation's codes, a byte a row, are held; its texts pass as a stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Costs of giving another role, deleting, inserting, and of a truncated row that stays.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: States; what may be kept in each by role initial, and the role that is inserted or given there.
START, SYSTEM, USER, ASSISTANT = range(4)
_KEEPS = {START: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
_GIVES = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
_ROLE = {USER: "user", ASSISTANT: "assistant"}
#: Empty turns that complete a conversation.
_ENDING = {START: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}
_REACHES = {START: {START}, SYSTEM: {START, SYSTEM}, USER: set(range(4)), ASSISTANT: set(range(4))}
#: A forward state this much above the least is on no cheapest path: any state can do what another
#: does for two inserts, a deletion and a role more.
SLACK = 32

#: A row's code is a letter: its role's initial (s, u, a, another) and its first fault.
INITIALS = "sua"
FINE, CUT, BLANK, DUPLICATE = range(4)
_FIRST = ord("A")
_SPACES = " \t\n\x0b\x0c\r"

_Vector = tuple[tuple[int, int] | None, ...]


def _edges(code: int) -> list[tuple[int, str, int, int]]:
    """(state, edits, next state, cost) of all ways to consume a row, after inserts or without."""
    initial, fault = INITIALS[code % 4:code % 4 + 1], code // 4
    stays, out = TRUNCATED if fault == CUT else 0, []
    for before in range(4):
        state = before
        for n in range(3):
            ins = "I" * n
            out.append((before, ins + "D", state, n * INSERT + DELETE))
            if fault in (FINE, CUT):
                if initial in _KEEPS[state]:
                    out.append((before, ins + "K", _KEEPS[state][initial], n * INSERT + stays))
                out.append((before, ins + "R", _GIVES[state], n * INSERT + REROLE + stays))
            state = _GIVES[state]
    return out


class _Solver:
    """The step tables of both directions; one for all conversations of a task."""

    def __init__(self):
        self.edges = [_edges(c) for c in range(16)]
        self.forward_steps: dict[tuple[_Vector, int, int], tuple[_Vector, int]] = {}
        self.backward_steps: dict[tuple[tuple, int], tuple[tuple, int]] = {}

    def _forward_step(self, vector: _Vector, code: int, goal: int) -> tuple[_Vector, int]:
        found: dict[int, tuple] = {}
        for state, edits, to, cost in self.edges[code]:
            if vector[state] is not None and to in _REACHES[goal]:
                key = (vector[state][0] + cost, vector[state][1], edits)
                found[to] = min(found.get(to, key), key)
        least = min(k[0] for k in found.values())
        ranked = sorted((k[1:], to) for to, k in found.items() if k[0] <= least + SLACK)
        out: list = [None] * 4
        for rank, (_, to) in enumerate(ranked):
            out[to] = (found[to][0] - least, rank)
        return tuple(out), least

    def forward(self, codes: bytes, state: int, goal: int) -> tuple[_Vector, int]:
        """Costs from ``state`` (and the order of the least audits) after all rows, less a base."""
        vector: _Vector = tuple((0, 0) if s == state else None for s in range(4))
        base, steps = 0, self.forward_steps
        for code in codes:
            key = (vector, code, goal)
            if key not in steps:
                steps[key] = self._forward_step(*key)
            vector, more = steps[key]
            base += more
        return vector, base

    def _backward_step(self, vector: tuple, code: int) -> tuple[tuple, int]:
        out: list = [None] * 4
        for state, _, to, cost in self.edges[code]:
            if vector[to] is not None and (out[state] is None or vector[to] + cost < out[state]):
                out[state] = vector[to] + cost
        least = min(c for c in out if c is not None)
        return tuple(None if c is None else c - least for c in out), least

    def backward(self, codes: bytes, goal: int) -> tuple:
        """Costs of each state before all rows to ``goal`` after them, less a base."""
        vector, steps = tuple(0 if s == goal else None for s in range(4)), self.backward_steps
        for code in reversed(codes):
            key = (vector, code)
            if key not in steps:
                steps[key] = self._backward_step(*key)
            vector, _ = steps[key]
        return vector

    def _between(self, codes: bytes, state: int, goal: int) -> str:
        """The cheapest edits, ASCII least, from ``state`` to ``goal`` right after the last row."""
        if len(codes) == 1:
            return min((cost, edits) for s, edits, to, cost in self.edges[codes[0]] if (s, to) == (state, goal))[1]
        half = len(codes) // 2
        ahead, _ = self.forward(codes[:half], state, goal)
        behind = self.backward(codes[half:], goal)
        crossing = min((a[0] + b, a[1], s) for s, (a, b) in enumerate(zip(ahead, behind))
                       if a is not None and b is not None)[2]
        return self._between(codes[:half], state, crossing) + self._between(codes[half:], crossing, goal)

    def solve(self, codes: bytes) -> tuple[int, str]:
        """Cost and audit of a conversation's rows, by their codes (0 to 15)."""
        if not codes:
            return 0, ""
        vector, base = self.forward(codes, START, ASSISTANT)
        cost, _, last = min((x[0] + INSERT * _ENDING[s], x[1], s) for s, x in enumerate(vector) if x is not None)
        return base + cost, self._between(codes, START, last) + "I" * _ENDING[last]


# Rows ----------------------------------------------------------------------------------
def _rows(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    shown = [F.coalesce(F.col(f"`{c}`"), F.lit(" ")).alias(name) for c, name in ((role_col, "role"), (text_col, "text"))]
    return turns.select(F.col(f"`{conv_col}`").alias("conv"), F.col(f"`{turn_col}`").cast("bigint").alias("turn"),
                        *shown).withColumn("key", F.md5("text"))


def _coded(rows: DataFrame) -> DataFrame:
    """``(conv, turn, role, key, codes)``: rows that are alike in one, a letter for each of them."""
    bare = F.rtrim(F.col("text"), F.lit(_SPACES))
    seen = rows.select("conv", "turn", "role", "key", (bare == "").alias("blank"), (~F.substring(bare, -1, 1).isin(
        ".", "!", "?")).alias("cut")).groupBy("conv", "turn", "role", "key").agg(
        F.count("*").alias("times"), F.first("blank").alias("blank"), F.first("cut").alias("cut"))
    place = F.struct(F.col("turn").isNotNull().alias("known"), "turn")  # null turns first
    first = seen.groupBy(F.col("conv").alias("f_conv"), F.col("role").alias("f_role"), F.col("key").alias("f_key")).agg(
        F.min(place).alias("first"))
    both = seen.join(first, F.col("conv").eqNullSafe(F.col("f_conv")) & (F.col("role") == F.col("f_role")) & (
        F.col("key") == F.col("f_key")))
    initial = F.substring("role", 1, 1)
    kind = F.coalesce(*[F.when(initial == c, i) for i, c in enumerate(INITIALS)], F.lit(3))

    def letter(fault) -> Column:
        return F.char(F.lit(_FIRST) + kind + 4 * fault)

    again = F.when(F.col("blank"), BLANK).otherwise(DUPLICATE)
    own = F.when(F.col("blank"), BLANK).when(place != F.col("first"), DUPLICATE).when(F.col("cut"), CUT).otherwise(FINE)
    return both.select("conv", "turn", "role", "key", F.concat(
        letter(own), F.repeat(letter(again), (F.col("times") - 1).cast("int"))).alias("codes"))


def _illegal(codes: np.ndarray) -> int:
    """Neighbours whose initials are not su, ua or au."""
    a, b = codes[:-1] % 4, codes[1:] % 4
    s, u, x = (INITIALS.index(c) for c in "sua")
    return int(len(a) - (((a == s) & (b == u)) | ((a == u) & (b == x)) | ((a == x) & (b == u))).sum())


def _stream(batches, *columns: str) -> tuple[Iterator[tuple], pa.DataType]:
    """Rows of the batches as tuples, and the type of the first column."""
    first = next(batches, None)
    if first is None:
        return iter(()), pa.null()
    rows = (row for batch in chain([first], batches) for row in zip(*[batch.column(c).to_pylist() for c in columns]))
    return rows, first.schema.field(columns[0]).type


_PLAN = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _plans(batches):
    solver, out = _Solver(), []
    rows, conv_type = _stream(batches, "conv", "turn", "codes")

    def plan(conv, codes: bytearray, least, most, distinct) -> tuple:
        c = np.frombuffer(bytes(codes), np.uint8) - _FIRST
        faults = np.bincount(c // 4, minlength=4)
        cost, audit = solver.solve(c.tobytes())
        gaps = most - least + 1 - distinct if distinct else 0
        return conv, gaps, int(faults[BLANK]), int(faults[DUPLICATE]), int(faults[CUT]), _illegal(c), cost, audit

    def flush():
        cols = list(zip(*out)) or [()] * 8
        kinds = [conv_type, *[pa.int64()] * 6, pa.string()]
        batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], ["conv", *_PLAN, "audit"])
        out.clear()
        return batch

    at = None
    for conv, turn, codes in rows:
        if at is None or at[0] != conv:
            if at is not None:
                out.append(plan(*at))
                if len(out) >= 1000 or len(out[-1][-1]) > 1 << 16:
                    yield flush()
            at = [conv, bytearray(), None, None, 0]
        at[1] += codes.encode()
        if turn is not None and turn != at[3]:
            at[2] = turn if at[4] == 0 else at[2]
            at[3], at[4] = turn, at[4] + 1
    if at is not None:
        out.append(plan(*at))
    if out:
        yield flush()


def plan_repairs(turns: DataFrame, conversations: DataFrame | None = None, conv_col: str = "conv_id",
                 turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation: ``conv_col, gaps, blank, duplicate, truncated, illegal, cost, audit``.

    Faults count once per row, the first that applies: blank (no character but ASCII white space),
    duplicate (role and text stand earlier in the conversation), truncated (the last character that
    is not white space is none of ``.!?``).  ``gaps`` are the turn numbers missing between the
    smallest and the largest, ``illegal`` the neighbours whose role initials are not su, ua or au.
    ``audit`` holds the initials of the cheapest edits in order: Keep (free), Rerole to user or
    assistant, Delete (needed for blank and duplicate rows), Insert of an empty turn.
    ``conversations`` adds ids that are reported even if no row is left of them.

    Defined results: rows are ordered by (turn, role, md5 of the text), null turns first, so ties and
    repeated rows have a place; null roles and texts are one space; null conversation ids form one
    conversation; without turn numbers there are no gaps; roles of other initials can't be kept; an
    empty table gives no row; other columns are ignored.  The audit is one string by nature: a
    conversation's codes, a byte a row, meet in one task; its texts do not.
    """
    rows = _rows(turns, conv_col, turn_col, role_col, text_col)
    coded = _coded(rows)
    if conversations is not None:
        ids = conversations.select(F.col(f"`{conv_col}`").alias("conv")).distinct()
        none = [F.lit(None).cast(kind).alias(c) for c, kind in (("turn", "bigint"), ("role", "string"), ("key", "string"))]
        coded = coded.unionByName(ids.select("conv", *none, F.lit("").alias("codes")))
    conv = rows.schema["conv"].dataType
    found = coded.repartition("conv").sortWithinPartitions("conv", "turn", "role", "key").select(
        "conv", "turn", "codes").mapInArrow(
        _plans, f"conv {conv.simpleString()}, {', '.join(f'{c} bigint' for c in _PLAN)}, audit string")
    return found.withColumnRenamed("conv", conv_col)


# Texts ---------------------------------------------------------------------------------
#: Repaired rows a batch, and bytes of text after which one is closed.
_BATCH, _BATCH_CHARS = 2000, 1 << 20


def _edited(rows: Iterator[tuple]) -> Iterator[tuple]:
    """(conv, step, edit, turn, role, text) of every repaired turn; a conversation's first row has
    its audit, those after it are its rows in order."""
    conv = audit = None
    at = step = state = 0

    def inserts():
        nonlocal at, step, state
        while audit is not None and at < len(audit) and audit[at] == "I":
            state = _GIVES[state]
            at, step = at + 1, step + 1
            yield conv, step, "I", None, _ROLE[state], ""

    for key, plan, turn, role, text in rows:
        if plan is not None:
            yield from inserts()
            conv, audit, at, step, state = key, plan, 0, 0, START
            continue
        yield from inserts()
        edit, at = audit[at], at + 1
        if edit == "D":
            continue
        step += 1
        if edit == "R":
            state = _GIVES[state]
            role = _ROLE[state]
        else:
            state = _KEEPS[state][role[:1]]
        yield conv, step, edit, turn, role, text
    yield from inserts()


def _repaired(batches):
    rows, conv_type = _stream(batches, "conv", "audit", "turn", "role", "text")
    kinds = [conv_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string()]
    names = ["conv", "step", "edit", "turn", "role", "text"]
    out, size = [], 0

    def flush():
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    for row in _edited(rows):
        out.append(row)
        size += len(row[-1])
        if len(out) >= _BATCH or size > _BATCH_CHARS:
            yield flush()
            out, size = [], 0
    if out:
        yield flush()


def repair(turns: DataFrame, plans: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
           role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The repaired turns, ``conv_col, step, edit, turn, role, text``: step numbers a conversation's
    turns from 1, edit is K, R or I, and inserted turns have no turn number and an empty text.

    ``plans`` is what ``plan_repairs`` gave for the same rows.  A conversation's rows stand one after
    another, in order, in one partition, and pass through it as a stream.
    """
    rows = _rows(turns, conv_col, turn_col, role_col, text_col).select(
        "conv", F.lit(1).alias("kind"), F.lit(None).cast("string").alias("audit"), "turn", "role", "text", "key")
    heads = plans.select(
        F.col(f"`{conv_col}`").alias("conv"), F.lit(0).alias("kind"), "audit", F.lit(None).cast("bigint").alias("turn"),
        *[F.lit(None).cast("string").alias(c) for c in ("role", "text", "key")])
    conv = rows.schema["conv"].dataType
    found = rows.unionByName(heads).repartition("conv").sortWithinPartitions(
        "conv", "kind", "turn", "role", "key").select("conv", "audit", "turn", "role", "text").mapInArrow(
        _repaired, f"conv {conv.simpleString()}, step bigint, edit string, turn bigint, role string, text string")
    return found.withColumnRenamed("conv", conv_col)


def _digests(batches, conv_col: str):
    conv, hashed, out = None, None, []
    rows, conv_type = _stream(batches, conv_col, "step", "role", "text")

    def flush():
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(
            zip(*out), (conv_type, pa.string()))], [conv_col, "repaired_sha256"])

    for key, step, role, text in rows:
        if step == 1:
            if hashed is not None:
                out.append((conv, hashed.hexdigest()))
                if len(out) >= 10_000:
                    yield flush()
                    out = []
            conv, hashed = key, hashlib.sha256()
        hashed.update((f"{role}:{text}" if step == 1 else f"\n{role}:{text}").encode())
    if hashed is not None:
        out.append((conv, hashed.hexdigest()))
    if out:
        yield flush()


def digests(repaired: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """``(conv_col, repaired_sha256)`` of the newline-joined ``role:text`` of each conversation's
    turns; ``repaired`` comes as ``repair`` gave it, in its order.  No row for one without turns."""
    conv = repaired.schema[conv_col].dataType
    return repaired.select(conv_col, "step", "role", "text").mapInArrow(
        lambda it: _digests(it, conv_col), f"`{conv_col}` {conv.simpleString()}, repaired_sha256 string")
