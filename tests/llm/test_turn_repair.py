"""Operator 11 against exhaustive search over edits and on awkward tables."""
import hashlib
import heapq
import itertools
import random
import re
import zlib

import pytest

from tallyframe.llm import queries, turn_repair

SCHEMA = "conv_id long, turn long, role string, text string, conv string, audit string"


def faults(rows):
    """First fault of each (role, text)."""
    out, seen = [], set()
    for role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else
                   "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def brute(rows):
    """Cheapest, then ASCII least edits by a search over all (row, state) paths, cost by cost."""
    marks = faults(rows)
    goal, best = len(rows), {}
    heap = [(0, "", 0, "", ())]
    while heap:
        cost, audit, i, roles, said = heapq.heappop(heap)
        key = (i, roles)
        if key in best:
            continue
        best[key] = cost, audit
        if i == goal and roles in ("", "a"):
            return cost, audit, list(said)
        after = {"": "su", "s": "u", "u": "a", "a": "u"}[roles]
        give = "a" if roles == "u" else "u"
        name = {"a": "assistant", "u": "user"}[give]
        heapq.heappush(heap, (cost + 3, audit + "I", i, give, (*said, name + ":")))
        if i < goal:
            role, text = rows[i]
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, roles, said))
            if marks[i] in ("", "truncated"):
                more = 3 if marks[i] else 0
                if role[:1] and role[0] in after:
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, role[0], (*said, f"{role}:{text}")))
                heapq.heappush(heap, (cost + 3 + more, audit + "R", i + 1, give, (*said, f"{name}:{text}")))
    raise AssertionError("no way")


def code(role, mark):
    initial = turn_repair.INITIALS.find(role[:1]) if role[:1] else -1
    kind = {"": turn_repair.FINE, "truncated": turn_repair.CUT, "blank": turn_repair.BLANK}.get(mark, turn_repair.DUPLICATE)
    return (initial if initial >= 0 else 3) + 4 * kind


def test_solver_equals_search():
    solver, rng = turn_repair._Solver(), random.Random(5)
    for short in itertools.product([("system", "x."), ("user", "y."), ("assistant", "z"), ("tool", "")], repeat=4):
        cost, audit, _ = brute(list(short))
        assert solver.solve(bytes(code(r, m) for (r, _), m in zip(short, faults(short)))) == (cost, audit)
    for _ in range(400):
        rows = [(rng.choice(["system", "user", "assistant", "assistant", "user", "tool", ""]),
                 rng.choice(["", " ", "a.", "b?", "c", "d!", f"{rng.random()}.", f"{rng.random()}"]))
                for _ in range(rng.randint(0, 40))]
        cost, audit, _ = brute(rows)
        assert solver.solve(bytes(code(r, m) for (r, _), m in zip(rows, faults(rows)))) == (cost, audit)


def test_long_conversation_is_cheap():
    rng, solver = random.Random(9), turn_repair._Solver()
    codes = bytes(rng.choice([0, 1, 2, 3, 1, 2, 5, 6, 8, 13]) for _ in range(100_000))
    cost, audit = solver.solve(codes)
    assert sum(c in "KRD" for c in audit) == len(codes)
    assert len(solver.forward_steps) < 5000 and len(solver.backward_steps) < 5000
    price = {"D": 4, "I": 3, "R": 3, "K": 0}
    kept = [(c, code_ // 4) for c, code_ in zip(audit.replace("I", ""), codes)]
    assert cost == sum(price[c] for c in audit) + 3 * sum(c in "KR" and f == 1 for c, f in kept)


AWKWARD = [(1, 0, "user", "hi."), (1, 0, "user", "hi."), (1, 1, "user", "hi."), (1, 5, "assistant", None),
           (1, None, "system", "be good."), (2, None, None, None), (2, None, None, None), (3, 7, "tool", "x"),
           (3, 7, "assistant", "later"), (3, 7, "assistant", "late."), (None, 0, "user", "no id?"),
           (None, 3, "assistant", "no id!"), (4, 0, "assistant", "first " * 20000), (4, 2, "", "é😀."),
           (5, 0, "system", "s."), (6, 0, "user", "\x1f."), (6, 1, "assistant", " ")]


def expected(rows):
    """By conversation, as plan_repairs and digests give it."""
    out = {}
    for conv in {r[0] for r in rows}:
        own = [(t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows if c == conv]
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
        turns = [r[0] for r in own if r[0] is not None]
        pairs = [(r, x) for _, r, x in own]
        marks = faults(pairs)
        cost, audit, said = brute(pairs)
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(pairs, pairs[1:]))
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *[
            marks.count(m) for m in ("blank", "duplicate", "truncated")], illegal, cost, audit,
            hashlib.sha256("\n".join(said).encode()).hexdigest())
    return out


def outcome(turns, ids=None):
    plans = turn_repair.plan_repairs(turns, ids)
    repaired = turn_repair.repair(turns, plans)
    digests = {r[0]: r[1] for r in turn_repair.digests(repaired).collect()}
    none = hashlib.sha256(b"").hexdigest()
    return {r[0]: (*r[1:], digests.get(r[0], none)) for r in plans.collect()}, repaired


def test_awkward_rows(spark):
    df = spark.createDataFrame([(*r, "z", "q") for r in AWKWARD], SCHEMA).repartition(4)
    got, repaired = outcome(df)
    assert got == expected(AWKWARD)
    steps = {}
    for r in repaired.orderBy("step").collect():
        steps.setdefault(r["conv_id"], []).append(r)
    for conv, rows in steps.items():
        assert [r["step"] for r in rows] == list(range(1, len(rows) + 1))
        said = "\n".join(f"{r['role']}:{r['text']}" for r in rows)
        assert hashlib.sha256(said.encode()).hexdigest() == got[conv][-1]
        assert "".join(r["edit"] for r in rows) == got[conv][-2].replace("D", "")


def test_empty_and_extra_conversations(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert outcome(df)[0] == {}
    got, _ = outcome(df, spark.createDataFrame([(7,), (None,), (7,)], "conv_id long"))
    none = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert got == {7: none, None: none}


def test_random_conversations_and_query_damage(spark, tmp_path):
    rng = random.Random(3)
    rows = [(c, t, rng.choice(["system", "user", "assistant", "user", None]),
             rng.choice(["yes.", "no", "so?", f"w{rng.randint(0, 99)}!", None, "a.b!c?"]))
            for c in range(60) for t in range(rng.randint(1, 15))]
    rows += [(None, t, "user", "x.") for t in range(25)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(
        str(tmp_path / "conversations.parquet"))
    after = []
    for c, t, role, text in rows:
        fault = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        after += [(c, t, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    want = expected(after)
    none = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    got = {r[0]: tuple(r[1:]) for r in queries.op11_turn_repair(spark, str(tmp_path)).collect()}
    assert got == {c: want.get(c, none) for c in {r[0] for r in rows}}


@pytest.mark.parametrize("times", [1, 4])
def test_repeated_rows_are_one_letter_each(spark, times):
    df = spark.createDataFrame([(1, 0, "user", "a."), (1, 1, "assistant", "b.")] * times,
                               "conv_id long, turn long, role string, text string")
    (row,) = turn_repair.plan_repairs(df).collect()
    assert row["audit"] == "K" + "D" * (times - 1) + "K" + "D" * (times - 1)
    assert row["duplicate"] == 2 * (times - 1)
