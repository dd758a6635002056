import hashlib
import itertools
import random
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from creatorlens.llm import repair

SCHEMA = "conv_id long, turn long, role string, text string"


def cheapest(letters):
    """Every edit of every row, every insertion between (at most two in one place): plain enumeration by rows."""
    paths = {0: (0, "")}  # by place

    def insert(paths):
        for _ in range(3):
            for p, (c, a) in list(paths.items()):
                q = {0: 2, 1: 2, 2: 3, 3: 2}[p]
                paths[q] = min(paths.get(q, (10**9, "")), (c + 5, a + "I"))
        return paths

    for x in letters:
        out = {}
        for p, (c, a) in insert(paths).items():
            ways = [(p, 2, "D")]
            if x not in "1234":
                more = 5 * x.isupper()
                q = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}.get(x.lower(), {}).get(p)
                ways += [(q, more, "K")] * (q is not None) + [({0: 2, 1: 2, 2: 3, 3: 2}[p], 1 + more, "R")]
            for q, d, e in ways:
                out[q] = min(out.get(q, (10**9, "")), (c + d, a + e))
        paths = out
    paths = insert(paths)
    return min(paths[p] for p in (0, 3) if p in paths)


@settings(max_examples=300, deadline=None)
@given(st.text("suaxSUAX1234", max_size=14))
def test_branch_and_bound_is_optimal(letters):
    assert repair.branch_and_bound(letters, repair.START, repair.DONE) == cheapest(letters)


def test_stretches_put_together():
    r = random.Random(5)
    for n in (31, 32, 33, 64, 90, 300):
        letters = "".join(r.choices("uaxsUA1", weights=[9, 9, 1, 1, 1, 1, 1], k=n))
        assert repair.repaired(letters) == cheapest(letters)


def test_all_short_letters():
    for n in range(5):
        for letters in map("".join, itertools.product("suaU1x", repeat=n)):
            assert repair.branch_and_bound(letters, repair.START, repair.DONE) == cheapest(letters)


def brute(rows, damage=True):
    blanks = " \t\n\x0b\x0c\r"
    after = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20 if damage else 9
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        after += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = []
    for conv in {r[0] for r in rows}:
        own = sorted((r[1:] for r in after if r[0] == conv), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, letters, count = set(), "", {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, role, text in own:
            end = text.rstrip(blanks)
            fault = "blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                count[fault] += 1
            head = role[:1] if role[:1] in ("s", "u", "a") else "x"
            letters += "1234"["suax".index(head)] if fault in ("blank", "duplicate") else head.upper() if fault else head
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        heads = [role[:1] for _, role, _ in own]
        wrong = sum(a + b not in ("su", "ua", "au") for a, b in zip(heads, heads[1:]))
        cost, audit = cheapest(letters)
        lines, rest, last = [], iter(own), ""
        for e in audit:
            _, role, text = next(rest) if e != "I" else (0, "", "")
            if e == "D":
                continue
            if e in "RI":
                role = "assistant" if last == "u" else "user"
            last = role[0]
            lines.append(f"{role}:{text}")
        out.append((conv, gaps, *count.values(), wrong, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=repr)


def _run(spark, rows, damage=True, parts=4):
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    from pyspark.sql import functions as F
    after = repair.damaged(df) if damage else df.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), F.lit(1).cast("long").alias("copies"))
    return sorted([tuple(r) for r in repair.repair(after, df).collect()], key=repr)


def messy(seed=1, convs=40):
    r = random.Random(seed)
    rows = []
    for c in range(convs):
        for t in range(r.choice([0, 1, 2, 5, 9])):
            rows.append((c, r.choice([t, t, t, t + 3, None]), r.choice(["user", "assistant", "user", "assistant", "system", "tool", None, ""]),
                         r.choice(["Yes.", "No!", "maybe", "", None, " \n", "Is it?\n ", "é…", "Yes.", f"text {t}."])))
    rows += rows[:15] + [(None, 1, "user", "Hi."), (None, 2, "assistant", "Ho."), (None, None, None, None)]
    return rows


@pytest.mark.parametrize("damage", [True, False])
def test_against_brute_force(spark, damage):
    rows = messy()
    assert _run(spark, rows, damage) == brute(rows, damage)


def test_a_conversation_that_holds_most_rows(spark, monkeypatch):
    """Cut over tasks and pieces; rows that repeat thousands of times."""
    monkeypatch.setattr(repair, "PIECE", 50)
    r = random.Random(2)
    rows = [(7, t, r.choice(["user", "assistant"]), r.choice([f"t{t}.", f"t{t}", "same."])) for t in range(1500)]
    rows += [(7, 99, "user", "again and again.")] * 400 + [(8, 0, "user", "a."), (8, 1, "assistant", "b.")] + messy(3, 10)
    assert _run(spark, rows, True, 7) == brute(rows, True)


def test_nothing(spark):
    assert _run(spark, [], True, 1) == []
    dropped = next(t for t in range(1000) if zlib.crc32(f"1:{t}".encode()) % 20 == 0)
    (row,) = _run(spark, [(1, dropped, "user", "gone")])
    assert row == (1, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
