"""Conversation structure repair by depth-first branch-and-bound.

A conversation is well formed if its roles' initials read ``(s?(ua)+)?``.  Rows are kept (0), reroled to user or
assistant (1) or deleted (2, a must for blank and duplicate rows); empty user and assistant turns may be inserted
anywhere (5); a truncated row that is not deleted costs 5 more.  The cheapest edits are found, among equal costs
those whose initials (D, I, K, R in order) come first.

The search keeps an explicit stack of nodes (row, place in the pattern, cost, audit).  A node is given up if its cost
and a lower bound for the rows left exceed the incumbent's (cost, audit), or equal its cost with an audit that is not
smaller; or if the table of its (row, place) holds a better prefix.  The bound adds up what each row costs at least,
and one more for each two neighbours that cannot both stay as they are.  When the stack is empty the incumbent is
optimal.

Long conversations: rows are dealt by ranges of (conversation, turn, role, text), so one that holds a third of all
rows lies in many tasks, one letter for each row.  A stretch of ``STRETCH`` letters is searched from every place in the
pattern to every other; stretches are put together by adding costs and joining audits.  That is exact: two prefixes of
equal cost that end in one place are never prefixes of each other, so the smaller audit stays smaller.  Only the
hash of the repaired text reads a conversation in one task, as its definition asks; that task streams rows and holds
the audit, one letter for each edit.

Null roles and texts are one space.  Rows are in order of turn (nulls first), role, text; equal rows are counted, not
repeated, on the way.  Rows without a conversation id form one conversation.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creatorlens.llm.common import table, written

KEEP, REROLE, DELETE, INSERT, CUT = 0, 1, 2, 5, 5  # costs; CUT: a truncated row that stays
STRETCH = 32  # rows searched at once
PIECE = 1 << 12  # rows of a piece of a conversation that one row of the tables between describes
BLANKS = " \t\n\x0b\x0c\r"

# places in the pattern: nothing yet, after s, after u, after a
START, SYSTEM, USER, ASSISTANT = range(4)
AFTER = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
NEXT = {START: ("u", USER), SYSTEM: ("u", USER), USER: ("a", ASSISTANT), ASSISTANT: ("u", USER)}  # of reroled and inserted turns
DONE = (START, ASSISTANT)

# A row's letter: s, u, a or x (another initial); capital if truncated; 1 to 4 in that order if it must go.
GONE = dict(zip("1234", "suax"))


def initial(letter: str) -> str:
    return GONE.get(letter) or letter.lower()


def suffix_bounds(letters: str) -> list[int]:
    """What the rows from each place on cost at least."""
    out = [0] * (len(letters) + 2)
    for i in range(len(letters) - 1, -1, -1):
        x = letters[i]
        own = DELETE if x in GONE or x.isupper() else REROLE if x == "x" else 0
        out[i] = out[i + 1] + own
        if i + 1 < len(letters) and x in "ua" and letters[i + 1] == x:  # one of two equal neighbours is edited, or a turn comes between
            out[i] = max(out[i], out[i + 2] + 1)
    return out


def branch_and_bound(letters: str, entry: int, goals: tuple[int, ...]) -> tuple[int, str] | None:
    """The least (cost, audit) that leads from ``entry`` past all rows to one of ``goals``."""
    n, bound = len(letters), suffix_bounds(letters)
    incumbent: tuple[int, str] | None = None
    best: dict[tuple[int, int], tuple[int, str]] = {}
    stack = [(0, entry, 0, "")]
    while stack:
        at, place, cost, audit = stack.pop()
        if incumbent is not None:
            hope = cost + bound[at]
            if hope > incumbent[0] or (hope == incumbent[0] and audit > incumbent[1][:len(audit)]):
                continue
        if (known := best.get((at, place))) is not None and known <= (cost, audit):
            continue
        best[at, place] = cost, audit
        if at == n and place in goals and (incumbent is None or (cost, audit) < incumbent):
            incumbent = cost, audit
        role, then = NEXT[place]
        children = [(INSERT, "I", at, then)]
        if at < n:
            x = letters[at]
            children.append((DELETE, "D", at + 1, place))
            if x not in GONE:
                more = CUT if x.isupper() else 0
                if (kept := AFTER.get(x.lower(), {}).get(place)) is not None:
                    children.append((KEEP + more, "K", at + 1, kept))
                children.append((REROLE + more, "R", at + 1, then))
        children.sort(reverse=True)  # the cheapest is on top of the stack
        stack += [(to, p, cost + c, audit + edit) for c, edit, to, p in children]
    return incumbent


@lru_cache(1 << 16)
def solved(letters: str, entry: int, goals: tuple[int, ...]) -> tuple[int, str] | None:
    return branch_and_bound(letters, entry, goals)


def joined(paths: dict[int, tuple[int, str]], step) -> dict[int, tuple[int, str]]:
    """The least (cost, audit) for each place after one more stretch; ``step(entry, exit)`` is the stretch's."""
    out: dict[int, tuple[int, str]] = {}
    for a, (cost, audit) in paths.items():
        for b in range(4):
            if (more := step(a, b)) is not None:
                path = cost + more[0], audit + more[1]
                if b not in out or path < out[b]:
                    out[b] = path
    return out


def paths_through(letters: str, entry: int) -> dict[int, tuple[int, str]]:
    """The least (cost, audit) from ``entry`` to each place, past all rows."""
    paths = {entry: (0, "")}
    for i in range(0, len(letters), STRETCH):
        part = letters[i:i + STRETCH]
        paths = joined(paths, lambda a, b: solved(part, a, (b,)))
    return paths


def repaired(letters: str) -> tuple[int, str]:
    """The least (cost, audit) of a whole conversation."""
    if len(letters) <= STRETCH:
        return solved(letters, START, DONE)
    paths = joined(paths_through(letters, START), lambda a, b: solved("", a, (b,)))
    return min(paths[p] for p in DONE if p in paths)


def illegal(initials: str) -> int:
    return sum(p not in ("su", "ua", "au") for p in map("".join, zip(initials, initials[1:])))


def turns_after(rows: Iterator[tuple[str, str]], audit: str) -> Iterator[tuple[str, str]]:
    """(role, text) of the repaired conversation: ``rows`` edited as the audit says."""
    names, place, at = {"u": "user", "a": "assistant"}, START, 0

    def inserted() -> Iterator[tuple[str, str]]:
        nonlocal place, at
        while audit[at:at + 1] == "I":
            role, place = NEXT[place]
            at += 1
            yield names[role], ""

    for role, text in rows:
        yield from inserted()
        edit, at = audit[at], at + 1
        if edit == "K":
            place = AFTER[role[:1]][place]
            yield role, text
        elif edit == "R":
            new, place = NEXT[place]
            yield names[new], text
    yield from inserted()


# ---------------------------------------------------------------- tables

def damaged(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies): rows as the crc32 of ``conv_id:turn`` damages them (nulls: one space)."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20
    plain = rows.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), kind.alias("kind")).filter(F.col("kind") != 0)
    return plain.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
                        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
                        F.when(F.col("kind") == 3, 2).otherwise(1).cast("long").alias("copies"))


def faults(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies, kind, key): distinct rows, how often each occurs, and the first one's fault
    (blank, duplicate, truncated or none; further copies of a row that isn't blank are duplicates)."""
    own = ["conv_id", "turn", "role", "text"]
    place = F.struct(F.col("turn").isNotNull().alias("told"), F.col("turn").alias("turn"))
    key = lambda: F.struct(F.xxhash64(F.to_json(F.struct("conv_id", "turn")), "role", "text").alias("x"),
                           F.xxhash64("text", F.lit(1), "role", F.to_json(F.struct("turn", "conv_id"))).alias("y"))
    each = written(rows.groupBy(*own).agg(F.sum("copies").alias("copies")).withColumn("key", key()), "rows")
    first = (each.groupBy("conv_id", "role", "text").agg(F.min(place).alias("first"))
             .select("conv_id", F.col("first.turn").alias("turn"), "role", "text").select(key().alias("key")).withColumn("new", F.lit(True)))
    end = F.rtrim(F.col("text"), F.lit(BLANKS))
    kind = (F.when(end == "", "blank").when(F.col("new").isNull(), "duplicate")
            .when(~F.substring(end, -1, 1).isin(".", "!", "?"), "truncated").otherwise("none"))
    return each.join(first, "key", "left").select(*own, "copies", kind.alias("kind"))


def pieces(rows: DataFrame, conv_type: str) -> DataFrame:
    """(conv_id, piece, whole, ends, cost, audit, table, illegal): each conversation's letters in order, searched.

    A conversation inside one task is done here (``whole``); pieces of others carry the least (cost, audit) from every
    place to every place."""
    step = "array<struct<entry:int,exit:int,cost:long,audit:string>>"
    kind = pa.list_(pa.struct([("entry", pa.int32()), ("exit", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
    schema = f"conv_id {conv_type}, piece long, whole boolean, ends string, cost long, audit string, table {step}, illegal long"

    def letters(own) -> Iterator[str]:
        """Up to ``PIECE`` letters at a time."""
        held = ""
        for _, role, kind_, copies in own:
            head = role[:1] if role[:1] in ("s", "u", "a") else "x"
            must = "1234"["suax".index(head)]
            held += must if kind_ in ("blank", "duplicate") else head.upper() if kind_ == "truncated" else head
            copies -= 1
            while copies or len(held) >= PIECE:
                more = min(copies, PIECE - min(len(held), PIECE))
                held += must * more
                copies -= more
                if len(held) >= PIECE:
                    yield held[:PIECE]
                    held = held[PIECE:]
        if held:
            yield held

    def rows_of(batches) -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(c.to_pylist() for c in batch.columns))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = itertools.count(TaskContext.get().partitionId() << 40)

        def made() -> Iterator[tuple]:
            """(conversation, letters, first of the task's conversations, first piece of its conversation)"""
            for i, (conv, own) in enumerate(itertools.groupby(rows_of(batches), key=lambda r: r[0])):
                for j, part in enumerate(letters(own)):
                    yield conv, part, i == 0, j == 0

        def out() -> Iterator[tuple]:
            every = made()
            now = next(every, None)
            while now is not None:
                conv, part, first, begins = now
                now = next(every, None)
                whole = begins and not first and now is not None and now[3]  # neither before nor after this piece can there be more
                heads = "".join(map(initial, part))
                ends = heads[0] + heads[-1]
                if whole:
                    yield conv, next(number), True, ends, *repaired(part), None, illegal(heads)
                else:
                    steps = [{"entry": a, "exit": b, "cost": c, "audit": s} for a in range(4) for b, (c, s) in paths_through(part, a).items()]
                    yield conv, next(number), False, ends, None, None, steps, illegal(heads)

        rows = out()
        types = [None, pa.int64(), pa.bool_(), pa.string(), pa.int64(), pa.string(), kind, pa.int64()]
        names = ["conv_id", "piece", "whole", "ends", "cost", "audit", "table", "illegal"]
        while some := list(itertools.islice(rows, 500)):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*some), types)], names=names)

    dealt = (rows.repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, 64))  # in the order of the sort; no whole text is sampled
             .sortWithinPartitions("conv_id", "turn", "role", "text"))
    return dealt.select("conv_id", "role", "kind", "copies").mapInArrow(run, schema)


def put_together(parts: DataFrame, conv_type: str) -> DataFrame:
    """(conv_id, cost, audit, illegal) of every conversation from its pieces in order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for i in range(0, b.num_rows, 16) for r in zip(*(c.to_pylist() for c in b.slice(i, 16).columns)))

        def out() -> Iterator[tuple]:
            for conv, own in itertools.groupby(rows, key=lambda r: r[0]):
                paths, wrong, last = {START: (0, "")}, 0, ""
                for _, _, ends, steps, bad in own:
                    known = {(s["entry"], s["exit"]): (s["cost"], s["audit"]) for s in steps}
                    paths = joined(paths, lambda a, b: known.get((a, b)))
                    wrong += bad + (illegal(last + ends[0]) if last else 0)
                    last = ends[1]
                paths = joined(paths, lambda a, b: solved("", a, (b,)))
                yield conv, *min(paths[p] for p in DONE if p in paths), wrong

        made = out()
        while some := list(itertools.islice(made, 500)):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*some), [None, pa.int64(), pa.string(), pa.int64()])],
                                             names=["conv_id", "cost", "audit", "illegal"])

    long = parts.filter(~F.col("whole")).select("conv_id", "piece", "ends", "table", "illegal").repartition("conv_id").sortWithinPartitions("conv_id", "piece")
    return (parts.filter("whole").select("conv_id", "cost", "audit", "illegal")
            .unionByName(long.mapInArrow(run, f"conv_id {conv_type}, cost long, audit string, illegal long")))


def digests(rows: DataFrame, found: DataFrame, conv_type: str) -> DataFrame:
    """(conv_id, cost, audit, illegal, repaired_sha256): the rows of each conversation stream past its audit."""
    none = lambda t: F.lit(None).cast(t)
    told = found.select("conv_id", F.lit(0).alias("late"), none("long").alias("turn"), none("string").alias("role"), none("string").alias("text"),
                        F.col("cost").alias("copies"), "audit", "illegal")
    both = told.unionByName(rows.select("conv_id", F.lit(1).alias("late"), F.col("turn").cast("long").alias("turn"), "role", "text", "copies",
                                        none("string").alias("audit"), none("long").alias("illegal")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for i in range(0, b.num_rows, 1000) for r in zip(*(c.to_pylist() for c in b.slice(i, 1000).columns)))

        def out() -> Iterator[tuple]:
            for conv, own in itertools.groupby(rows, key=lambda r: r[0]):
                _, _, _, _, cost, audit, wrong = next(own)
                digest, first = hashlib.sha256(), True
                every = ((role, text) for _, _, role, text, copies, _, _ in own for _ in range(copies))
                for role, text in turns_after(every, audit):
                    digest.update(f"{role}:{text}".encode() if first else f"\n{role}:{text}".encode())
                    first = False
                yield conv, cost, audit, wrong, digest.hexdigest()

        made = out()
        while some := list(itertools.islice(made, 1000)):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*some), [None, pa.int64(), pa.string(), pa.int64(), pa.string()])],
                                             names=["conv_id", "cost", "audit", "illegal", "repaired_sha256"])

    ordered = both.repartition("conv_id").sortWithinPartitions("conv_id", "late", "turn", "role", "text")
    return (ordered.select("conv_id", "late", "role", "text", "copies", "audit", "illegal")
            .mapInArrow(run, f"conv_id {conv_type}, cost long, audit string, illegal long, repaired_sha256 string"))


def repair(rows: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row for each conversation of ``conversations`` (conv_id): its faults in ``rows`` (conv_id, turn, role, text,
    copies), the cheapest edits and the hash of the repaired text.  One without rows has zeros and an empty audit."""
    conv_type = rows.schema["conv_id"].dataType.simpleString()
    each = written(faults(rows), "faults")
    one = F.col("kind")
    more = F.when(one == "blank", 0).otherwise(F.col("copies") - 1)
    total = lambda c: F.sum(c).cast("long")
    counts = each.groupBy("conv_id").agg(
        total(F.when(one == "blank", F.col("copies")).otherwise(0)).alias("blank"),
        total(F.when(one == "duplicate", F.col("copies")).otherwise(more)).alias("duplicate"),
        total((one == "truncated").cast("int")).alias("truncated"))
    turns = each.filter(F.col("turn").isNotNull()).select("conv_id", "turn").distinct().groupBy("conv_id").agg(
        (F.max("turn") - F.min("turn") + 1 - F.count("turn")).cast("long").alias("gaps"))
    found = written(put_together(written(pieces(each, conv_type), "pieces"), conv_type), "edits")
    out = conversations.select("conv_id").distinct()
    for part in (turns, counts, digests(each, found, conv_type)):
        part = part.withColumnRenamed("conv_id", "_conv")
        out = out.join(part, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").drop("_conv")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return out.select("conv_id", *[zero(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
                      F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))


def op13_repair(spark, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return repair(damaged(rows), rows)


def _sql() -> str:
    """The edits by dynamic programming: the least (cost, audit) at each place, as strings that sort alike."""
    crc = ("xor(list_reduce([4294967295] || list_transform(string_split({0}, ''), lambda x: CAST(ord(x) AS BIGINT)), "
           "lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, (x & 1) * 3988292384))), 4294967295) % 20")
    add = lambda x, cost, edit: f"(lpad(CAST(CAST({x}[1:8] AS INTEGER) + {cost} AS VARCHAR), 8, '0') || {x}[9:] || '{edit}')"
    # after insertions in front of a row, or behind the last
    opened = (f"least(p2, {add('p0', 5, 'I')}, {add('p1', 5, 'I')}, {add('p3', 5, 'I')}) AS q2, "
              f"least(p3, {add('p2', 5, 'I')}, {add('p0', 10, 'II')}, {add('p1', 10, 'II')}) AS q3, p0 AS q0, p1 AS q1")
    stay = "CASE WHEN truncated THEN 5 ELSE 0 END"
    moved = []
    for place, (role, before) in enumerate([("", ()), ("s", (0,)), ("u", (0, 1, 3)), ("a", (2,))]):
        ways = [add(f"q{place}", 2, "D")]
        ways += [f"CASE WHEN NOT gone AND initial = '{role}' THEN {add(f'q{b}', stay, 'K')} END" for b in before]
        ways += [f"CASE WHEN NOT gone THEN {add(f'q{b}', f'1 + {stay}', 'R')} END" for b in before if place >= 2]
        moved.append(f"least({', '.join(ways)}) AS p{place}")
    return rf"""
WITH RECURSIVE o AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
       coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
k AS (SELECT *, {crc.format('key')} AS kind FROM o),
g AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
             unnest(generate_series(1, CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy FROM k WHERE kind <> 0),
i AS (SELECT *, row_number() OVER () AS own FROM g),
r AS (SELECT conv_id, turn, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, own) AS n,
             row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, own) > 1 AS again,
             rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS e FROM i),
f AS MATERIALIZED (SELECT conv_id, turn, role, text, n, left(role, 1) AS initial, e = '' AS blank, e <> '' AND again AS duplicate, e = '' OR again AS gone,
             e <> '' AND NOT again AND right(e, 1) NOT IN ('.', '!', '?') AS truncated,
             lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY n) || left(role, 1) AS pair FROM r),
c AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate,
             count(*) FILTER (truncated) AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY conv_id),
s AS (SELECT conv_id, CAST(0 AS BIGINT) AS n, '00000000' AS p0, '00900000' AS p1, '00900000' AS p2, '00900000' AS p3 FROM c
      UNION ALL SELECT conv_id, n, {', '.join(moved)} FROM (
        SELECT s.conv_id, f.n, f.initial, f.gone, f.truncated, {opened} FROM s JOIN f ON f.conv_id IS NOT DISTINCT FROM s.conv_id AND f.n = s.n + 1)),
b AS (SELECT conv_id, least(q0, q3) AS best FROM (SELECT s.conv_id, {opened} FROM s JOIN c ON c.conv_id IS NOT DISTINCT FROM s.conv_id AND c.n = s.n)),
z AS (SELECT conv_id, CAST(best[1:8] AS BIGINT) AS cost, best[9:] AS audit FROM b),
l AS (SELECT conv_id, audit, i, audit[i] AS edit, len(replace(replace(audit[1:i], 'I', ''), ' ', '')) AS n
      FROM (SELECT conv_id, audit, unnest(generate_series(1, len(audit))) AS i FROM z)),
t AS (SELECT l.conv_id, l.i, l.edit, f.role, f.text, count(*) OVER (PARTITION BY l.conv_id ORDER BY l.i) AS turn_number,
             first_value(CASE WHEN l.edit = 'K' AND f.initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY l.conv_id ORDER BY l.i) AS system
      FROM l LEFT JOIN f ON f.conv_id IS NOT DISTINCT FROM l.conv_id AND f.n = l.n AND l.edit <> 'I' WHERE l.edit <> 'D'),
h AS (SELECT conv_id, sha256(string_agg(CASE WHEN edit = 'K' THEN role WHEN (turn_number - system) % 2 = 1 THEN 'user' ELSE 'assistant' END
             || ':' || CASE WHEN edit = 'I' THEN '' ELSE text END, chr(10) ORDER BY i)) AS repaired FROM t GROUP BY conv_id)
SELECT d.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, coalesce(repaired, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) d LEFT JOIN c ON c.conv_id IS NOT DISTINCT FROM d.conv_id
LEFT JOIN z ON z.conv_id IS NOT DISTINCT FROM d.conv_id LEFT JOIN h ON h.conv_id IS NOT DISTINCT FROM d.conv_id
"""


SQL = _sql()
