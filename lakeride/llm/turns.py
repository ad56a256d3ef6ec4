"""Conversation structure repair by iterative-deepening A*.

A conversation's turns have faults (blank, repeated, truncated) and role
sequences that no chat template accepts. The cheapest edits - Delete, Insert,
Keep, Rerole - that make its role initials read ``(s?(ua)+)?`` are found by
depth-first search in ASCII order of the edits under increasing cost bounds.
What a failed state is known to cost at least is kept in a transposition
table, so a state is searched again only with a larger budget. The first
accepting path under the smallest bound is the answer: cheapest, and among
the cheapest the least in ASCII order.

Conversations longer than a block are searched block by block, from each
grammar state to each, and the blocks are chained by cost. A block's path ends
with the edit of its last row, so no path is the beginning of another one and
the least chain is made of least paths.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: rows searched at once
BLOCK = 32
#: costs of the edits; an undeleted truncated row costs TRUNCATED more
DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1
SPACES = " \t\n\v\f\r"
NONE, BLANK, DUPLICATE, CUT = range(4)
#: the grammar: 0 nothing yet, 1 after system, 2 after user, 3 after assistant; 0 and 3 accept
NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
EXPECTED = {0: "u", 1: "u", 2: "a", 3: "u"}
ROLE = {"u": "user", "a": "assistant"}
NEVER = 1 << 60


def faults_of(rows: list[tuple[str, str]]) -> list[int]:
    """The first fault of each (role, text): blank, seen earlier with the same role, not ending like a sentence."""
    seen: set[tuple[str, str]] = set()
    out = []
    for role, text in rows:
        end = text.rstrip(SPACES)
        out.append(BLANK if not end else DUPLICATE if (role, text) in seen else CUT if end[-1] not in ".!?" else NONE)
        seen.add((role, text))
    return out


def search(initials: list[str], faults: list[int], start: int = 0, goal: int | None = None) -> tuple[int, str] | None:
    """(cost, edits) of the cheapest path from a grammar state; ``goal``: the state right after the last row,
    else an accepting one, with turns inserted at the end if need be. None if there is no path."""
    n = len(initials)
    due = [0] * (n + 1)  # what the faults that are left cost at least
    for i in range(n - 1, -1, -1):
        due[i] = due[i + 1] + (DELETE if faults[i] in (BLANK, DUPLICATE) else TRUNCATED if faults[i] == CUT else 0)
    if goal is not None and goal != start:
        opens = any(r == "s" and f in (NONE, CUT) for r, f in zip(initials, faults, strict=True))
        if goal == 0 or (goal == 1 and not (start == 0 and opens)):
            return None
    table: dict[tuple[int, int], int] = {}  # least cost from a state that failed

    def least(i: int, state: int) -> int:
        return table.get((i, state), due[i])

    def moves(i: int, state: int) -> Iterator[tuple[str, int, int, int]]:
        if i < n:
            yield "D", DELETE, i + 1, state
        if i < n or goal is None:
            yield "I", INSERT, i, NEXT[state, EXPECTED[state]]
        if i < n and faults[i] in (NONE, CUT):
            more = TRUNCATED if faults[i] == CUT else 0
            if (state, initials[i]) in NEXT:
                yield "K", more, i + 1, NEXT[state, initials[i]]
            yield "R", REROLE + more, i + 1, NEXT[state, EXPECTED[state]]

    def walk(i: int, state: int, budget: int) -> tuple[int, str] | None:
        """The first accepting path in ASCII order within the budget."""
        if i == n and (state in (0, 3) if goal is None else state == goal):
            return 0, ""
        need = NEVER
        for edit, cost, j, to in moves(i, state):
            if cost + least(j, to) <= budget:
                found = walk(j, to, budget - cost)
                if found:
                    return found[0] + cost, edit + found[1]
            need = min(need, cost + least(j, to))
        table[i, state] = max(need, budget + 1)
        return None

    bound = due[0]
    while bound < NEVER:
        found = walk(0, start, bound)
        if found:
            return found
        bound = table[0, start]
    return None


def cheapest_edits(initials: list[str], faults: list[int], block: int = BLOCK) -> tuple[int, str]:
    """(cost, edits) for a whole conversation."""
    n = len(initials)
    if n <= block:
        return search(initials, faults)
    cuts = [(x, min(n, x + block)) for x in range(0, n, block)]
    paths, known = [], {}
    for x, y in cuts:
        last = y == n
        key = ("".join(r or "-" for r in initials[x:y]), tuple(faults[x:y]), last)
        if key not in known:
            known[key] = {(s, t): p for s in range(4) for t in ([None] if last else range(4))
                          if (p := search(initials[x:y], faults[x:y], s, t))}
        paths.append(known[key])
    after: dict = {None: 0}  # least cost of the blocks that follow, by the state they begin in
    ahead = [after]
    for found in reversed(paths):
        now: dict = {}
        for (s, t), (cost, _) in found.items():
            if t in after:
                now[s] = min(now.get(s, NEVER), cost + after[t])
        after = now
        ahead.append(after)
    state, total, out = 0, ahead[-1][0], []
    for found, after in zip(paths, ahead[-2::-1], strict=True):
        least = min(c + after[t] for (s, t), (c, _) in found.items() if s == state and t in after)
        path, state = min((p, t) for (s, t), (c, p) in found.items() if s == state and t in after and c + after[t] == least)
        out.append(path)
    return total, "".join(out)


def apply_edits(rows: list[tuple[str, str]], audit: str) -> list[tuple[str, str]]:
    """The repaired (role, text) rows."""
    out: list[tuple[str, str]] = []
    i = state = 0
    for edit in audit:
        if edit == "D":
            i += 1
            continue
        role = rows[i][0] if edit == "K" else ROLE[EXPECTED[state]]
        out.append((role, "" if edit == "I" else rows[i][1]))
        i += edit != "I"
        state = NEXT[state, role[:1]]
    return out


RESULT = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
          "repaired array<struct<role:string,text:string>>")


def _judge(turns: list[int | None], rows: list[tuple[str, str]]) -> tuple:
    numbers = [t for t in turns if t is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    faults = faults_of(rows)
    initials = [role[:1] for role, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
    cost, audit = cheapest_edits(initials, faults)
    return gaps, faults.count(BLANK), faults.count(DUPLICATE), faults.count(CUT), illegal, cost, audit, apply_edits(rows, audit)


def repair(turns: DataFrame, lost_col: str | None = None) -> DataFrame:
    """One row per conv_id of ``turns(conv_id, turn, role, text)``: counts of faults, cost, audit (the edits'
    initials in order) and the repaired turns.

    Rows are taken by turn (nulls first), then role and text. ``lost_col``
    names a boolean column of rows that are not there any more but whose
    conversation still gets its row. A null role or text is one space: such a
    text is blank, such a role fits no grammar, nor does an empty one. Rows without a conv_id are one
    conversation with a null id. Repeated rows are duplicates. An empty table
    gives no rows. Other columns are ignored, whatever their names. A task
    sorts its conversations and holds one at a time, which the digest of a
    whole repaired conversation needs anyway.
    """
    lost = F.coalesce(turns[lost_col].cast("boolean"), F.lit(False)) if lost_col else F.lit(False)
    rows = turns.select(turns["conv_id"].cast("long").alias("conv_id"), turns["turn"].cast("long").alias("turn"),
                        F.coalesce(turns["role"].cast("string"), F.lit(" ")).alias("role"),
                        F.coalesce(turns["text"].cast("string"), F.lit(" ")).alias("text"), lost.alias("lost"))
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []  # the current conversation
        done: list[tuple] = []
        now: list = []  # its id

        def close():
            done.append((now[0], *_judge([r[0] for r in held], [(r[1], r[2]) for r in held])))
            held.clear()

        def emit() -> pa.RecordBatch:
            names = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")
            types = (*[pa.int64()] * 7, pa.string())
            turn = pa.struct([("role", pa.string()), ("text", pa.string())])
            cols = [pa.array([d[i] for d in done], t) for i, t in enumerate(types)]
            cols.append(pa.array([[{"role": r, "text": t} for r, t in d[8]] for d in done], pa.list_(turn)))
            done.clear()
            return pa.RecordBatch.from_arrays(cols, [*names, "repaired"])

        for batch in batches:
            for conv, turn, role, text, gone in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now != [conv]:
                    if now:
                        close()
                        if len(done) >= 1000 or sum(len(t) for _, t in done[-1][8]) > 1 << 20:
                            yield emit()
                    now[:] = [conv]
                if not gone:
                    held.append((turn, role, text))
        if now:
            close()
        if done:
            yield emit()

    return ordered.mapInArrow(run, RESULT)


def damage(turns: DataFrame) -> DataFrame:
    """A reproducible damage of ``turns(conv_id, turn, role, text)`` by a checksum of conversation and turn:
    of twenty rows one is lost (marked so), one empty, one without sentence ends, one repeated, one given the role user.
    Nulls are one space."""
    blank = F.lit(" ")
    key = F.concat(F.coalesce(turns["conv_id"].cast("string"), blank), F.lit(":"), F.coalesce(turns["turn"].cast("string"), blank))
    role, text = (F.coalesce(turns[c].cast("string"), blank) for c in ("role", "text"))
    rows = turns.select(turns["conv_id"].alias("conv_id"), turns["turn"].alias("turn"), role.alias("role"), text.alias("text"),
                        (F.crc32(key) % 20).alias("fate"))
    fate = F.col("fate")
    return rows.select(
        "conv_id", "turn", F.when(fate == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(fate == 1, "").when(fate == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        (fate == 0).alias("lost"), F.explode(F.when(fate == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy")).drop("copy")



def digests(repaired: DataFrame) -> DataFrame:
    """``repaired`` with the sha256 of each repaired conversation, written as role:text lines, in place of its turns."""
    line = F.array_join(F.transform("repaired", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
    return repaired.withColumn("repaired_sha256", F.sha2(line, 256)).drop("repaired")
