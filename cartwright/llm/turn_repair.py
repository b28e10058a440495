"""Conversation repair: the cheapest edits that give an alternating conversation.

Turns are aligned to the strings of the grammar ``(s?(ua)+)?`` (s system, u user,
a assistant). Keeping a turn costs 0, giving it another role (u or a) 2, deleting it 3,
inserting an empty turn (u or a) 2; a truncated turn that stays costs 1 more, blank and
repeated turns must be deleted.

*Alignment* (:func:`align`). The grammar has one string of each feasible length. Those
of even length are suffixes of one another, and an odd one is ``s`` before one of them,
so a single Wagner-Fischer table, filled from the ends, serves all lengths: its cell
(turn i, r targets left) is the cost of aligning the turns from i on with the last r
targets. Ukkonen's band: forced edits alone cost ``base``, and every target more or less
than the turns left that may stay adds 2, so with a greedy repair as incumbent only
cells with ``|r - left| <= (incumbent - base) / 2`` can lie on a cheapest path. The
cheapest lengths are traced back side by side, always by the least edit letter that one
of them can take, which gives the least audit among all cheapest.
Every ``sqrt(n)``-th row of the table is kept, the rows between are filled again.

*On Spark.* A first pass moves a digest and a few flags a turn, sorted by conversation
and turn, and emits a row per conversation; a second moves the texts, each conversation's
audit ahead of them, and reads them in order. A task holds a code byte and a digest for
each turn of one conversation, and never its texts.

Defined cases: null conv_ids are one conversation; a null role or text is one space; turns
sort by number, nulls first, then by a digest of role and text; a conversation without
turns has no edits; an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

DELETE, INSERT, RELABEL, TRUNCATED = 3, 2, 2, 1
ROLES = ("user", "assistant")
LEGAL = {"su", "ua", "au"}
_FAR = 1 << 40
_KNOWN = 50_000
_EMIT = 1000
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


# --- alignment -----------------------------------------------------------------------

def _greedy(initials: str, must: np.ndarray) -> int:
    """Cost of one repair beyond the forced edits, turn by turn without looking ahead."""
    cost, placed, system = 0, 0, False
    for c, gone in zip(initials, must):
        if gone:
            continue
        if c == "s" and not placed and not system:
            system = True
        elif c == "ua"[placed % 2]:
            placed += 1
        elif c in "ua":
            cost += INSERT
            placed += 2
        else:
            cost += RELABEL
            placed += 1
    if system and not placed:
        return cost + min(2 * INSERT, DELETE)
    return cost + INSERT * (placed % 2)


class _Table:
    """The banded cost table; ``row(i)`` gives (least r, costs) of a turn."""

    def __init__(self, initials: str, cut: np.ndarray, must: np.ndarray) -> None:
        self.initials, self.cut, self.must, self.n = initials, cut, must, len(initials)
        may = (~must).astype(np.int64)
        self.left = np.append(np.cumsum(may[::-1])[::-1], 0)  # turns from i on that may stay
        self.band = _greedy(initials, must) // 2 + 1
        self.step = max(1, math.isqrt(self.n))
        self.kept = {}
        row = None
        for i in range(self.n, -1, -1):
            row = self._fill(i, row)
            if i % self.step == 0 or i == self.n:
                self.kept[i] = row
        self.block: dict[int, tuple[int, np.ndarray]] = {}

    def _fill(self, i: int, below) -> tuple[int, np.ndarray]:
        low, high = max(0, int(self.left[i]) - self.band), int(self.left[i]) + self.band
        r = np.arange(low, high + 1)
        if i == self.n:
            return low, (INSERT * r).astype(np.int64)
        cost = DELETE + _cells(below, low, high)
        if not self.must[i]:
            on = _cells(below, low - 1, high - 1) + int(self.cut[i]) * TRUNCATED
            needed = 0 if self.initials[i] == "u" else 1 if self.initials[i] == "a" else 2
            cost = np.minimum(cost, on + np.where((r % 2 == needed) & (r > 0), 0, RELABEL))
        return low, np.minimum.accumulate(cost - INSERT * r) + INSERT * r

    def row(self, i: int) -> tuple[int, np.ndarray]:
        if i not in self.block:
            top = min(self.n, (i // self.step + 1) * self.step)
            self.block = {top: self.kept[top]}
            for k in range(top - 1, (i // self.step) * self.step - 1, -1):
                self.block[k] = self._fill(k, self.block[k + 1])
        return self.block[i]

    def at(self, i: int, r: int) -> int:
        low, cost = self.row(i)
        return int(cost[r - low]) if 0 <= r - low < len(cost) else _FAR


def _cells(row: tuple[int, np.ndarray], low: int, high: int) -> np.ndarray:
    """Costs of r = low .. high, far outside the row's band."""
    start, cost = row
    out = np.full(high - low + 1, _FAR, np.int64)
    a, b = max(low, start), min(high, start + len(cost) - 1)
    if a <= b:
        out[a - low:b - low + 1] = cost[a - start:b - start + 1]
    return out


def align(initials: str, cut: np.ndarray, must: np.ndarray) -> tuple[int, str]:
    """Least cost, and the least audit (letters D, I, K, R) among the cheapest."""
    n = len(initials)
    table = _Table(initials, cut, must)
    # where a conversation may begin: r targets left, or s and then r
    low, first = table.row(0)
    best, plain, system = _FAR, set(), set()
    for r, c in enumerate(first.tolist(), low):
        if r % 2 == 0:
            best, plain = (c, {r}) if c < best else (best, plain | {r} if c == best else plain)
    deleted = 0
    for i in range(n):  # turns before an s that stays are deleted
        if initials[i] == "s" and not must[i]:
            start, cost = table.row(i + 1)
            for r, c in enumerate(cost.tolist(), start):
                c += deleted + int(cut[i]) * TRUNCATED
                if r % 2 == 0 and r >= 2 and c <= best:
                    if c < best:
                        best, plain, system = c, set(), set()
                    system.add((i, r))
        deleted += DELETE
        if deleted > best:
            break
    audit, i = [], 0
    while not (i == n and 0 in plain):
        ways: dict[str, set] = {}
        ahead: dict[str, set] = {}
        for r in plain:
            here = table.at(i, r)
            if r and here == INSERT + table.at(i, r - 1):
                ways.setdefault("I", set()).add(r - 1)
            if i == n:
                continue
            if here == DELETE + table.at(i + 1, r):
                ways.setdefault("D", set()).add(r)
            if r and not must[i]:
                on = table.at(i + 1, r - 1) + int(cut[i]) * TRUNCATED
                if here == on and initials[i] == "ua"[r % 2]:
                    ways.setdefault("K", set()).add(r - 1)
                if here == on + RELABEL:
                    ways.setdefault("R", set()).add(r - 1)
        for at, r in system:
            if at == i:
                ways.setdefault("K", set()).add(r)
            else:
                ahead.setdefault("D", set()).add((at, r))
        edit = min(ways.keys() | ahead.keys())
        plain, system = ways.get(edit, set()), ahead.get(edit, set())
        audit.append(edit)
        i += edit != "I"
    return best, "".join(audit)


# --- turns ------------------------------------------------------------------------------

def damage(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """Faults by a hash of conversation and turn; dropped turns stay as ``gone``, so that
    every conversation is still known."""
    conv, turn = F.col(f"`{conv_col}`"), F.col(f"`{turn_col}`")
    role, text = (F.coalesce(F.col(f"`{c}`"), F.lit(" ")) for c in (role_col, text_col))
    space = F.lit(" ")
    fault = F.crc32(F.concat(F.coalesce(conv.cast("string"), space), F.lit(":"), F.coalesce(turn.cast("string"), space))) % 20
    rows = conversations.select(
        conv.alias("conv_id"), turn.alias("turn"),
        F.when(fault == 4, "user").otherwise(role).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        (fault == 0).alias("gone"), F.when(fault == 3, 2).otherwise(1).alias("times"))
    return rows.select("conv_id", "turn", "role", "text", "gone",
                       F.explode(F.array_repeat(F.lit(0), F.col("times")))).drop("col")


def _mark(role: Column, text: Column) -> Column:
    return F.unhex(F.md5(F.concat_ws(":", F.length(role).cast("string"), role, text)))


def _ends(text: Column) -> Column:
    """The last character that is not white space; empty for a blank text."""
    return F.right(F.rtrim(text, F.lit(" \t\n\x0b\x0c\r")), F.lit(1))


def _batch(rows: list[tuple], names: tuple[str, ...], conv_type: pa.DataType) -> pa.RecordBatch:
    kinds = {"conv_id": conv_type, "audit": pa.string(), "edit": pa.string(), "role": pa.string(), "text": pa.string(),
             "repaired_sha256": pa.string()}
    cols = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds.get(n, pa.int64())) for n, c in zip(names, cols)], list(names))


def _audited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (conv_id, turn, initial, last, mark, gone) -> a row per conversation."""
    known: dict[tuple[str, bytes], tuple[int, str]] = {}
    out: list[tuple] = []
    current: tuple = ()
    initials: list[str] = []
    flags = bytearray()  # 1 truncated, 2 blank, 3 duplicate
    seen: set[bytes] = set()
    low = high = None
    turns = 0

    def close() -> None:
        kinds, marks = "".join(c if c in ("s", "u", "a") else "?" for c in initials), bytes(flags)
        if (kinds, marks) not in known:
            if len(known) >= _KNOWN:
                known.clear()
            f = np.frombuffer(marks, np.uint8)
            known[kinds, marks] = align(kinds, f == 1, f >= 2)
        cost, audit = known[kinds, marks]
        illegal = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))
        gaps = 0 if low is None else high - low + 1 - turns
        out.append((*current, gaps, marks.count(2), marks.count(3), marks.count(1), illegal, cost, audit))

    names = ("conv_id", *COUNTS, "audit")
    conv_type = None
    for b in batches:
        conv_type = b.schema.field("conv_id").type
        for conv, turn, initial, last, mark, gone in zip(*(c.to_pylist() for c in b.columns)):
            if current != (conv,):
                if current:
                    close()
                current, low, high, turns = (conv,), None, None, 0
                initials.clear()
                flags.clear()
                seen.clear()
            if gone:
                continue
            if turn is not None:
                if low is None:
                    low = turn
                turns += turn != high
                high = turn
            initials.append(initial)
            flags.append(2 if not last else 3 if mark in seen else 1 if last not in ".!?" else 0)
            seen.add(mark)
        if out:
            yield _batch(out, names, conv_type)
            out.clear()
    if current:
        close()
        yield _batch(out, names, conv_type)


def audits(turns: DataFrame) -> DataFrame:
    """Per conversation: conv_id, gaps, counts of faults, cost, audit. ``turns`` as
    :func:`damage` gives them (``gone`` turns count for nothing)."""
    kind = turns.schema["conv_id"].dataType.simpleString()
    small = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), F.substring("role", 1, 1).alias("initial"),
                         _ends(F.col("text")).alias("last"), _mark(F.col("role"), F.col("text")).alias("mark"), "gone")
    dealt = small.repartition("conv_id").sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "mark")
    return dealt.mapInArrow(_audited, f"conv_id {kind}, {', '.join(f'{c} long' for c in COUNTS)}, audit string")


def _applied(rows: Iterator[tuple]) -> Iterator[tuple]:
    """(conv_id, audit, role, text, counts...), a conversation's audit first, its turns
    (without audit) behind -> (conv_id, edit, role, text) for every turn of the repaired
    conversation, and (conv_id, None, audit, counts) at its end."""
    lead: tuple = ()
    audit, at, placed = "", 0, 0

    def inserts() -> Iterator[tuple]:
        nonlocal at, placed
        while audit[at:at + 1] == "I":
            yield lead[0], "I", ROLES[placed % 2], ""
            at, placed = at + 1, placed + 1

    for row in rows:
        if row[1] is not None:
            if lead:
                yield from inserts()
                yield lead[0], None, audit, lead[4:]
            lead, audit, at, placed = row, row[1], 0, 0
            continue
        yield from inserts()
        edit, role = audit[at], row[2]
        at += 1
        if edit != "D":
            if edit == "R":
                role = ROLES[placed % 2]
            # a system turn only ever comes first, and does not count for the alternation
            placed += edit == "R" or role[:1] != "s"
            yield lead[0], edit, role, row[3]
    if lead:
        yield from inserts()
        yield lead[0], None, audit, lead[4:]


def _in_order(turns: DataFrame, audited: DataFrame) -> DataFrame:
    """Texts behind their conversation's audit, conversations whole within a partition."""
    none = F.lit(None)
    lead = audited.select("conv_id", none.cast("long").alias("turn"), none.cast("binary").alias("mark"), "audit",
                          none.cast("string").alias("role"), none.cast("string").alias("text"), *COUNTS)
    body = turns.filter(~F.col("gone")).select(
        "conv_id", F.col("turn").cast("long").alias("turn"), _mark(F.col("role"), F.col("text")).alias("mark"),
        none.cast("string").alias("audit"), "role", "text", *[none.cast("long").alias(c) for c in COUNTS])
    both = lead.unionByName(body).repartition("conv_id")
    return both.sortWithinPartitions("conv_id", F.asc_nulls_last("audit"), F.asc_nulls_first("turn"), "mark").select(
        "conv_id", "audit", "role", "text", *COUNTS)


def _rows(batches: Iterator[pa.RecordBatch], seen: list) -> Iterator[tuple]:
    for b in batches:
        seen[:] = [b.schema.field("conv_id").type]
        yield from zip(*(c.to_pylist() for c in b.columns))


def repaired_turns(turns: DataFrame, audited: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, position (from 0), edit, role, text."""
    kind = turns.schema["conv_id"].dataType.simpleString()
    names = ("conv_id", "position", "edit", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv_type: list = []
        position, out = 0, []
        for conv, edit, role, text in _applied(_rows(batches, conv_type)):
            if edit is None:
                position = 0
                continue
            out.append((conv, position, edit, role, text))
            position += 1
            if len(out) == _EMIT:
                yield _batch(out, names, conv_type[0])
                out = []
        if out:
            yield _batch(out, names, conv_type[0])

    return _in_order(turns, audited).mapInArrow(run, f"conv_id {kind}, position long, edit string, role string, text string")


def digests(turns: DataFrame, audited: DataFrame) -> DataFrame:
    """``audited`` with repaired_sha256: of the repaired ``role:text``, joined by newlines."""
    kind = turns.schema["conv_id"].dataType.simpleString()
    names = ("conv_id", *COUNTS, "audit", "repaired_sha256")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv_type: list = []
        digest, lines, out = hashlib.sha256(), 0, []
        for conv, edit, role, text in _applied(_rows(batches, conv_type)):
            if edit is not None:
                digest.update(f"\n{role}:{text}".encode() if lines else f"{role}:{text}".encode())
                lines += 1
                continue
            out.append((conv, *text, role, digest.hexdigest()))  # at the end: counts and audit
            digest, lines = hashlib.sha256(), 0
            if len(out) == _EMIT:
                yield _batch(out, names, conv_type[0])
                out = []
        if out:
            yield _batch(out, names, conv_type[0])

    fields = [f"conv_id {kind}", *[f"{c} long" for c in COUNTS], "audit string", "repaired_sha256 string"]
    return _in_order(turns, audited).mapInArrow(run, ", ".join(fields))


def repair(turns: DataFrame) -> DataFrame:
    """Per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256."""
    return digests(turns, materialize(audits(turns), "audits"))
