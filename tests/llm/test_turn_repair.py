import hashlib
import random
from zlib import crc32

import numpy as np
import pytest

from cartwright.llm.turn_repair import align, audits, damage, repair, repaired_turns

from .helpers import frame

SCHEMA = "conv_id long, turn long, role string, text string"
SPACE = " \t\n\x0b\x0c\r"


def brute_align(initials, cut, must):
    """Least (cost, audit), turn by turn over what the repaired turns end in so far."""
    follow = {"": "u", "s": "u", "a": "u", "u": "a"}

    def with_inserts(best):
        for _ in range(3):
            for end, (c, audit) in list(best.items()):
                new = (c + 2, audit + "I")
                best[follow[end]] = min(best.get(follow[end], new), new)
        return best

    best = with_inserts({"": (0, "")})
    for c, k, gone in zip(initials, cut, must):
        new = {}
        for end, (cost, audit) in best.items():
            ways = [(end, cost + 3, "D")]
            if not gone:
                if c == "s" and end == "":
                    ways.append(("s", cost + k, "K"))
                if c == follow[end]:
                    ways.append((c, cost + k, "K"))
                ways.append((follow[end], cost + 2 + k, "R"))
            for to, price, edit in ways:
                new[to] = min(new.get(to, (price, audit + edit)), (price, audit + edit))
        best = with_inserts(new)
    return min(best[e] for e in ("", "a") if e in best)


@pytest.mark.parametrize("length, rounds", [(9, 3000), (60, 60), (300, 3)])
def test_alignment_matches_brute_force(length, rounds):
    r = random.Random(length)
    for _ in range(rounds):
        n = r.randint(0, length)
        initials = "".join(r.choice("suuuaaa?") for _ in range(n))
        flags = np.array([r.choice([0, 0, 0, 1, 2]) for _ in range(n)], np.uint8)
        want = brute_align(initials, (flags == 1).astype(int).tolist(), flags == 2)
        assert align(initials, flags == 1, flags == 2) == want


def brute_repair(rows):
    convs = {}
    for conv, turn, role, text in rows:
        found = convs.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault = crc32(key.encode()) % 20
        if fault == 0:
            continue
        text = "" if fault == 1 else text.translate({ord(c): None for c in ".!?"}) if fault == 2 else text
        role = "user" if fault == 4 else role
        mark = hashlib.md5(f"{len(role)}:{role}:{text}".encode()).digest()
        found += [(turn is not None, turn or 0, mark, role, text)] * (2 if fault == 3 else 1)
    out = {}
    for conv, found in convs.items():
        found.sort(key=lambda t: t[:3])
        turns = [t for known, t, *_ in found if known]
        seen, flags = set(), []
        for *_, role, text in found:
            body = text.rstrip(SPACE)
            flags.append(2 if not body else 3 if (role, text) in seen else 1 if body[-1] not in ".!?" else 0)
            seen.add((role, text))
        firsts = [t[3][:1] for t in found]
        cost, audit = brute_align(firsts, [int(f == 1) for f in flags], [f >= 2 for f in flags])
        lines, i, placed = [], 0, 0
        for e in audit:
            if e == "I":
                lines.append(f"{('user', 'assistant')[placed % 2]}:")
                placed += 1
                continue
            role, text = found[i][3:]
            i += 1
            if e == "R":
                role = ("user", "assistant")[placed % 2]
            if e != "D":
                placed += e == "R" or role[:1] != "s"
                lines.append(f"{role}:{text}")
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(firsts, firsts[1:]))
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, flags.count(2), flags.count(3),
                     flags.count(1), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def conversations():
    r = random.Random(5)
    rows = []
    for conv in range(60):
        for turn in range(r.randint(1, 9)):
            role = r.choice(["user", "assistant"]) if r.random() < 0.2 else ("user", "assistant")[turn % 2]
            rows.append((conv, turn * r.choice([1, 1, 1, 2]), "system" if turn == 0 and conv % 4 == 0 else role,
                         r.choice(["Yes.", "No!", "Maybe", "Ünd so?  ", " \n", "a" * 50 + "."]) + (str(turn) + "." if conv % 3 else "")))
    rows += [(100, t, ("user", "assistant")[t % 2], f"Turn {t}.") for t in range(400)]  # a long one
    rows += [(None, None, None, None), (None, 3, "user", "Who?"), (101, None, "user", "First."), (101, 0, "assistant", None),
             (101, 1, None, "No role."), (102, 0, "", "Empty role."), (103, 0, "tool", "x" * 100_000), (104, 1, "user", "")]
    rows += [(105, 0, "user", "Same.")] * 3 + [(106, t, "user", "") for t in range(5)]
    return rows


def test_query_matches_brute_force(spark):
    rows = conversations()
    want = brute_repair(rows)
    got = repair(damage(frame(spark, rows, SCHEMA).withColumnRenamed("text", "text"))).collect()
    assert {r["conv_id"]: tuple(r)[1:] for r in got} == want
    assert len(got) == len(want)


def test_repaired_turns_alternate(spark):
    turns = damage(frame(spark, conversations(), SCHEMA))
    by_conv = {}
    for r in repaired_turns(turns, audits(turns)).collect():
        by_conv.setdefault(r["conv_id"], []).append((r["position"], r["edit"], r["role"], r["text"]))
    assert by_conv
    for found in by_conv.values():
        found.sort()
        assert [p for p, *_ in found] == list(range(len(found)))
        firsts = "".join(role[:1] for _, _, role, _ in found)
        body = firsts[1:] if firsts[:1] == "s" else firsts
        assert body and body == "ua" * (len(body) // 2)
        assert all(text == "" for _, edit, _, text in found if edit == "I")


def test_conversation_without_turns_and_empty_table(spark):
    dropped = next(c for c in range(1000) if crc32(f"{c}:0".encode()) % 20 == 0)
    row = repair(damage(frame(spark, [(dropped, 0, "user", "Gone.")], SCHEMA))).collect()[0]
    assert tuple(row) == (dropped, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert repair(damage(frame(spark, [], SCHEMA))).count() == 0


def test_other_columns_and_names(spark):
    rows = [(1, 0, "user", "A."), (1, 1, "assistant", "B.")]
    df = frame(spark, rows, SCHEMA).selectExpr("conv_id", "turn", "role", "text", "1 AS audit", "2 AS gone", "3 AS col", "4 AS cost")
    assert [r["audit"] for r in repair(damage(df)).collect()] == [v[6] for v in brute_repair(rows).values()]
