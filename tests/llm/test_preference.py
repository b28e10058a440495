from cartwright.llm.preference import preference_examples, preference_segments, swapped_replies

TURNS = "pair_id long, side string, turn long, role string, text string"
CONV = "conv_id long, turn long, role string, text string"


def segments(spark, rows):
    got = preference_segments(spark.createDataFrame(rows, TURNS)).collect()
    return sorted((r.pair_id, r.part, r.turn, r.rendered, r.loss, r.body_start) for r in got)


def brute(rows):
    """Step by step along both conversations of each pair."""
    out = []
    for pair in sorted({r[0] for r in rows if r[0] is not None}):
        step = {s: {} for s in ("chosen", "rejected")}
        for p, side, turn, role, text in rows:
            if p == pair and side in step and turn is not None:
                step[side].setdefault(turn, set()).add((role or "", text or ""))
        turns = sorted(set(step["chosen"]) | set(step["rejected"]))
        n = 0
        while n < len(turns) and step["chosen"].get(turns[n]) == step["rejected"].get(turns[n]):
            n += 1
        for i, t in enumerate(turns):
            for part in ["prompt"] if i < n else ["chosen", "rejected"]:
                for role, text in step["chosen" if part == "prompt" else part].get(t, ()):
                    out.append((pair, part, t, f"<|{role}|>\n{text}\n<|end|>\n", int(part != "prompt" and role == "assistant"),
                                len(role) + 5))
    return sorted(out)


def both(pair, common, chosen, rejected):
    rows = []
    for side, rest in (("chosen", chosen), ("rejected", rejected)):
        rows += [(pair, side, t, role, text) for t, (role, text) in enumerate(common + rest)]
    return rows


def test_longest_common_prefix(spark):
    u, a = ("user", "hi"), ("assistant", "hello")
    rows = both(1, [u, a, ("user", "more")], [("assistant", "good")], [("assistant", "bad"), ("user", "why"), ("assistant", "x")])
    rows += both(2, [], [("user", "p"), ("assistant", "q")], [("user", "r"), ("assistant", "q")])  # later turns agree again
    rows += both(3, [u, a], [], [])
    rows += both(4, [u], [a], [])
    got = segments(spark, rows)
    assert got == brute(rows)
    assert [g[3] for g in got if g[0] == 1 and g[1] == "prompt"] == [
        "<|user|>\nhi\n<|end|>\n", "<|assistant|>\nhello\n<|end|>\n", "<|user|>\nmore\n<|end|>\n"]
    assert {g[1] for g in got if g[0] == 3} == {"prompt"}
    assert sum(g[4] for g in got if g[0] == 1) == 3


def test_awkward_rows(spark):
    rows = both(1, [("user", None), (None, "x")], [("assistant", "")], [("assistant", None)])
    rows += rows[:3] + [(1, "other", 9, "user", "z"), (None, "chosen", 0, "user", "z"), (1, "chosen", None, "user", "z"),
                        (1, None, 3, "user", "z")]
    rows += [(5, "chosen", 0, "user", "a"), (5, "chosen", 0, "assistant", "b"), (5, "rejected", 0, "user", "a")]
    rows += both(6, [("user", "long " * 50_000)], [("assistant", "y" * 100_000)], [("assistant", "z")])
    assert segments(spark, rows) == brute(rows)
    assert segments(spark, []) == []


def test_a_conversation_of_a_third_of_all_rows(spark):
    rows = both(1, [("user", f"t{i}") for i in range(700)], [("assistant", "a")], [("assistant", "b")])
    for p in range(2, 300):
        rows += both(p, [("user", "same first turn")], [("assistant", f"{p}")], [("assistant", "no")])
    assert segments(spark, rows) == brute(rows)


def test_examples_are_the_segments_in_order(spark):
    rows = both(1, [("user", "hi")], [("assistant", "good"), ("user", "ta"), ("assistant", "bye")], [("assistant", "bad")])
    rows += both(2, [("user", "x"), ("assistant", "y")], [], []) + both(3, [], [("user", "ä"), ("assistant", "ö")], [("user", "b")])
    got = {r.pair_id: r for r in preference_examples(preference_segments(spark.createDataFrame(rows, TURNS))).collect()}
    turn = lambda role, text: f"<|{role}|>\n{text}\n<|end|>\n"
    assert got[1].prompt == turn("user", "hi") and got[1].rejected == turn("assistant", "bad")
    assert got[1].chosen == turn("assistant", "good") + turn("user", "ta") + turn("assistant", "bye")
    for r in got.values():
        for text, spans in ((r.chosen, r.chosen_loss), (r.rejected, r.rejected_loss)):
            masked = [text[s.start:s.stop] for s in spans]
            assert masked == [t.split("\n", 1)[1] for t in text.split("<|") if t.startswith("assistant")
                              for t in [t + "<|end|>\n"]]
    assert (got[2].chosen, got[2].rejected, got[2].chosen_loss) == ("", "", [])
    assert got[3].prompt == "" and got[3].rejected_loss == []


def test_swapped_replies(spark):
    rows = [(0, 0, "user", "q0"), (0, 1, "assistant", "a0"), (1, 0, "user", "q1"), (1, 1, "assistant", "a1"),
            (1, 2, "user", "bye"), (2, 0, "user", "q2"), (3, 0, "assistant", "a3"), (None, 0, "user", "z"), (4, None, "user", "z"),
            (6, 0, "assistant", "a6")]
    got = swapped_replies(spark.createDataFrame(rows, CONV)).collect()
    assert sorted((r.pair_id, r.side, r.turn, r.text) for r in got) == sorted([
        (0, "chosen", 0, "q0"), (0, "rejected", 0, "q0"), (0, "chosen", 1, "a0"), (0, "rejected", 1, "a1"),
        (1, "chosen", 0, "q1"), (1, "rejected", 0, "q1"), (1, "chosen", 1, "a1"), (1, "rejected", 1, "a3"),
        (1, "chosen", 2, "bye"), (1, "rejected", 2, "bye"), (2, "chosen", 0, "q2"), (2, "rejected", 0, "q2"),
        (3, "chosen", 0, "a3"), (3, "rejected", 0, "a6"), (6, "chosen", 0, "a6"), (6, "rejected", 0, "a0")])


def test_sparse_ids_ties_and_a_single_reply(spark):
    rows = [(100 * i, t, ("user", "assistant")[t % 2], f"{i}.{t}") for i in range(50) for t in range(2 + i % 5)]
    got = {}
    for r in swapped_replies(spark.createDataFrame(rows, CONV).repartition(7)).collect():
        got.setdefault((r.pair_id, r.side), {})[r.turn] = r.text
    assert {c for c, _ in got} == {100 * i for i in range(50)}
    for i in range(50):
        chosen, rejected = got[100 * i, "chosen"], got[100 * i, "rejected"]
        at = max(t for t in chosen if t % 2)
        after = (i + 1) % 50
        assert {t for t in chosen if chosen[t] != rejected[t]} == {at}
        assert rejected[at] == f"{after}.{max(t for t in range(2 + after % 5) if t % 2)}"
    tie = [(1, 0, "assistant", "b"), (1, 0, "assistant", "c"), (2, 0, "assistant", None), (3, 0, "user", "u")]
    sides = sorted((r.pair_id, r.side, r.text) for r in swapped_replies(spark.createDataFrame(tie, CONV)).fillna("").collect())
    assert sides == [(1, "chosen", "b"), (1, "chosen", "c"), (1, "rejected", ""), (1, "rejected", ""), (2, "chosen", ""),
                     (2, "rejected", "c"), (3, "chosen", "u"), (3, "rejected", "u")]
    alone = segments_of_pairs(spark, [(7, 0, "user", "q"), (7, 1, "assistant", "a")])
    assert {r.part for r in alone} == {"prompt"} and len(alone) == 2


def segments_of_pairs(spark, rows):
    return preference_segments(swapped_replies(spark.createDataFrame(rows, CONV))).collect()


def test_plan_has_no_python(spark):
    df = preference_segments(swapped_replies(spark.createDataFrame([(0, 0, "user", "x")], CONV)))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
