import random

import pytest

from cartwright.llm.mixing import mix_sources, repeated

from .helpers import DOCS, awkward_docs, frame, words


def size_of(text):
    return len("".join(" " if c in " \t\n\x0b\x0c\r" else c for c in text or "").replace(" ", "\n").split("\n")) - (
        "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in text or "").replace(" ", "\n").split("\n")).count("")


def brute_targets(sizes, weights=(3, 1, 2), share=1.5, cap=2):
    """Water-filling round by round."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, target = share * sum(sizes.values()), set(order), {}
    while open_:
        level = left / sum(w[s] for s in open_)
        full = {s for s in open_ if w[s] * level >= cap * sizes[s]}
        if not full:
            target |= {s: w[s] * level for s in open_}
            break
        target |= {s: float(cap * sizes[s]) for s in full}
        left -= sum(cap * sizes[s] for s in full)
        open_ -= full
    return target


def check(rows, got):
    sizes = {}
    for r in rows:
        sizes[r[3]] = sizes.get(r[3], 0) + size_of(r[1])
    target = brute_targets(sizes)
    assert len(got) == len(rows)
    taken, biggest = dict.fromkeys(sizes, 0), dict.fromkeys(sizes, 0)
    by_id = {}
    for r in rows:
        by_id.setdefault((r[0], size_of(r[1])), []).append(r[3])
    for g in got:
        source = next(s for s in by_id[g.doc_id, g.size] if sizes[s] == g.source_size)
        assert g.target == pytest.approx(target[source])
        assert 0 <= g.taken <= 2 * g.size and (g.size == 0 or g.taken % g.size == 0)
        taken[source] += g.taken
        biggest[source] = max(biggest[source], g.size)
    for s in sizes:
        assert abs(taken[s] - target[s]) <= max(1, biggest[s])


def test_awkward_rows(spark):
    rows = awkward_docs()
    check(rows, mix_sources(frame(spark, rows)).collect())


def test_near_the_target_and_repeatable(spark):
    r = random.Random(1)
    rows = [(i, words(r.randrange(1, 60), i), "en", "hot" if i % 3 == 0 else f"s{r.randrange(9)}", 1) for i in range(1500)]
    a = sorted(map(tuple, mix_sources(frame(spark, rows)).collect()))
    b = sorted(map(tuple, mix_sources(frame(spark, rows).repartition(13)).collect()))
    assert a == b
    check(rows, mix_sources(frame(spark, rows)).collect())
    # whole documents: off by half of the one at the boundary at most
    sizes, got = {}, mix_sources(frame(spark, rows)).collect()
    source = {r_[0]: r_[3] for r_ in rows}
    for g in got:
        sizes.setdefault(source[g.doc_id], [g.target, 0])[1] += g.taken
    assert all(abs(t - n) <= 30 for t, n in sizes.values())


def test_a_third_of_all_rows_equal(spark):
    """Copies are taken one by one: each source comes within half a document."""
    rows = [(7, "ten words " * 5, "en", "hot", 1)] * 300 + [(8, "ten words " * 5, "en", "warm", 1)] * 300
    rows += [(9, "five words in all here", "en", None, 1)] * 299
    df = frame(spark, rows).repartition(11)
    for weights in ((3, 1, 2), (1, 5, 1)):
        taken, target = {}, {}
        for r in mix_sources(df, weights=weights).collect():
            taken[r.doc_id] = taken.get(r.doc_id, 0) + r.taken
            target[r.doc_id] = r.target
        size = {7: 10, 8: 10, 9: 5}
        assert all(abs(taken[d] - target[d]) <= size[d] / 2 for d in size), (taken, target)


def test_larger_budgets_contain_smaller_ones(spark):
    rows = [(i, words(10, i), "en", f"s{i % 2}", 1) for i in range(300)]
    df = frame(spark, rows)
    small = {r.doc_id: r.taken for r in mix_sources(df, share=(1, 2)).collect()}
    large = {r.doc_id: r.taken for r in mix_sources(df, share=(4, 5)).collect()}
    assert all(large[d] >= n for d, n in small.items()) and sum(large.values()) > sum(small.values())


def test_repeated_rows_of_a_mix(spark):
    rows = awkward_docs()
    df = frame(spark, rows)
    mixed = mix_sources(df, carry=True)
    out = repeated(mixed)
    assert out.columns == df.columns
    want = sum(r.taken // r.size for r in mixed.collect() if r.size)
    assert out.count() == want


def test_empty_and_wordless_tables(spark):
    assert mix_sources(frame(spark, [], DOCS)).count() == 0
    got = mix_sources(frame(spark, [(1, None, None, None, None), (2, " ", "en", "a", 1)])).collect()
    assert [(r.size, r.target, r.taken) for r in got] == [(0, 0.0, 0)] * 2


def test_plan_has_no_python(spark):
    plan = mix_sources(frame(spark, awkward_docs()))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
