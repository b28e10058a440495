import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartwright.llm import suffix_dedup
from cartwright.llm.suffix_dedup import matching_statistics, remove_repeats, suffix_order

from .helpers import DOCS, awkward_docs, frame, words


def brute(rows, length):
    raws = [(r[1] or "").encode() for r in rows]
    count = {}
    for raw in raws:
        for i in range(len(raw) - length + 1):
            k = raw[i:i + length]
            count[k] = count.get(k, 0) + 1
    out = []
    for r, raw in zip(rows, raws):
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            if count[raw[i:i + length]] > 1:
                gone[i:i + length] = b"\x01" * length
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((r[0], len(raw), sum(gone), spans, bytes(b for b, g in zip(raw, gone) if not g)))
    return out


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


def same(spark, rows, length, parts=3, **how):
    got = remove_repeats(frame(spark, rows).repartition(parts), length=length, **how)
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got.collect()]
    assert order(got) == order(brute(rows, length))


def corpus(seed, n=60):
    """Shared passages, near and exact copies, periodic and random texts."""
    r = random.Random(seed)
    passages = [words(r.randrange(20, 60), 1000 + i) for i in range(5)]
    rows = []
    for i in range(n):
        kind = i % 6
        text = words(r.randrange(5, 120), seed * 100 + i)
        if kind == 1:
            text += " " + r.choice(passages) + " " + words(r.randrange(3, 30), i)
        elif kind == 2:
            text = r.choice(passages)[r.randrange(30):] + text[:r.randrange(1, 80)]
        elif kind == 3 and rows:
            text = rows[r.randrange(len(rows))][1]
        elif kind == 4 and rows:
            old = rows[r.randrange(len(rows))][1]
            at = r.randrange(len(old))
            text = old[:at] + r.choice(["x", "", "yz"]) + old[at + 1:]
        elif kind == 5:
            text = (r.choice(["ab", "abc ", "z", "é!"]) * 200)[:r.randrange(150, 500)]
        rows.append((i, text, "en", "s", 1))
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_brute_force(spark, seed):
    same(spark, corpus(seed), 64, anchor=16)


def test_anchor_as_long_as_the_string_and_small_buckets(spark):
    rows = corpus(4)
    same(spark, rows, 32, anchor=32)
    same(spark, rows, 100, anchor=24, bucket_bytes=2000)


def test_hot_minimizers_are_counted_one_by_one(spark):
    same(spark, corpus(5), 64, anchor=16, group_pieces=1)


def test_kinds_of_a_hot_minimizer_are_split(spark):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        hot = spark.range(60_000).selectExpr("IF(id % 3 = 0, -1, id) AS g", "xxhash64(id) AS c", "1L AS n")
        counted = hot.unionAll(spark.createDataFrame([(1, 5, 2), (1, 5, 1), (60_001, 5, 2), (60_002, 5, 1)], hot.schema))
        df = suffix_dedup._kinds(counted.repartition(8))
        got = df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "Window" not in plan and "skew=true" in plan
    assert {r.kinds for r in got if r.g == -1} == {20_000} and sum(r.g == -1 for r in got) == 20_000
    assert sorted((r.g, r.n, r.kinds) for r in got if r.g != -1) == [(1, 1, 2), (1, 3, 2), (60_001, 2, 1)]


def test_long_documents_in_parts(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PART_BYTES", 500)
    same(spark, corpus(6), 64, anchor=16)


def test_awkward_rows(spark):
    rows = [r for r in awkward_docs() if len(r[1] or "") < 30_000]
    same(spark, rows, 200)
    assert remove_repeats(frame(spark, [], DOCS)).count() == 0


def test_a_third_are_copies(spark):
    rows = [(i, words(60, 0) if i % 3 == 0 else words(50, i), "en", "s", 1) for i in range(300)]
    same(spark, rows, 100, parts=6)


def test_extra_columns(spark):
    rows = corpus(7, 20)
    df = frame(spark, rows).select("*", *[F.lit("x").alias(c) for c in ("rk", "at", "g", "c", "n", "kinds", "marks", "start")])
    got = sorted((r.doc_id, r.n_removed) for r in remove_repeats(df, length=64, anchor=16).collect())
    assert got == sorted((r[0], r[2]) for r in brute(rows, 64))


def test_suffix_order_and_matching_statistics():
    for seed in range(30):
        r = random.Random(seed)
        strings = [bytes(r.choice(b"ab" if seed % 2 else b"abcd\x00\xff") for _ in range(r.randrange(1, 40))) for _ in range(6)]
        strings += strings[:2] + [b"a" * 30]
        raw = b"".join(strings)
        end = np.repeat(np.cumsum([len(s) for s in strings]), [len(s) for s in strings])
        text, left = np.frombuffer(raw, np.uint8), end - np.arange(len(raw))
        suffixes = [raw[i:i + n] for i, n in enumerate(left.tolist())]
        assert suffix_order(text, left).tolist() == sorted(range(len(raw)), key=lambda i: (suffixes[i], i))

        def common(a, b):
            n = 0
            while n < min(len(a), len(b)) and a[n] == b[n]:
                n += 1
            return n

        want = [max(common(s, t) for j, t in enumerate(suffixes) if j != i) for i, s in enumerate(suffixes)]
        assert matching_statistics(text, left).tolist() == want
