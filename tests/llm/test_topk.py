import math
import random

from pyspark.sql import functions as F

from cartwright.llm.topk import top_k

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, every, k):
    good = []
    for i, (vec_id, v, *_) in enumerate(rows):
        if vec_id is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            good.append((i, vec_id, [math.floor(64 * x) for x in v]))
    out = []
    for i, q_id, q in good:
        if q_id % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(q, v)), vec_id, j) for j, vec_id, v in good if j != i)[:k]
        out += [(q_id, r, vec_id, -s) for r, (s, vec_id, _) in enumerate(scored, 1)]
    return sorted(out)


def exact(spark, rows, every=20, k=20, **how):
    # floats as Spark stores them
    import struct

    stored = [(i, None if v is None else [None if x is None else struct.unpack("f", struct.pack("f", x))[0] for x in v], n)
              for i, v, n in rows]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3, "label")
    got = top_k(df, F.col("vec_id") % every == 0, k=k, **how)
    assert sorted(map(tuple, got.select("query_id", "rank", "vec_id", "score").collect())) == brute(stored, every, k)


def vectors(n, d, seed, scale=1.0):
    r = random.Random(seed)
    return [(i, [scale * r.gauss(0, 0.2) for _ in range(d)], i % 3) for i in range(n)]


def test_random_vectors(spark):
    exact(spark, vectors(500, 16, 1), pivots=8, ring_rows=40, query_rows=7)


def test_clustered_vectors_and_many_equal_ones(spark):
    r = random.Random(2)
    centres = [[r.gauss(0, 1) for _ in range(8)] for _ in range(6)]
    rows = [(i, [c + r.gauss(0, 0.02) for c in centres[i % 6]], i % 2) for i in range(400)]
    rows += [(400 + i, [0.25] * 8, 0) for i in range(250)]
    exact(spark, rows, every=10, pivots=5, ring_rows=30)


def test_norms_differ_widely(spark):
    rows = vectors(150, 6, 3) + [(200 + i, [50.0 * x for x in v], 0) for i, v, _ in vectors(40, 6, 4)]
    exact(spark, rows, every=10, k=5, pivots=4, ring_rows=16)


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.5, 0.5, 0.1], 0), (0, [0.5, 0.5, 0.1], 0), (20, None, 0), (40, [0.1, None, 0.2], 0), (60, [nan, 0.1, 0.2], 0),
            (80, [0.1, -inf, 0.1], 0), (None, [0.9, 0.9, 0.9], 0), (100, [0.0, 0.0, 0.0], 0), (120, [-0.5, -0.5, 0.3], None),
            (1, [0.3, 0.3, 0.3], 0), (2, [0.3, 0.3, 0.3], 0), (140, [1.0, 2.0], 0), (160, [], 0)]
    exact(spark, rows)
    exact(spark, rows, k=2, pivots=1, ring_rows=1)


def test_large_components_are_exact(spark):
    rows = [(i, [4e5 * (i + 1) + 0.25, -1e5 * i, 5.5], 0) for i in range(45)]
    exact(spark, rows, k=7)


def test_fewer_candidates_than_k_and_empty(spark):
    exact(spark, vectors(5, 3, 5), every=2)
    exact(spark, [(7, [1.0], 0)], every=7)
    exact(spark, [], every=2)


def test_extra_columns(spark):
    df = spark.createDataFrame(vectors(60, 4, 6), SCHEMA)
    noisy = df.select("*", *[F.lit("x").alias(c) for c in ("row", "v", "ring", "score", "rank", "is_query", "block", "dist")])
    pick = F.col("vec_id") % 20 == 0
    assert sorted(top_k(noisy, pick).collect()) == sorted(top_k(df, pick).collect())
