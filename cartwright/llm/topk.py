"""Exact top-k by inner product with a pivot-distance index.

Vectors are scaled to integers. One more component, sqrt(M - |x|^2) with M the
largest squared length, puts all of them on a sphere on which a large inner
product with a query q (last component 0) is a small distance:
|x' - q'|^2 = M + |q|^2 - 2 q.x.

*Index.* Every vector is keyed by its nearest pivot and its distance to it. The
distances are cut into ``BUCKETS`` equal steps; neighbouring steps of a pivot
are joined into annuli of about ``RING_ROWS`` rows, and a step with more rows (many
equal vectors) is dealt by hash into several of that size. The plan of the annuli
has ``PIVOTS * BUCKETS`` entries, however many vectors there are.

*Search.* A query first meets the annulus next to it; its k-th score there bounds
the distance r of whatever may still enter its result. By the triangle inequality
only annuli that meet [d(q, p) - r, d(q, p) + r] can hold it; the expansion
stops there, annuli outside are never read for this query, and inside an annulus,
sorted by distance, only that band is scored. Scores are exact integers; the
bounds carry a slack above rounding errors. Queries are dealt into blocks, so that
a task meets one annulus and one block; each yields its k best, which are merged.

Defined cases: vectors that are null, hold a null or a non-finite component, or
whose scaled components exceed a long take no part, nor do rows without id;
shorter vectors count as padded with zeros; rows repeated with one id are rows of
their own (a query leaves out only itself); ties go to the smaller id; fewer than k
candidates give all; an empty table gives an empty result. Scores must fit a long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

PIVOTS = 32
BUCKETS = 256
RING_ROWS = 16_384
QUERY_ROWS = 8_192
_TILE = 512
_DEALT = 256
_FOUND = "query_row long, query_id long, row long, vec_id long, score long"


def _scaled(batches: Iterator[pd.DataFrame], scale: float) -> Iterator[pd.DataFrame]:
    for df in batches:
        keep, data, square = [], [], []
        for i, v in enumerate(df["v"]):
            if v is None or any(x is None for x in v):
                continue
            with np.errstate(over="ignore"):
                x = np.floor(scale * np.asarray(v, float))
            if not (np.abs(x) < 2.0 ** 62).all():  # false for NaN too
                continue
            keep.append(i)
            data.append(x.astype("<i8").tobytes())
            square.append(float(x @ x))
        part = df.iloc[keep]
        yield pd.DataFrame({"row": part["row"], "vec_id": part["vec_id"], "is_query": part["is_query"], "v": data,
                            "square": square})


def _matrix(values: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(values), width), np.int64)
    for i, v in enumerate(values):
        x = np.frombuffer(v, "<i8")
        out[i, :len(x)] = x
    return out


class _Geometry:
    """Pivots on the sphere, and distances to them."""

    def __init__(self, pivots: np.ndarray, top: float) -> None:
        self.width, self.top = pivots.shape[1], top
        self.pivots = pivots.astype(float)
        self.lift = np.sqrt(np.maximum(0, top - (self.pivots ** 2).sum(axis=1)))
        self.reach = 2 * np.sqrt(top) + 1
        self.slack = 1e-6 * (1 + np.sqrt(top))

    def data(self, x: np.ndarray, square: np.ndarray) -> np.ndarray:
        dots = x.astype(float) @ self.pivots.T + np.sqrt(np.maximum(0, self.top - square))[:, None] * self.lift
        return np.sqrt(np.maximum(0, 2 * self.top - 2 * dots))

    def query(self, q: np.ndarray, square: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(0, self.top + square[:, None] - 2 * q.astype(float) @ self.pivots.T))

    def bucket(self, distance: np.ndarray) -> np.ndarray:
        return np.clip((distance / self.reach * BUCKETS).astype(np.int64), 0, BUCKETS - 1)


class _Plan:
    """Annuli of each pivot: the first and last step, first number, parts."""

    def __init__(self, counts: np.ndarray, ring_rows: int) -> None:
        rings = []  # pivot, first step, last step, parts
        for p, row in enumerate(counts):
            first, rows = 0, 0
            for b, n in enumerate(row.tolist()):
                if n > ring_rows:
                    if rows:
                        rings.append((p, first, b - 1, 1))
                    rings.append((p, b, b, -(-n // ring_rows)))
                    first, rows = b + 1, 0
                elif rows + n > ring_rows:
                    rings.append((p, first, b - 1, 1))
                    first, rows = b, n
                else:
                    rows += n
            if rows:
                rings.append((p, first, BUCKETS - 1, 1))
        self.pivot, self.lo, self.hi, self.parts = (np.array(c, np.int64) for c in zip(*rings))
        self.number = np.cumsum(self.parts) - self.parts
        self.of = np.full((len(counts), BUCKETS), -1, np.int64)
        for i, (p, lo, hi, _) in enumerate(rings):
            self.of[p, lo:hi + 1] = i


def _key(batches: Iterator[pd.DataFrame], geo: _Geometry) -> Iterator[pd.DataFrame]:
    for df in batches:
        d = geo.data(_matrix(df["v"], geo.width), df["square"].to_numpy())
        pivot = d.argmin(axis=1)
        dist = d[np.arange(len(d)), pivot]
        yield df.assign(pivot=pivot.astype(np.int32), step=geo.bucket(dist).astype(np.int32), dist=dist)


def _deal(batches: Iterator[pd.DataFrame], geo: _Geometry, plan: _Plan, near: bool, blocks: int) -> Iterator[pd.DataFrame]:
    """Queries with the annuli they have to meet, some queries at a time: there are
    tables of queries by annuli."""
    for df in (whole.iloc[at:at + _DEALT] for whole in batches for at in range(0, len(whole), _DEALT)):
        d = geo.query(_matrix(df["v"], geo.width), df["square"].to_numpy())
        # the annulus next to a query: that of the nearest pivot around its distance
        middle = geo.bucket(d[:, plan.pivot])
        gap = np.maximum(0, np.maximum(plan.lo - middle, middle - plan.hi))
        rank = d[:, plan.pivot].argsort(axis=1, kind="stable").argsort(axis=1, kind="stable")
        home = (gap * len(plan.pivot) + rank).argmin(axis=1)
        if near:
            hits, parts = [(i, int(h)) for i, h in enumerate(home)], np.ones_like(plan.parts)
        else:
            r = df["radius"].to_numpy()[:, None] + geo.slack
            lo = geo.bucket(d - r)[:, plan.pivot] <= plan.hi
            hi = geo.bucket(np.minimum(d + r, geo.reach))[:, plan.pivot] >= plan.lo
            hits, parts = np.argwhere(lo & hi).tolist(), plan.parts
        who, ring = [], []
        for i, h in hits:
            for part in range(int(parts[h])):
                if near or part or h != home[i]:
                    who.append(i)
                    ring.append(int(plan.number[h]) + part)
        out = df.iloc[who].reset_index(drop=True)
        out["ring"] = np.array(ring, np.int64)
        out["block"] = (out["row"].to_numpy() * 2654435761 % (1 << 32) % blocks).astype(np.int32)
        yield out[["ring", "block", "row", "vec_id", "v", "square", "radius"]]


def _score(vectors: pd.DataFrame, queries: pd.DataFrame, k: int, geo: _Geometry) -> pd.DataFrame:
    """The k best of an annulus for every query of a block."""
    if not len(vectors) or not len(queries):
        return pd.DataFrame({c.split()[0]: pd.Series(dtype="int64") for c in _FOUND.split(", ")})
    vectors = vectors.sort_values(["dist", "row"])
    dist = vectors["dist"].to_numpy()
    ids, rows = vectors["vec_id"].to_numpy(), vectors["row"].to_numpy()
    pivot = int(vectors["pivot"].iloc[0])
    x, q = _matrix(vectors["v"], geo.width), _matrix(queries["v"], geo.width)
    exact = geo.top < 2.0 ** 51  # then sums of products are exact as doubles
    x = x.astype(float) if exact else x
    to_pivot = geo.query(q, queries["square"].to_numpy())[:, pivot]
    radius = queries["radius"].to_numpy() + geo.slack
    q = q.astype(float) if exact else q
    q_ids, q_rows = queries["vec_id"].to_numpy(), queries["row"].to_numpy()
    order = np.argsort(to_pivot, kind="stable")  # neighbouring queries share a band
    out = []
    for at in range(0, len(q), _TILE):
        tile = order[at:at + _TILE]
        lo = int(np.searchsorted(dist, (to_pivot[tile] - radius[tile]).min(), side="left"))
        hi = int(np.searchsorted(dist, (to_pivot[tile] + radius[tile]).max(), side="right"))
        if lo == hi:
            continue
        scores = q[tile] @ x[lo:hi].T
        for j, i in enumerate(tile):
            s = scores[j].astype(np.int64)
            own = rows[lo:hi] == q_rows[i]
            n = len(s) - int(own.sum())
            if n <= 0:
                continue
            s[own] = np.iinfo(np.int64).min
            if n > k:
                floor = np.partition(s, len(s) - k)[len(s) - k]
                pick = np.flatnonzero((s >= floor) & ~own)
            else:
                pick = np.flatnonzero(~own)
            pick = pick[np.lexsort((rows[lo:hi][pick], ids[lo:hi][pick], -s[pick]))][:k]
            out.append((np.full(len(pick), q_rows[i]), np.full(len(pick), q_ids[i]), rows[lo:hi][pick],
                        ids[lo:hi][pick], s[pick]))
    names = [c.split()[0] for c in _FOUND.split(", ")]
    return pd.DataFrame({n: np.concatenate([o[i] for o in out]) if out else np.empty(0, np.int64)
                         for i, n in enumerate(names)})


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_row").orderBy(F.col("score").desc(), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def top_k(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 20,
          scale: float = 64.0, pivots: int = PIVOTS, ring_rows: int = RING_ROWS,
          query_rows: int = QUERY_ROWS) -> DataFrame:
    """Per query and rank: query_id, rank, vec_id, score."""
    ids = vectors.select(F.col(f"`{id_col}`").alias("vec_id"), F.coalesce(is_query, F.lit(False)).alias("is_query"),
                         F.col(f"`{vector_col}`").alias("v"), F.monotonically_increasing_id().alias("row"))
    plain = materialize(ids.filter("vec_id IS NOT NULL").mapInPandas(
        lambda it: _scaled(it, scale), "row long, vec_id long, is_query boolean, v binary, square double"), "topk-rows")
    size = plain.agg(F.max("square").alias("top"), F.max(F.length("v")).alias("bytes"),
                     F.sum(F.col("is_query").cast("long")).alias("queries")).first()
    if not size["queries"]:
        return _best(plain.sparkSession.createDataFrame([], _FOUND), k).select("query_id", "rank", "vec_id", "score")
    # `pivots` different vectors, by hash; equal vectors are one
    hashed = plain.select(F.xxhash64("v").alias("h"), "v")
    lowest = hashed.select("h").distinct().orderBy("h").limit(pivots)
    picked = hashed.join(F.broadcast(lowest), "h").groupBy("h").agg(F.min("v").alias("v")).orderBy("h").toPandas()
    geo = _Geometry(_matrix(picked["v"], max(1, size["bytes"] // 8)), size["top"])
    keyed = materialize(plain.mapInPandas(lambda it: _key(it, geo), plain.schema.simpleString()[7:-1].replace(
        ":", " ").replace("bigint", "long") + ", pivot int, step int, dist double"), "topk-keyed")
    counts = np.zeros((len(picked), BUCKETS), np.int64)
    for r in keyed.groupBy("pivot", "step").count().collect():  # at most pivots * BUCKETS rows
        counts[r["pivot"], r["step"]] = r["count"]
    plan = _Plan(counts, ring_rows)

    def ringed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in batches:
            at = plan.of[df["pivot"].to_numpy(), df["step"].to_numpy()]
            part = df["row"].to_numpy() * 2654435761 % (1 << 32) % plan.parts[at]
            yield df.assign(ring=plan.number[at] + part)[["ring", "row", "vec_id", "v", "pivot", "dist"]]

    index = keyed.mapInPandas(ringed, "ring long, row long, vec_id long, v binary, pivot int, dist double")
    blocks = -(-size["queries"] // query_rows)
    queries = plain.filter("is_query").select("row", "vec_id", "v", "square")
    dealt = "ring long, block int, row long, vec_id long, v binary, square double, radius double"

    def search(asked: DataFrame, near: bool) -> DataFrame:
        met = asked.mapInPandas(lambda it: _deal(it, geo, plan, near, blocks), dealt)
        asked_of = met.select(F.col("ring").alias("to"), F.col("block").alias("by")).distinct()
        copies = index.join(asked_of, F.col("ring") == F.col("to"))
        return copies.groupBy("to", "by").cogroup(met.groupBy("ring", "block")).applyInPandas(
            lambda v, q: _score(v, q, k, geo), _FOUND)

    first = materialize(search(queries.withColumn("radius", F.lit(geo.reach + np.sqrt(geo.top)).cast("double")), True),
                        "topk-first")
    kth = first.groupBy("query_row").agg(F.min("score").alias("kth"), F.count("*").alias("n")).filter(F.col("n") >= k)
    far = 2 * (geo.reach + np.sqrt(geo.top))
    radius = F.sqrt(F.greatest(F.lit(0.0), F.lit(float(size["top"])) + F.col("square") - 2 * F.col("kth")))
    bounded = queries.join(kth, F.col("row") == F.col("query_row"), "left").select(
        "row", "vec_id", "v", "square", F.when(F.col("kth").isNull(), F.lit(far)).otherwise(radius).alias("radius"))
    found = first.unionByName(search(bounded, False))
    return _best(found, k).select("query_id", "rank", "vec_id", "score")
