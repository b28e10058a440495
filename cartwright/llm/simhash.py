"""SimHash near-deduplication by a segment-popcount embedding.

*Fingerprints.* Lower-cased words, ``shingle`` words to a shingle, repeats
counted; a bit is 1 when more than half of the shingles' XXH64 have it.

*Links.* Fingerprints that differ in at most ``max_bits`` bits are linked.
Every fingerprint is embedded as the counts of one bits in its ``SEGMENT_BITS``
wide segments. The Manhattan distance of two embeddings never exceeds their bit
distance, so a range join over a grid in that space finds every link: the
segments are dealt into groups; by the pigeonhole principle linked fingerprints
are within ``max_bits // groups`` of each other in some group. A grid cell is a
group's count vector; points are copied to the cells in that radius (none with
``max_bits + 1`` groups), and within a cell ordered by the total count of
the other segments, where only a band of ``max_bits`` has to be compared. What
the bound lets through is verified on all 64 bits.

Equal fingerprints are collapsed (partial aggregation) before anything else.
Inside a cell a breadth-first search compares each fingerprint with those not
yet reached only and emits a spanning forest, so a dense cell of n near copies
gives fewer than n rows, and it is cheap exactly where it is dense. Cells with
more than ``CELL_ROWS`` fingerprints are dealt into pairs of blocks, each a
task of its own; the count decides only how a cell is split, every pair of
fingerprints of a cell meets in some block pair.

Defined cases: null, empty and blank texts have fingerprint zero, linked like
any other; fewer words than a shingle make one shingle; rows with a null doc_id
take part, their component is the smallest doc_id of their group (null if it has
none); repeated rows are equal fingerprints; an empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from .common import materialize, whole_row
from .graph import components

SEED = 42
SEGMENT_BITS = 2
CELL_ROWS = 20_000
#: Hashes whose bits are counted at a time: a bound on memory for long texts.
_CHUNK = 1 << 14


def fingerprint_of(text: str | None, shingle: int) -> int:
    words = b"" if text is None else text.encode("utf-8", "surrogatepass").lower()
    starts = words.split()
    if not starts:
        return 0
    joined = b" ".join(starts)
    ends = np.cumsum(np.fromiter(map(len, starts), np.int64, len(starts)) + 1) - 1
    n = max(1, len(starts) - shingle + 1)
    first = np.concatenate(([0], ends[:-1] + 1))[:n].tolist()
    last = ends[min(shingle, len(starts)) - 1:].tolist()
    ones = np.zeros(64, np.int64)
    for at in range(0, n, _CHUNK):
        hashes = np.array([xxh64_intdigest(joined[a:b], SEED) for a, b in
                           zip(first[at:at + _CHUNK], last[at:at + _CHUNK])], dtype=">u8")
        # bit counts of up to 255 hashes at a time stay in bytes
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1)
        pad = -len(bits) % 255
        if pad:
            bits = np.concatenate((bits, np.zeros((pad, 64), np.uint8)))
        ones += np.add.reduce(bits.reshape(-1, 255, 64), axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n).view(">u8")[0])


def fingerprint(text: Column, shingle: int) -> Column:
    """64-bit SimHash of a text column, as a signed long."""

    @F.pandas_udf("long")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(np.array([fingerprint_of(t, shingle) for t in texts], np.uint64).view(np.int64))

    return of(text)


def _segments(fp: np.ndarray) -> np.ndarray:
    """Embedding: one bits per segment, one row per fingerprint."""
    bits = np.unpackbits(fp.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    return bits.reshape(len(fp), -1, SEGMENT_BITS).sum(axis=2, dtype=np.int64)


def _offsets(width: int, radius: int) -> np.ndarray:
    """Count-vector offsets in a Manhattan ball."""
    if radius == 0:
        return np.zeros((1, width), np.int64)
    reach = range(-min(radius, SEGMENT_BITS), min(radius, SEGMENT_BITS) + 1)
    return np.array([o for o in product(reach, repeat=width) if sum(map(abs, o)) <= radius], np.int64)


def _grid(batches: Iterator[pd.DataFrame], max_bits: int, groups: int) -> Iterator[pd.DataFrame]:
    """Copies of each fingerprint: its own cell (home) and those in reach."""
    radius = max_bits // groups
    parts = np.array_split(np.arange(64 // SEGMENT_BITS), groups)
    for df in batches:
        counts = _segments(df["fp"].to_numpy(np.int64).view(np.uint64))
        total = counts.sum(axis=1)
        for g, part in enumerate(parts):
            scale = (SEGMENT_BITS + 1) ** np.arange(len(part))
            for off in _offsets(len(part), radius):
                at = counts[:, part] + off
                ok = ((at >= 0) & (at <= SEGMENT_BITS)).all(axis=1)
                yield pd.DataFrame({
                    "cell": g + groups * (at[ok] @ scale), "fp": df["fp"][ok], "home": not off.any(),
                    "band": (total - counts[:, part].sum(axis=1))[ok]})


def _forest(fp: np.ndarray, band: np.ndarray, home: np.ndarray, max_bits: int) -> np.ndarray:
    """Edges of a spanning forest of the links among ``fp``, in order of band.

    Copies from other cells (not ``home``) are compared with home rows only.
    """
    left, left_fp, left_band = np.arange(len(fp)), fp, band  # not reached yet
    edges = []
    while len(left):
        queue = [left[0]]
        left, left_fp, left_band = left[1:], left_fp[1:], left_band[1:]
        while queue and len(left):
            at = queue.pop()
            lo, hi = np.searchsorted(left_band, (band[at] - max_bits, band[at] + max_bits + 1))
            if lo == hi:
                continue
            hit = np.bitwise_count(left_fp[lo:hi] ^ fp[at]) <= max_bits
            if not home[at]:
                hit &= home[left[lo:hi]]
            if hit.any():
                found = left[lo:hi][hit]
                edges.extend((at, x) for x in found)
                queue.extend(found)
                stay = np.ones(len(left), bool)
                stay[lo:hi] = ~hit
                left, left_fp, left_band = left[stay], left_fp[stay], left_band[stay]
    return np.array(edges, np.int64).reshape(-1, 2)


def links(fps: DataFrame, max_bits: int, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Spanning links (a, b) among distinct fingerprints ``fp``: fingerprints
    within ``max_bits`` bits are connected, others are never linked."""
    groups = min(max_bits + 1, 64 // SEGMENT_BITS)
    grid = materialize(fps.select("fp").mapInPandas(
        lambda it: _grid(it, max_bits, groups), "cell long, fp long, home boolean, band int"), "simhash-grid")
    cells = grid.groupBy("cell").agg(F.count("*").alias("n")).filter("n > 1").select(
        "cell", F.ceil(F.col("n") / cell_rows).cast("int").alias("blocks"))
    dealt = grid.join(cells, "cell").withColumn("block", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
    # each row goes to the pairs that its block is part of
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    pairs = dealt.withColumn("other", other).select(
        "cell", "fp", "home", "band", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"))

    def cell(df: pd.DataFrame) -> pd.DataFrame:
        df = df.sort_values(["band", "fp"])
        fp = df["fp"].to_numpy(np.int64)
        edges = _forest(fp.view(np.uint64), df["band"].to_numpy(np.int64), df["home"].to_numpy(bool), max_bits)
        return pd.DataFrame({"a": fp[edges[:, 0]], "b": fp[edges[:, 1]]})

    return pairs.groupBy("cell", "lo", "hi").applyInPandas(cell, "a long, b long").filter("a <> b")


def _labelled(docs: DataFrame, id_col: str, text_col: str, shingle: int, max_bits: int, carry: bool,
              cell_rows: int) -> tuple[DataFrame, DataFrame]:
    """Rows with fingerprints (doc_id, fp; with ``carry`` row and its key rk), and
    the component of each fingerprint (fp, component_id, component)."""
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), fingerprint(F.col(f"`{text_col}`"), shingle).alias("fp"),
                       *([whole_row(docs).alias("row"), F.monotonically_increasing_id().alias("rk")] if carry else []))
    rows = materialize(rows, "simhash-rows")
    fps = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("low")), "simhash-distinct")
    found = components(links(fps, max_bits, cell_rows))  # over fingerprints
    label = fps.join(found, fps["fp"] == found["id"], "left").select(
        "fp", "low", F.coalesce("component", "fp").alias("component"))
    label = materialize(label, "simhash-labels")
    # a component may hold a third of all fingerprints: the aggregate is dealt anew, by another
    # value, since AQE splits a join but not one with an aggregate in the same stage
    key = F.bitwise_not("component").alias("key")
    lowest = label.groupBy("component").agg(F.min("low").alias("component_id")).select(key, "component_id")
    return rows, label.withColumn("key", key).join(lowest, "key").select("fp", "component_id", "component")


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                       max_bits: int = 4, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Per row: doc_id, fp, component_id."""
    rows, labels = _labelled(docs, id_col, text_col, shingle, max_bits, False, cell_rows)
    return rows.join(labels, "fp").select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, max_bits: int = 4,
                cell_rows: int = CELL_ROWS) -> DataFrame:
    """The rows of ``docs`` without near copies: of every component the row with
    the smallest doc_id (null last, then the earliest row) stays. The rows
    themselves are moved once, when the staying ones are picked."""
    rows, labels = _labelled(docs, id_col, text_col, shingle, max_bits, True, cell_rows)
    order = F.struct(F.col("doc_id").isNull().alias("u"), F.col("doc_id").alias("d"), F.col("rk").alias("k"))
    best = (rows.select("rk", "doc_id", "fp").join(labels, "fp").groupBy("component").agg(F.min(order).alias("best"))
            .select(F.col("best.k").alias("rk")))
    return rows.select("rk", "row").join(best, "rk", "left_semi").select("row.*")
