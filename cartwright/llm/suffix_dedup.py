"""Exact substring deduplication with run-length indexes.

Removes every byte that a ``length``-byte string covers which starts anywhere
else in the corpus as well. No single index of the corpus is built; equal strings
are brought together first:

1. *Pieces.* The strings that start in a document are cut into runs which share
   their minimizer, the smallest hashed ``anchor``-byte string they contain.
   Equal strings have equal minimizers at equal offsets, so they lie in pieces
   with the same minimizer hash, wherever they are. A piece holds on average
   some 85 strings in 285 bytes; what is shuffled is its two hashes.
2. *Whole pieces.* A piece that occurs twice or more is removed wherever it is.
   Pieces are counted with map-side aggregation, and marked by a join that AQE
   splits where a piece is hot.
3. *Run-length index.* Different pieces with one minimizer may still share strings.
   One copy of each goes, by minimizer, into buckets of ``BUCKET_BYTES``. A bucket
   gets a run-compressed Burrows-Wheeler transform: the longest match of a
   suffix with its neighbours in suffix order is compared at run ends only (the
   samples) and streams from there in text order, falling by one per byte. These are
   the matching statistics of the bucket against itself; starts with ``length`` or
   more are repeated strings.
4. *Hot minimizers.* A minimizer with more than ``GROUP_PIECES`` different
   pieces would not fit a bucket; the strings of its pieces are counted one by
   one, by 128-bit hash, with map-side aggregation. This is exact as well.
5. Marked byte ranges meet their documents, once, and are cut out.

Defined cases: a null text is empty; texts shorter than ``length`` lose nothing;
texts of any length are read whole, in parts of ``PART_BYTES``; copies and
repeated rows lose all their bytes (if long enough), none is spared; null ids stay
null; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest, xxh3_128_digest

from cartwright.session import remove

from .common import materialize, materialize_at

LENGTH = 200
ANCHOR = 32
PART_BYTES = 1 << 20
BUCKET_BYTES = 2 << 20
GROUP_PIECES = 20_000
_LEN_BITS = 12
_MIX = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93))
_PLACE = np.uint64((1 << 24) - 1)


def _words_at(raw: bytes, n: int, at: int) -> np.ndarray:
    """Eight bytes from every position on, as one number."""
    return np.ndarray((n,), "<u8", raw, at, (1,))


def _anchor_hashes(raw: bytes, anchor: int) -> np.ndarray:
    n = len(raw) - anchor + 1
    h = np.zeros(n, np.uint64)
    for i, at in enumerate(range(0, anchor, 8)):
        h ^= _words_at(raw, n, at)
        h *= _MIX[i % 4]
        h ^= h >> np.uint64(29)
    h *= _MIX[1]
    h ^= h >> np.uint64(32)
    return h


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    n, span, out = len(x) - width + 1, 1, x
    while 2 * span <= width:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    return np.minimum(out[:n], out[width - span:width - span + n])


def pieces_of(raw: bytes, sizes: np.ndarray, length: int, anchor: int) -> tuple[np.ndarray, ...]:
    """Pieces of concatenated documents: document, start in ``raw``, bytes, minimizer."""
    if len(raw) < length:
        return tuple(np.empty(0, np.int64) for _ in range(3)) + (np.empty(0, np.uint64),)
    end = np.cumsum(sizes)
    begin = end - sizes
    h = _anchor_hashes(raw, anchor)
    key = (h & ~_PLACE) | np.arange(len(h), dtype=np.uint64)  # ties: the leftmost
    least = (_sliding_min(key, length - anchor + 1) & _PLACE).astype(np.int64)
    inside = np.zeros(len(raw) + 1, np.int32)
    long = sizes >= length
    np.add.at(inside, begin[long], 1)
    np.add.at(inside, end[long] - length + 1, -1)
    inside = np.cumsum(inside)[:len(least)] > 0  # a string starts here and ends in the same document
    turn = np.ones(len(least), bool)
    turn[1:] = least[1:] != least[:-1]
    turn[begin[begin < len(least)]] = True
    first = np.flatnonzero(turn & inside)
    stops = np.append(np.flatnonzero(turn | ~inside), len(least))
    stop = stops[np.searchsorted(stops, first, side="right")]
    return np.searchsorted(end, first, side="right"), first, stop - first + length - 1, h[least[first]]


def _parts(batch: pa.RecordBatch, length: int) -> Iterator[tuple[bytes, np.ndarray, np.ndarray, np.ndarray]]:
    """Runs of documents, or parts of a long one: bytes, sizes, rows of the batch,
    offsets of the parts in their documents. Parts overlap by ``length`` - 1 bytes."""
    texts = batch["text"]
    held, keys, offsets, size = [], [], [], 0
    for i in range(len(texts)):
        raw = texts[i].as_py()
        if len(raw) < length:
            continue
        for at in range(0, max(1, len(raw) - length + 1), PART_BYTES):
            part = raw[at:at + PART_BYTES + length - 1]
            held.append(part)
            keys.append(i)
            offsets.append(at)
            size += len(part)
            if size >= PART_BYTES:
                yield b"".join(held), np.array([len(x) for x in held]), np.array(keys), np.array(offsets)
                held, keys, offsets, size = [], [], [], 0
    if held:
        yield b"".join(held), np.array([len(x) for x in held]), np.array(keys), np.array(offsets)


def _emit(batches: Iterator[pa.RecordBatch], length: int, anchor: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        d, k = batch["d"].to_numpy(), batch["k"].to_numpy()
        for raw, sizes, keys, offsets in _parts(batch, length):
            doc, first, n, g = pieces_of(raw, sizes, length, anchor)
            begin = np.cumsum(sizes) - sizes
            start = first - begin[doc] + offsets[doc]
            content = np.array([xxh3_64_intdigest(raw[a:b]) for a, b in zip(first.tolist(), (first + n).tolist())],
                               np.uint64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(d[keys[doc]]), pa.array(k[keys[doc]]), pa.array((start << _LEN_BITS) | n),
                 pa.array(g.view(np.int64)), pa.array(content.view(np.int64))], names=["d", "k", "at", "g", "c"])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Map-side aggregation: (g, c) with counts, some batches at a time."""

    def counted(g: list[np.ndarray], c: list[np.ndarray]) -> pa.RecordBatch:
        pair = np.stack((np.concatenate(g), np.concatenate(c)), axis=1)
        order = np.lexsort((pair[:, 1], pair[:, 0]))
        pair = pair[order]
        first = np.flatnonzero(np.append(True, (pair[1:] != pair[:-1]).any(axis=1)))
        n = np.diff(np.append(first, len(pair)))
        return pa.RecordBatch.from_arrays([pa.array(pair[first, 0]), pa.array(pair[first, 1]), pa.array(n)],
                                          names=["g", "c", "n"])

    g, c, rows = [], [], 0
    for b in batches:
        if b.num_rows:
            g.append(b["g"].to_numpy())
            c.append(b["c"].to_numpy())
            rows += b.num_rows
        if rows > 1_000_000:
            yield counted(g, c)
            g, c, rows = [], [], 0
    if rows:
        yield counted(g, c)


def _kinds(counted: DataFrame) -> DataFrame:
    """(g, c, n) -> g, c, n, kinds: pieces that occur again or whose minimizer has
    ``kinds`` > 1 different pieces. A hot minimizer is counted map side and joined
    back: AQE splits a join, but not a window, nor a join with an aggregate in the
    same stage, so the counts are dealt anew, by another value than g."""
    different = counted.groupBy("g", "c").agg(F.sum("n").alias("n"))
    per_g = different.groupBy("g").agg(F.count("*").alias("kinds"), F.sum("n").alias("total")).filter("total > 1")
    key = F.bitwise_not("g").alias("key")
    return different.withColumn("key", key).join(per_g.select(key, "kinds"), "key").drop("key")


# ---------------------------------------------------------------- the index


def suffix_order(text: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Suffixes of concatenated strings in order; ``left`` bytes remain of its
    string at each position. A string's end sorts before any byte; equal
    suffixes are in text order. Prefix doubling that sorts open groups only."""
    n = len(text)
    rank = np.zeros(n, np.int64)
    padded = np.append(text.astype(np.int64) + 1, np.zeros(8, np.int64))
    for i in range(7):
        rank = (rank << 9) | np.where(left > i, padded[i:i + n], 0)
    order = np.argsort(rank, kind="stable")
    depth = 7
    value = rank[order]
    rank = np.empty(n, np.int64)
    head = np.flatnonzero(np.append(True, value[1:] != value[:-1]))
    place = np.repeat(head, np.diff(np.append(head, n)))  # of the group's first
    rank[order] = place + 1
    deepest = int(left.max(initial=0))
    while depth < deepest:
        sizes = np.diff(np.append(np.flatnonzero(np.append(True, np.diff(place) != 0)), n))
        slots = np.flatnonzero(np.repeat(sizes, sizes) > 1)
        if not len(slots):
            break
        who = order[slots]
        beyond = left[who] <= depth
        second = np.where(beyond, 0, rank[np.minimum(who + depth, n - 1)])
        by = np.lexsort((second, place[slots]))
        group = place[slots]
        who, second = who[by], second[by]
        order[slots] = who
        fresh = np.append(True, (group[1:] != group[:-1]) | (second[1:] != second[:-1]))
        new = slots[np.flatnonzero(fresh)]
        place[slots] = np.repeat(new, np.diff(np.append(np.flatnonzero(fresh), len(slots))))
        rank[who] = place[slots] + 1
        depth *= 2
    return order


def matching_statistics(text: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Longest match of each suffix with another one, up to its string's end.

    Only run ends of the Burrows-Wheeler transform are compared; elsewhere the
    match with the neighbour before is one shorter than that of the position
    before in the text, so it streams from the samples.
    """
    n = len(text)
    if n == 0:
        return np.empty(0, np.int64)
    order = suffix_order(text, left)
    starts = np.append(True, left[:-1] == 1)  # the first byte of a string has no byte before it
    before = np.where(starts, -1, np.append(np.int16(-1), text[:-1].astype(np.int16)))
    bwt = before[order]
    head = np.append(True, (bwt[1:] != bwt[:-1]) | (bwt[1:] < 0))
    slots = np.flatnonzero(head)[1:]
    a, b = order[slots], order[slots - 1]
    most = np.minimum(left[a], left[b])
    raw = text.tobytes() + bytes(16)
    eight = _words_at(raw, n + 8, 0)
    lcp = np.zeros(len(slots), np.int64)
    alive = np.arange(len(slots))
    while len(alive):
        x = eight[a[alive] + lcp[alive]] ^ eight[b[alive] + lcp[alive]]
        same = x == 0
        low = x & (~x + np.uint64(1))
        lcp[alive] += np.where(same, 8, np.bitwise_count(low - np.uint64(1)).astype(np.int64) >> 3)
        alive = alive[same & (lcp[alive] < most[alive])]
    lcp = np.minimum(lcp, most)
    # stream the samples in text order: the match falls by one per byte
    sample = np.full(n, -1, np.int64)
    sample[a] = lcp
    at = np.arange(n)
    string = np.cumsum(starts)
    far = 1 << 20
    peak = np.maximum.accumulate(np.where(sample >= 0, sample + at, 0) + string * (far + n))
    plcp = np.maximum(0, peak - string * (far + n) - at)
    by_order = plcp[order]
    best = np.empty(n, np.int64)
    best[order] = np.maximum(by_order, np.append(by_order[1:], 0))
    return best


def _partners(blobs: list[bytes], anchors: list[int], g: np.ndarray, length: int, anchor: int) -> np.ndarray:
    """Pieces that share half of a string's surroundings with another one.

    A string around the anchor has at least ``half`` bytes on one side of it, so
    pieces that share a string share those bytes there.
    """
    half = (length - anchor) // 2
    keep = np.zeros(len(blobs), bool)
    for side in (0, 1):
        h = np.zeros(len(blobs), np.uint64)
        for i, (blob, p) in enumerate(zip(blobs, anchors)):
            part = blob[p - half:p] if side == 0 and p >= half else blob[p + anchor:p + anchor + half] if side else b""
            if len(part) == half:
                h[i] = xxh3_64_intdigest(part) | 1
        ok = np.flatnonzero(h)
        order = ok[np.lexsort((h[ok], g[ok]))]
        same = (g[order][1:] == g[order][:-1]) & (h[order][1:] == h[order][:-1])
        keep[order[1:][same]] = True
        keep[order[:-1][same]] = True
    return keep


def _search(df: pd.DataFrame, length: int, anchor: int) -> pd.DataFrame:
    """Repeated strings among the pieces of a bucket, as byte ranges of documents."""
    df = df.drop_duplicates(["g", "d", "k", "start"])  # repeated rows
    blobs = [bytes(b) for b in df["blob"]]
    g = df["g"].to_numpy(np.int64)
    anchors = []
    for blob, x in zip(blobs, g.view(np.uint64)):
        h = _anchor_hashes(blob, anchor)
        anchors.append(int(np.flatnonzero(h == x)[0]))
    keep = np.flatnonzero(_partners(blobs, anchors, g, length, anchor))
    none = pd.DataFrame({c: pd.Series(dtype="int64") for c in ("d", "k", "start", "stop")})
    if not len(keep):
        return none
    sizes = np.array([len(blobs[i]) for i in keep])
    text = np.frombuffer(b"".join(blobs[i] for i in keep), np.uint8)
    end = np.repeat(np.cumsum(sizes), sizes)
    hit = matching_statistics(text, end - np.arange(len(text))) >= length
    begin = np.cumsum(sizes) - sizes
    string = np.repeat(np.arange(len(keep)), sizes)
    edge = np.flatnonzero(hit & np.append(True, ~hit[:-1] | (string[1:] != string[:-1])))
    last = np.flatnonzero(hit & np.append(~hit[1:] | (string[1:] != string[:-1]), True))
    which = string[edge]
    single = df["single"].to_numpy(bool)[keep][which]
    d, k, start = (df[c].to_numpy(np.int64)[keep][which] for c in ("d", "k", "start"))
    out = pd.DataFrame({"d": d, "k": k, "start": start + edge - begin[which], "stop": start + last - begin[which] + length})
    return out[single] if single.any() else none


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        n_bytes, removed, spans, digest = [], [], [], []
        for raw, marks in zip(b["text"], b["marks"]):
            raw, marks = raw.as_py(), marks.as_py() or ()
            keep, gone, runs, at = [], 0, 0, 0
            stop = -1
            for a, z in sorted((m["start"], m["stop"]) for m in marks):
                if a > stop:
                    runs += 1
                    keep.append(raw[at:a])
                    gone += z - a
                    stop = z
                elif z > stop:
                    gone += z - stop
                    stop = z
                at = stop
            keep.append(raw[at:])
            n_bytes.append(len(raw))
            removed.append(gone)
            spans.append(runs)
            digest.append(b"".join(keep))
        yield pa.RecordBatch.from_arrays(
            [b["doc_id"], pa.array(n_bytes, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()),
             pa.array(digest, pa.binary())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                   anchor: int = ANCHOR, bucket_bytes: int = BUCKET_BYTES,
                   group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept (the remaining bytes)."""
    if anchor % 8 or not 8 <= anchor <= length:
        raise ValueError("anchor: a multiple of 8, at most length")
    if 2 * length > 1 << _LEN_BITS:
        raise ValueError("length: at most 2048")
    text = F.coalesce(F.col(f"`{text_col}`").cast("binary"), F.lit(b""))
    # rows of one id and one content share what is found for them, so (d, k) may
    # stand for a row; unlike a row number it is the same whenever it is computed
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text.alias("text")).select(
        "*", F.coalesce("doc_id", F.lit(0)).alias("d"), F.xxhash64("text").alias("k"))
    pieces, folder = materialize_at(rows.select("d", "k", "text").mapInArrow(
        lambda it: _emit(it, length, anchor), "d long, k long, at long, g long, c long"), "repeats-pieces")

    # pieces that occur again, and minimizers with different pieces
    counted = pieces.select("g", "c").mapInArrow(_count, "g long, c long, n long")
    kinds = _kinds(counted)
    marked = materialize(pieces.join(kinds, ["g", "c"]), "repeats-marked")
    remove(docs.sparkSession, folder)
    size = (1 << _LEN_BITS) - 1
    start, stop = F.shiftright("at", _LEN_BITS), F.shiftright("at", _LEN_BITS) + F.col("at").bitwiseAND(size)
    whole = marked.filter("n > 1").select("d", "k", start.alias("start"), stop.alias("stop"))

    # one copy of each piece whose minimizer has others
    other = marked.filter("kinds > 1")
    one = F.min(F.struct("d", "k", "at")).alias("first")
    several = other.filter("n > 1").groupBy("g", "c", "kinds").agg(one).select(
        "g", "kinds", F.lit(False).alias("single"), "first.d", "first.k", "first.at")
    asked = other.filter("n = 1").select("g", "kinds", F.lit(True).alias("single"), "d", "k", "at").unionByName(several)
    by_doc = asked.groupBy("d", "k").agg(F.collect_list(F.struct("g", "kinds", "single", start.alias("start"),
                                                             stop.alias("stop"))).alias("asked"))
    found = rows.join(by_doc, ["d", "k"]).select("d", "k", "text", F.explode("asked").alias("p")).select(
        "d", "k", "p.g", "p.single", "p.kinds", "p.start",
        F.substring("text", (F.col("p.start") + 1).cast("int"), (F.col("p.stop") - F.col("p.start")).cast("int")).alias("blob"))
    total = asked.agg(F.sum(F.col("at").bitwiseAND(size))).first()[0] or 0
    buckets = max(1, -(-total // bucket_bytes))
    bucket = F.pmod(F.xxhash64("g"), F.lit(buckets))
    ranges = "d long, k long, start long, stop long"
    searched = found.filter(F.col("kinds") <= group_pieces).groupBy(bucket.alias("bucket")).applyInPandas(
        lambda df: _search(df, length, anchor), ranges)
    parts = [whole, searched]
    if not other.filter(F.col("kinds") > group_pieces).isEmpty():
        parts.append(_counted_one_by_one(found.filter(F.col("kinds") > group_pieces), length))
    marks = parts[0]
    for p in parts[1:]:
        marks = marks.unionByName(p)
    lists = marks.groupBy("d", "k").agg(F.collect_set(F.struct("start", "stop")).alias("marks"))
    cut = rows.join(lists, ["d", "k"], "left").select("doc_id", "text", "marks")
    return cut.mapInArrow(_cut_out, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def _counted_one_by_one(found: DataFrame, length: int) -> DataFrame:
    """Repeated strings of pieces under hot minimizers, by counting hashes."""

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for d, k, single, start, blob in zip(*(b[c].to_pylist() for c in ("d", "k", "single", "start", "blob"))):
                n = len(blob) - length + 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array([xxh3_128_digest(blob[i:i + length]) for i in range(n)], pa.binary()),
                     pa.array([d] * n, pa.int64()), pa.array([k] * n, pa.int64()),
                     pa.array(range(start, start + n), pa.int64()), pa.array([single] * n, pa.bool_())],
                    names=["h", "d", "k", "start", "single"])

    each = materialize(found.select("d", "k", "single", "start", "blob").mapInArrow(
        strings, "h binary, d long, k long, start long, single boolean"), "repeats-strings")
    again = each.distinct().groupBy("h").agg(F.count("*").alias("n")).filter("n > 1").select("h")
    return each.filter("single").join(again, "h").select("d", "k", "start", (F.col("start") + length).alias("stop"))


def digest(removed: DataFrame) -> DataFrame:
    """The result with the hash of what is kept in its place."""
    return removed.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))

