"""Importance resampling towards a target distribution, over hashed n-grams.

Documents are drawn without replacement by the likelihood ratio of their hashed
one-, two- and three-word features under a target and under the corpus itself, with
Gumbel noise from a hash of the id.

1. *Head.* The most frequent words of the corpus (exact counts over all texts; at most
   ``HEAD_WORDS``) and the most frequent pairs of the first ``PAIR_WORDS`` of them (at
   most ``HEAD_PAIRS``) are broadcast: each word with the state that CRC-32 is in after it, each pair
   with state and bucket. All three sizes are fixed and head words are at most
   ``HEAD_BYTES`` long, which bounds the broadcast.
2. *Tail.* A word or pair that is not in the head takes the CRC of its own bytes, a pair
   or triple by carrying on from the state of the words before it. Head and tail give
   the same numbers; the head only saves work.
3. *Bucket totals.* Each task adds up one counter a bucket, over all its features.
4. *Scores.* Gains by bucket (``buckets`` whole numbers) go to every task; a second
   pass over the texts adds them up.
5. *Draw.* Scores are counted in logarithmic bands (some 8,000 at most); rows below
   the band in which the draw ends are done. The others are range-partitioned by
   (score, id), numbered within a partition and shifted by the partitions before.

Texts are read as UTF-8 in pieces of ``PIECE`` bytes with two words carried over, so
that a text of any length takes bounded memory in a task.

Defined cases: null and empty texts have no features, weight 0 and are never drawn;
a null id hashes as the empty text and comes last among ties; repeated rows are drawn
one by one; with an empty corpus or target the other side's counts alone decide. Extra
columns of any name are allowed.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from itertools import repeat
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, whole_row

BUCKETS = 10_000
HEAD_WORDS = 1 << 15
PAIR_WORDS = 1 << 10
HEAD_PAIRS = 1 << 15
HEAD_BYTES = 64
PIECE = 1 << 20
MAX_COUNTED = 200_000
SCALE = 1000

_SLOTS = 1 << 17
#: A-Z to a-z; bytes outside [0-9A-Za-z\x80-\xFF] end a word.
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def word_lists(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, some ``PIECE`` bytes at a time."""
    start = 0
    while start < len(text):
        stop = start + PIECE
        plain = text[start:stop].translate(_LOWER)
        while stop < len(text) and plain[-1:] != b" ":  # up to the end of the last word
            more = text[stop:stop + 256].translate(_LOWER)
            gap = more.find(b" ")
            plain += more if gap < 0 else more[:gap + 1]
            stop += len(more) if gap < 0 else gap + 1
        if words := plain.split():
            yield words
        start = stop


# --- head vocabulary ------------------------------------------------------------------

@dataclass
class Head:
    """``ids``: word -> number, by frequency; ``states``: its CRC state; pairs of
    the first words sit in ``_SLOTS`` slots by (first * PAIR_WORDS + second)."""

    ids: dict[bytes, int]
    states: np.ndarray
    pair_keys: np.ndarray
    pair_states: np.ndarray
    pair_buckets: np.ndarray

    @classmethod
    def of(cls, words: list[bytes], pairs: list[tuple[int, int]], buckets: int) -> Head:
        keys = np.full(_SLOTS, -1, np.int64)
        states = np.zeros(_SLOTS, np.uint32)
        for a, b in reversed(pairs):  # of two pairs in one slot the more frequent stays
            slot = cls.slot(key := a * PAIR_WORDS + b)
            keys[slot], states[slot] = key, crc32(words[a] + b" " + words[b])
        of_words = np.array([*(crc32(w) for w in words), 0], np.uint32)  # the last one for words that are not in the head
        return cls({w: i for i, w in enumerate(words)}, of_words, keys, states, (states % buckets).astype(np.int32))

    @staticmethod
    def slot(key):
        return (key * 0x9E3779B1 >> 7) & (_SLOTS - 1)


def _counted(texts: DataFrame, emit: Callable[[Iterator[bytes]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from emit(t.as_py() for b in batches for t in b.column(0))

    return texts.mapInArrow(run, schema)


def _word_counts(texts: Iterator[bytes]) -> Iterator[pa.RecordBatch]:
    found: Counter = Counter()

    def out():
        return pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.binary()), pa.array(found.values(), pa.int64())],
                                          ["word", "n"])

    for text in texts:
        for words in word_lists(text):
            found.update(words)
            if len(found) > MAX_COUNTED:
                yield out()
                found.clear()
    yield out()


def _most(counts: DataFrame, key: str, limit: int) -> list:
    """Keys by falling count ``n``, ``limit`` of them at most: all that are counted more
    often than some number. That number comes from a histogram of the counts (exact up to
    4096, by 64ths of an octave above), so that no more than ``limit`` rows ever move."""
    total = materialize(counts.groupBy(key).agg(F.sum("n").alias("n")), "counts")
    band = F.when(F.col("n") < 4096, F.col("n")).otherwise(F.floor(F.log2("n") * 64) + 4096 - 12 * 64).cast("int")
    edge, taken = None, 0
    for r in sorted(total.groupBy(band.alias("band")).agg(F.count(F.lit(1)).alias("n")).collect(), reverse=True):
        if (taken := taken + r["n"]) > limit:
            break
        edge = r["band"]
    if edge is None:
        return []
    rows = total.filter(band >= edge).collect()
    return [r[key] for r in sorted(rows, key=lambda r: (-r["n"], r[key]))]


def head(texts: DataFrame, buckets: int) -> Head:
    """The frequent words and pairs of a table with one binary column."""
    counts = _counted(texts, _word_counts, "word binary, n long").filter(F.length("word") <= HEAD_BYTES)
    words = [bytes(w) for w in _most(counts, "word", HEAD_WORDS)]  # HEAD_WORDS * HEAD_BYTES at most
    first = {w: i for i, w in enumerate(words[:PAIR_WORDS])}

    def pair_counts(texts: Iterator[bytes]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(PAIR_WORDS * PAIR_WORDS, np.int64)
        get = first.get
        for text in texts:
            last = -1
            for words in word_lists(text):
                ids = np.array([last, *[get(w, -1) for w in words]], np.int64)
                last = int(ids[-1])
                a, b = ids[:-1], ids[1:]
                both = (a >= 0) & (b >= 0)
                np.add.at(seen, a[both] * PAIR_WORDS + b[both], 1)
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[at])], ["pair", "n"])

    pairs = _most(_counted(texts, pair_counts, "pair long, n long"), "pair", HEAD_PAIRS)
    return Head.of(words, [divmod(p, PAIR_WORDS) for p in pairs], buckets)


# --- features ---------------------------------------------------------------------------

def _direct(parts: Iterable[bytes], states: Iterable[int], n: int) -> np.ndarray:
    """CRC-32 of each part, carried on from the state before it."""
    return np.fromiter(map(crc32, parts, states), np.uint32, n)


def feature_buckets(text: bytes, known: Head, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """Number of new words and buckets of the features that end in them, piece by piece."""
    get = known.ids.get
    carried: list[bytes] = []
    for fresh in word_lists(text):
        words, c = carried + fresh, len(carried)
        ids = np.fromiter(map(get, words, repeat(-1)), np.int64, len(words))
        one = known.states[ids]
        tail = np.flatnonzero(ids < 0)
        one[tail] = _direct(map(words.__getitem__, tail.tolist()), repeat(0), len(tail))
        spaced = list(map(b" ".__add__, words))
        a, b = ids[:-1], ids[1:]
        key = a * PAIR_WORDS + b
        slot = Head.slot(key)
        hit = (a >= 0) & (b >= 0) & (a < PAIR_WORDS) & (b < PAIR_WORDS) & (known.pair_keys[slot] == key)
        two, bucket = known.pair_states[slot], known.pair_buckets[slot]
        miss = np.flatnonzero(~hit)
        two[miss] = _direct(map(spaced.__getitem__, (miss + 1).tolist()), one[miss].tolist(), len(miss))
        bucket[miss] = two[miss] % buckets
        three = _direct(spaced[2:], two.tolist(), max(len(words) - 2, 0))
        yield len(fresh), np.concatenate([one[c:] % buckets, bucket[max(c - 1, 0):], three[max(c - 2, 0):] % buckets])
        carried = words[-2:]


def bucket_totals(texts: DataFrame, known: Head, buckets: int) -> np.ndarray:
    """Features of all texts by bucket (``buckets`` numbers on the driver)."""
    shared = texts.sparkSession.sparkContext.broadcast(known)

    def totals(texts: Iterator[bytes]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for text in texts:
            for _, found in feature_buckets(text, shared.value, buckets):
                np.add.at(total, found, 1)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for r in _counted(texts, totals, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Log likelihood ratio by bucket, add-one smoothed, in thousandths rounded down."""
    k, s_all, t_all = len(corpus), int(corpus.sum()), int(target.sum())
    return np.array([math.floor(SCALE * math.log((t + 1.0) * (s_all + k) / ((s + 1.0) * (t_all + k))))
                     for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


@dataclass
class Model:
    head: Head
    gains: np.ndarray


def _texts(df: DataFrame, text_col: str) -> DataFrame:
    return df.select(F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary").alias("t"))


def fit(docs: DataFrame, target: DataFrame, text_col: str = "text", target_col: str = "text", buckets: int = BUCKETS) -> Model:
    corpus = _texts(docs, text_col)
    known = head(corpus, buckets)
    return Model(known, bucket_gains(bucket_totals(corpus, known, buckets),
                                     bucket_totals(_texts(target, target_col), known, buckets)))


def weighed(text: Column, model: Model, df: DataFrame) -> Column:
    """Struct of n_words, n_features and weight of each text."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("n_words long, n_features long, weight long")
    def weigh(texts: pd.Series) -> pd.DataFrame:
        m = shared.value
        rows = []
        for text in texts:
            n = features = weight = 0
            for fresh, found in feature_buckets(text, m.head, len(m.gains)):
                n += fresh
                features += len(found)
                weight += int(m.gains[found].sum())
            rows.append((n, features, weight))
        return pd.DataFrame(rows, columns=["n_words", "n_features", "weight"], dtype=np.int64)

    return weigh(F.coalesce(text, F.lit("")).cast("binary"))


# --- draw ---------------------------------------------------------------------------------

def noise(doc_id: Column, seed: int = 42) -> Column:
    """Gumbel noise in thousandths, from a hash of seed and id."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("long")
    return F.floor(-SCALE * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def _band(score: Column) -> Column:
    return (F.signum(score) * F.floor(64 * F.log2(1.0 + F.abs(score)))).cast("int")


def _ranked(scored: DataFrame, may: Column, share: tuple[int, int]) -> DataFrame:
    """Adds ``rank`` to the rows of the written table ``scored`` (score, doc_id, uid)."""
    bands = scored.filter(may).groupBy(_band(F.col("score")).alias("band")).agg(F.count(F.lit(1)).alias("n"))
    counts = sorted(((r["band"], r["n"]) for r in bands.collect()), reverse=True)  # bounded by the bands
    drawn = share[0] * sum(n for _, n in counts) // share[1]
    edge, above = None, 0
    for band, n in counts:
        if above >= drawn:
            break
        edge, above = band, above + n
    near = F.lit(False) if edge is None else F.coalesce(may & (_band(F.col("score")) >= edge), F.lit(False))
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("uid")]
    part = materialize(scored.filter(near).repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "draw")
    upto = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ahead = part.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select(  # one row a partition
        "part", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("ahead"))
    place = F.row_number().over(Window.partitionBy("part").orderBy(*order)) + F.col("ahead")
    ranked = part.join(ahead, "part").withColumn("rank", place.cast("long")).drop("part", "ahead")
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    return ranked.unionByName(scored.filter(~near).withColumn("rank", F.lit(None).cast("long")))


def _scored(docs: DataFrame, carry: list[Column], model: Model, id_col: str, text_col: str, seed: int) -> DataFrame:
    rows = docs.select(*carry, F.col(f"`{id_col}`").alias("doc_id"), weighed(F.col(f"`{text_col}`"), model, docs).alias("m"))
    rows = rows.select("*", "m.n_words", "m.n_features", "m.weight").drop("m")
    return materialize(rows.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
                       .withColumn("uid", F.monotonically_increasing_id()), "importance")


def importance(docs: DataFrame, target: DataFrame, share: tuple[int, int] = (5, 100), min_words: int = 20, seed: int = 42,
               id_col: str = "doc_id", text_col: str = "text", target_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_features, weight, score, rank (null: not drawn). The draw
    takes ``share`` (a fraction, rounded down) of the rows with ``min_words`` words."""
    scored = _scored(docs, [], fit(docs, target, text_col, target_col), id_col, text_col, seed)
    return _ranked(scored, F.col("n_words") >= min_words, share).select("doc_id", "n_features", "weight", "score", "rank")


def resample(docs: DataFrame, target: DataFrame, share: tuple[int, int] = (5, 100), min_words: int = 20, seed: int = 42,
             id_col: str = "doc_id", text_col: str = "text", target_col: str = "text") -> DataFrame:
    """The drawn rows of ``docs``, with all their columns."""
    carry = [whole_row(docs).alias("row")]
    scored = _scored(docs, carry, fit(docs, target, text_col, target_col), id_col, text_col, seed)
    return _ranked(scored, F.col("n_words") >= min_words, share).filter(F.col("rank").isNotNull()).select("row.*")
