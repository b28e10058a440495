"""Document quality from a factorisation machine.

Inputs of a text: its distinct words as they stand, hashed, together of length
one; statistics of its structure and its declared length, each cut at quantiles
of the sample into one of ``BINS`` indicator features. With x the input,

    z = b + sum_i w_i x_i + 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2)

so all pairwise interactions of rank ``RANK`` cost one pass over the non-zero
inputs. It is fitted with Adam on a bounded sample of labelled rows.

Defined cases: null, empty and blank texts have zero statistics and no words; a
null metadata value has a bin of its own; very long texts are read whole;
repeated rows are scored alike; without labels of both kinds every score is the
label that is there (0.5 without labels); an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .labelled import Hasher, held_out, sample, sigmoid, unpack

BITS = 16
RANK = 6
BINS = 12
#: Most labelled rows a fit uses.
MAX_ROWS = 8_000
N_STATS = 13
_WORDS = 1 << BITS
_SIZE = _WORDS + (N_STATS + 1) * (BINS + 1)
_CLASSES = np.zeros(256, np.int64)
for _kind, _chars in enumerate(("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", ".,;:'\"?-()", "\n",
                                " \t\r\x0b\x0c"), 1):
    _CLASSES[[ord(c) for c in _chars]] = _kind
_CLASSES[128:] = 7


def structure(text: str, words: list[str], distinct: int) -> list[float]:
    """Statistics of how a text is built; all but the first three are shares."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    by_class = np.bincount(_CLASSES[raw], minlength=8) if len(raw) else np.zeros(8, np.int64)
    other, lower, upper, digit, plain, newline, _, wide = by_class.tolist()
    letters = max(1, lower + upper + wide)
    n = max(1, len(words))
    lines = text.split("\n")
    again = sum(map(str.__eq__, words, words[1:]))
    return [
        np.log1p(len(words)), len(raw) / n, n / len(lines),
        distinct / n, again / n, upper / letters, digit / max(1, len(raw)), plain / max(1, len(raw)),
        other / max(1, len(raw)), wide / letters, newline / max(1, len(raw)), len(set(lines)) / len(lines),
        float(text.count("|") > 0) + text.count("|") / n,
    ]


def _inputs(texts, metadata) -> tuple[list[np.ndarray], np.ndarray]:
    """Hashed distinct words, and statistics, of each text."""
    hasher, index, stats = Hasher(BITS), [], []
    for text, declared in zip(texts, metadata):
        text = text or ""
        words = text.split()
        distinct = set(words)
        index.append(np.unique(np.array(hasher(distinct), np.int32)))
        known = declared is not None and declared == declared  # noqa: PLR0124 - NaN
        stats.append([*structure(text, words, len(distinct)), np.log1p(max(0.0, float(declared))) if known else -1.0])
    return index, np.array(stats, float).reshape(-1, N_STATS + 1)


def _extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for df in batches:
        index, stats = _inputs(df["text"], df["size"])
        yield pd.DataFrame({"y": df["y"], "features": [i.astype(np.int32).tobytes() for i in index],
                            "stats": [s.tobytes() for s in stats]})


def _design(index: np.ndarray, starts: np.ndarray, stats: np.ndarray, cuts: list[np.ndarray]):
    """Non-zero inputs in row order: feature, value, first of each row."""
    n = len(starts)
    length = np.diff(np.append(starts, len(index)))
    binned = np.stack([np.searchsorted(c, stats[:, k], side="right") + _WORDS + k * (BINS + 1)
                       for k, c in enumerate(cuts)], axis=1) if n else np.empty((0, len(cuts)), np.int64)
    width = length + len(cuts)
    first = np.cumsum(width) - width
    feature = np.empty(int(width.sum()), np.int64)
    value = np.empty(len(feature), np.float32)
    word_at = np.arange(len(index)) + np.repeat(first - starts, length)
    feature[word_at] = index
    value[word_at] = np.repeat(1 / np.sqrt(np.maximum(1, length)), length)
    stat_at = (first + length)[:, None] + np.arange(len(cuts))
    feature[stat_at] = binned
    value[stat_at] = 1 / np.sqrt(len(cuts))
    return feature, value, first


def _sums(model: dict, feature: np.ndarray, value: np.ndarray, first: np.ndarray):
    """z of every row by the sum-of-squares identity, and the factor sums."""
    vx = model["v"][feature] * value[:, None]
    sums = np.add.reduceat(vx, first, axis=0)
    squares = np.add.reduceat((vx * vx).sum(axis=1), first)
    linear = np.add.reduceat(model["w"][feature] * value, first)
    return model["b"] + linear + 0.5 * ((sums * sums).sum(axis=1) - squares), sums, vx


def fit(rows: pd.DataFrame, steps_at_least: int = 900, batch: int = 64, rate: float = 0.02, l2: float = 1e-5) -> dict:
    y = rows["y"].to_numpy(np.float32)
    rng = np.random.default_rng(0)
    stats = np.stack([np.frombuffer(s) for s in rows["stats"]]) if len(rows) else np.empty((0, N_STATS + 1))
    cuts = [np.unique(np.quantile(stats[:, k], np.linspace(0, 1, BINS + 1)[1:-1])) if len(rows) else np.empty(0)
            for k in range(N_STATS + 1)]
    model = {"w": np.zeros(_SIZE, np.float32), "v": rng.normal(0, 0.05, (_SIZE, RANK)).astype(np.float32), "b": 0.0,
             "cuts": cuts}
    if len(y) == 0 or y.min() == y.max():
        model["v"][:] = 0
        model["b"] = 0.0 if len(y) == 0 else 30.0 * (2 * float(y[0]) - 1)
        return model
    share = float(y.mean())
    model["b"] = float(np.log(share / (1 - share)))
    index, starts = unpack(rows["features"])
    feature, value, first = _design(index, starts, stats, cuts)
    last = np.append(first[1:], len(feature))
    moments = {k: (np.zeros_like(model[k]), np.zeros_like(model[k])) for k in ("w", "v")}
    epochs = max(6, -(-steps_at_least * batch // len(y)))
    steps = 0
    for epoch in range(epochs):
        order = rng.permutation(len(y))
        for at in range(0, len(y), batch):
            chosen = order[at:at + batch]
            width = last[chosen] - first[chosen]
            begin = np.cumsum(width) - width
            take = np.arange(int(width.sum())) + np.repeat(first[chosen] - begin, width)
            f, x = feature[take], value[take]
            z, sums, vx = _sums(model, f, x, begin)
            error = (sigmoid(z) - y[chosen]).astype(np.float32) / len(chosen)
            per = np.repeat(error, width)
            used, place = np.unique(f, return_inverse=True)
            grad_w = np.bincount(place, weights=per * x, minlength=len(used)).astype(np.float32)
            push = (per * x)[:, None] * (np.repeat(sums, width, axis=0) - vx)
            grad_v = np.stack([np.bincount(place, weights=push[:, k], minlength=len(used)) for k in range(RANK)], 1)
            steps += 1
            step = rate * (1 - 0.8 * epoch / epochs) * np.sqrt(1 - 0.999 ** steps) / (1 - 0.9 ** steps)
            for name, grad in (("w", grad_w), ("v", grad_v.astype(np.float32))):
                weight, (m, s) = model[name], moments[name]
                grad = grad + l2 * weight[used]
                m[used] = 0.9 * m[used] + 0.1 * grad
                s[used] = 0.999 * s[used] + 0.001 * grad * grad
                weight[used] -= (step * m[used] / (np.sqrt(s[used]) + 1e-6)).astype(np.float32)
            model["b"] -= rate * 0.2 * float(error.sum())
    return model


def predict(model: dict, index: list[np.ndarray], stats: np.ndarray) -> np.ndarray:
    if not len(index):
        return np.empty(0)
    length = np.fromiter(map(len, index), np.int64, len(index))
    flat = np.concatenate(index) if length.sum() else np.empty(0, np.int64)
    feature, value, first = _design(flat, np.cumsum(length) - length, stats, model["cuts"])
    return sigmoid(_sums(model, feature, value, first)[0].astype(float))


def train(docs: DataFrame, labels: DataFrame, modulus: int = 5, remainder: int = 0, max_rows: int = MAX_ROWS) -> dict:
    rows = sample(docs, labels, "quality", held_out(F.col("label_id"), modulus, remainder), max_rows, _extract,
                  "y int, features binary, stats binary", [F.col("text").alias("text"), _size(docs).alias("size")])
    return fit(rows)


def _size(docs: DataFrame) -> Column:
    """The declared length, where the table has one."""
    return F.col("n_chars").cast("double") if "n_chars" in docs.columns else F.lit(None).cast("double")


def score(docs: DataFrame, model: dict, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with the quality of ``text_col`` in ``score_col``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # _SIZE * (RANK + 1) floats

    @F.pandas_udf(T.DoubleType())
    def of(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, sizes in batches:
            out = []
            for at in range(0, len(texts), 500):
                out.append(predict(shared.value, *_inputs(texts[at:at + 500], sizes[at:at + 500])))
            yield pd.Series(np.concatenate(out) if out else np.empty(0))

    return docs.withColumn(score_col, of(F.col(f"`{text_col}`"), _size(docs)))
