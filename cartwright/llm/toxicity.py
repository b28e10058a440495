"""Toxicity scores from a counterfactual-regularised linear classifier.

Features are the distinct lower-cased words of a text and their leading
``PREFIXES`` characters, hashed. The classifier is a logistic regression with an
L1 term, fitted by accelerated proximal gradient steps on a bounded sample, then
refitted on the features it selected. Every sampled text has counterfactuals: the
same text with an identity term swapped for the others of its group. A text that names
no group is given a term, chosen by a hash of the text and so without regard to its
label (the classifier reads a text as a set of words, which leaves no place for the
term to fit or not). The squared change of the score over these pairs is part of what is
minimised, so that naming a group moves a score no more than naming another one, nor
than naming none (the pair "term left out").

Defined cases: null and empty texts get the score of a text without features;
very long texts are read whole; repeated rows are scored alike; without any usable
label every score is the neutral prior 0; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .labelled import Hasher, held_out, sample, sigmoid, unpack

BITS = 18
PREFIXES = (4, 5, 6)
#: Most labelled rows a fit uses.
MAX_ROWS = 8_000
PUNCTUATION = "".join(map(chr, range(33, 48))) + ":;<=>?@[\\]^_`{|}~«»“”„’…¿¡"
#: Terms naming a group of people; those of a tuple stand for one another.
IDENTITY_TERMS: tuple[tuple[str, ...], ...] = (
    ("women", "men", "girls", "boys", "transgender", "nonbinary"),
    ("woman", "man", "girl", "boy"),
    ("female", "male"),
    ("gay", "lesbian", "bisexual", "queer", "straight", "heterosexual", "homosexual"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "sikh", "catholic", "protestant", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "sikhs", "catholics", "protestants", "atheists"),
    ("black", "white", "asian", "latino", "hispanic", "african", "european", "arab", "indigenous"),
    ("immigrants", "refugees", "migrants", "foreigners", "natives", "citizens"),
    ("deaf", "blind", "disabled", "autistic"),
    ("old", "young", "elderly", "teenage"),
    ("frauen", "männer"), ("femmes", "hommes"), ("mujeres", "hombres"),
    ("muslime", "christen", "juden"), ("musulmans", "chrétiens", "juifs"), ("musulmanes", "cristianos", "judíos"),
)


def words_of(text: str | None) -> set[str]:
    """Distinct words: lower case, without punctuation at either end."""
    return {w for raw in set((text or "").lower().split()) if (w := raw.strip(PUNCTUATION))}


def features_of(word: str) -> list[str]:
    return [word, *(f"{n}|{word[:n]}" for n in PREFIXES if len(word) >= n)]


def _swaps() -> dict[str, list[str | None]]:
    """Identity term -> what it is swapped for (None: left out)."""
    out: dict[str, list[str | None]] = {}
    for group in IDENTITY_TERMS:
        for term in group:
            out.setdefault(term, [None]).extend(t for t in group if t != term)
    return out


def _extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    hasher, swaps = Hasher(BITS), _swaps()
    names = sorted(swaps)
    for df in batches:
        features, terms = [], []
        for text in df["text"]:
            words = words_of(text)
            if words and words.isdisjoint(swaps):
                words.add(names[crc32(text.encode("utf-8", "surrogatepass")) % len(names)])
            found = {i for w in words for i in hasher(features_of(w))}
            features.append(np.array(sorted(found), np.int32).tobytes())
            terms.append("\n".join(sorted(w for w in words if w in swaps)))
        yield pd.DataFrame({"y": df["y"], "features": features, "terms": terms})


def _pairs(terms: list[str], hasher: Hasher) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counterfactual pairs as sparse differences: (pair, feature, +1 or -1)."""
    swaps = _swaps()
    at, feature, sign, n = [], [], [], 0
    for row in terms:
        for term in filter(None, row.split("\n")):
            for other in swaps[term]:
                for word, s in ((term, 1.0), (other, -1.0)):
                    if word is not None:
                        ids = hasher(features_of(word))
                        at += [n] * len(ids)
                        feature += ids
                        sign += [s] * len(ids)
                n += 1
    return np.array(at, np.int64), np.array(feature, np.int64), np.array(sign)


def fit(rows: pd.DataFrame, l1: float = 0.03, ridge: float = 1e-5, fairness: float = 1.0,
        steps: int = 100) -> tuple[np.ndarray, float]:
    """Weights by hashed feature, and the bias. The L1 term falls with the root
    of the number of rows, as the noise of a gradient does."""
    size = 1 << BITS
    y = rows["y"].to_numpy(float)
    if len(y) == 0 or y.min() == y.max():
        return np.zeros(size, np.float32), -30.0 if len(y) == 0 or y.max() == 0 else 30.0
    index, starts = unpack(rows["features"])
    length = np.diff(np.append(starts, len(index)))
    row = np.repeat(np.arange(len(y), dtype=np.int32), length)
    pair, feature, sign = _pairs(rows["terms"].tolist(), Hasher(BITS))
    n_pairs = int(pair[-1]) + 1 if len(pair) else 1
    # rare features carry nothing that transfers; the rest are renumbered
    seen = np.bincount(index, minlength=size)
    active = np.flatnonzero(seen >= 3)
    common = seen[index] >= 3
    index, row = index[common], row[common]
    del common
    weights = np.zeros(size, np.float32)
    bias = 0.0
    share = y.mean()
    for penalty in (l1 / np.sqrt(len(y)), 0.0):
        new = np.full(size, -1, np.int32)
        new[active] = np.arange(len(active))
        c, r = new[index], row
        if (c < 0).any():
            c, r = c[c >= 0], r[c >= 0]
        pc, pon = new[feature], new[feature] >= 0
        f, p, s = pc[pon], pair[pon], sign[pon]
        scale = 1 / np.sqrt(seen[active] / len(y) + 1e-3)  # rare features are as easy to move as common ones
        w, z, b, zb, t = np.zeros(len(active)), np.zeros(len(active)), np.log(share / (1 - share)), 0.0, 1.0
        zb = b
        scale /= np.sqrt(max(1.0, len(r) / len(y)))
        value, scaled = scale[c].astype(np.float32), s * scale[f]

        def unfair(x: np.ndarray) -> np.ndarray | float:
            """Gradient of the mean squared change of the score over the pairs."""
            if not len(f):
                return 0.0
            change = np.bincount(p, weights=x[f] * scaled, minlength=n_pairs)
            return 2 * fairness * np.bincount(f, weights=change[p] * scaled, minlength=len(active)) / n_pairs

        rate = 1 / (1.3 * _curvature(lambda x: unfair(x) + ridge * x + 0.25 * np.bincount(
            c, weights=np.bincount(r, weights=x[c] * value, minlength=len(y))[r] * value, minlength=len(x)) / len(y),
            len(active)))
        for _ in range(steps):
            error = sigmoid(np.bincount(r, weights=z[c] * value, minlength=len(y)) + zb) - y
            grad = np.bincount(c, weights=error[r] * value, minlength=len(active)) / len(y) + ridge * z + unfair(z)
            step = z - rate * grad
            new_w = np.sign(step) * np.maximum(0, np.abs(step) - rate * penalty)
            new_b = zb - error.mean()
            t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
            z, zb = new_w + (t - 1) / t2 * (new_w - w), new_b + (t - 1) / t2 * (new_b - b)
            w, b, t = new_w, new_b, t2
        weights[:] = 0
        weights[active] = w * scale
        bias = float(b)
        if penalty:
            active = active[w != 0]
            if not len(active):
                return weights, bias
    return _calibrated(weights, bias, np.bincount(row, weights=weights[index], minlength=len(y)) + bias, y)


def _curvature(hessian: Callable[[np.ndarray], np.ndarray], n: int, rounds: int = 12) -> float:
    """Largest eigenvalue, by power iteration."""
    x = np.random.default_rng(0).random(n) + 0.1
    size = 1.0
    for _ in range(rounds):
        x = hessian(x / np.linalg.norm(x))
        size = float(np.linalg.norm(x))
    return max(size, 1e-6)


def _calibrated(weights: np.ndarray, bias: float, z: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Platt scaling: the two numbers that turn sums into probabilities."""
    positive = y.sum()
    goal = np.where(y == 1, (positive + 1) / (positive + 2), 1 / (len(y) - positive + 2))
    x = np.stack((z, np.ones_like(z)), axis=1)
    at = np.array([1.0, 0.0])
    for _ in range(30):
        p = sigmoid(x @ at)
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        at -= np.linalg.solve(hessian, x.T @ (p - goal)).clip(-1, 1)
    slope = float(np.clip(at[0], 0.5, 4))
    return weights * np.float32(slope), bias * slope + float(at[1])


def train(docs: DataFrame, labels: DataFrame, modulus: int = 3, remainder: int = 1,
          max_rows: int = MAX_ROWS) -> tuple[np.ndarray, float]:
    rows = sample(docs, labels, "toxic", held_out(F.col("label_id"), modulus, remainder), max_rows, _extract,
                  "y int, features binary, terms string", [F.col("text").alias("text")])
    return fit(rows)


def score(docs: DataFrame, model: tuple[np.ndarray, float], text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with the toxicity of ``text_col`` in ``score_col``."""
    weights = docs.sparkSession.sparkContext.broadcast(model)  # 2**BITS floats

    @F.pandas_udf(T.DoubleType())
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        table, bias = weights.value
        hasher = Hasher(BITS)
        known: dict[str, tuple[int, ...]] = {}
        for texts in batches:
            z = np.full(len(texts), bias)
            for i, text in enumerate(texts):
                hit: set[int] = set()
                if len(known) > 300_000:
                    known.clear()
                for raw in set((text or "").lower().split()):
                    ids = known.get(raw)
                    if ids is None:
                        word = raw.strip(PUNCTUATION)
                        ids = known[raw] = tuple(x for x in hasher(features_of(word)) if table[x]) if word else ()
                    if ids:
                        hit.update(ids)
                if hit:
                    z[i] += table[sorted(hit)].sum(dtype=np.float64)
            yield pd.Series(sigmoid(z))

    return docs.withColumn(score_col, of(F.col(f"`{text_col}`")))
