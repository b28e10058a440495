"""Quality rules with robust multivariate outliers.

1. *Statistics.* Every whole text is measured once: words, code points in words,
   symbols, repeated lines, words inside repeated five-word windows. The base rules
   are thresholds on these counts.
2. *Vectors.* What passes the base rules becomes a vector of transformed statistics:
   logarithms of the number of words and of their mean length, square roots of the
   symbol, line and window rates. Components are whole multiples of 1/``UNITS``, so
   that sums over any number of rows are exact and do not depend on their order.
3. *Minimum covariance determinant* by (language, source), deterministic starts
   (all rows; medians and absolute deviations). A concentration step measures the
   squared Mahalanobis distance of every row under the present estimate, adds up
   moments by (group, start, logarithmic distance bin) and takes the nearest bins
   until ``SHARE`` of the group's rows is in; the bin at the boundary counts in
   part. The start with the least determinant wins, and is reweighted once.
   The scatter is regularised by fixed smallest deviations ``LEAST``: most texts hold
   no symbol and repeat no line, which would make the plain determinant zero.
4. *Verdict.* A row is rejected beyond the chi-square quantile ``CUT``.

Every step reads all rows. A step's shuffle holds at most one row per (group, start,
bin) and task, so a group with a third of all rows is added up like any other; the
estimates, one row per group and start, are a table and never come to the driver.
Groups of fewer than ``MIN_ROWS`` rows share one estimate.

Defined cases: null and empty texts have no words and fail the base rules; a null
language or source is a value of its own; repeated rows count as often as they
occur and get the same verdict; an empty table gives an empty result. Extra columns
of any name are allowed and kept by :func:`passing`.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SYMBOLS = b"#*$%&|<>"
WINDOW = 5

DIMS = 5
UNITS = 512
#: Smallest standard deviations, in the components' own scale.
LEAST = (0.5, 0.1, 0.03, 0.1, 0.2)
SHARE = 0.75
COARSE = 8
REWEIGHT = 0.975
CUT = 0.9999
MIN_ROWS = 50
MAX_STEPS = 60
#: Concentration ends when no group's log determinant moves by more.
STILL = 1e-3
BINS_PER_OCTAVE = 16
POOL = "*"

_PAIRS = [(i, j) for i in range(DIMS) for j in range(i + 1)]
_SPACE = b" \t\n\v\f\r"
_FOLLOWING = bytes(range(0x80, 0xC0))  # UTF-8 bytes that begin no code point


# --- statistics -----------------------------------------------------------------

def repeated_words(words: list, window: int = WINDOW) -> int:
    """Words inside windows of ``window`` words that occur twice or more."""
    n = len(words)
    if n <= window:
        return 0
    known: dict = {}
    ids = np.array([known.setdefault(w, len(known)) for w in words], np.int64)
    kinds = len(known)
    if kinds == n:
        return 0
    code, base = ids, kinds  # code[i] names the words from i on, as many as are joined so far
    for k in range(1, window):
        if base * kinds >= 1 << 62:
            code = np.unique(code, return_inverse=True)[1]
            base = int(code.max()) + 1
        code = code[:-1] * kinds + ids[k:]
        base *= kinds
    order = np.argsort(code, kind="stable")
    ranked = code[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    twice = np.zeros(len(ranked), bool)
    twice[1:] |= same
    twice[:-1] |= same
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, order[twice], 1)
    np.add.at(edge, order[twice] + window, -1)
    return int(np.count_nonzero(np.cumsum(edge)))


def _without(text: bytes, chars: bytes) -> int:
    return len(text) - len(text.translate(None, chars))


def measure(text: bytes) -> tuple[int, ...]:
    """The five counts of one text (UTF-8)."""
    words = text.split()  # bytes split at the six ASCII white-space characters only
    points = len(text) - _without(text, _FOLLOWING)
    lines = [line for line in text.split(b"\n") if line.strip()]
    return (len(words), points - _without(text, _SPACE), _without(text, SYMBOLS), len(lines) - len(set(lines)),
            repeated_words(words))


def statistics(text: Column) -> Column:
    """The five counts as a struct; null counts as empty."""
    @F.pandas_udf(", ".join(f"{c} long" for c in COUNTS))
    def counted(texts: pd.Series) -> pd.DataFrame:
        rows = [measure(t or b"") for t in texts]
        return pd.DataFrame(np.array(rows, np.int64).reshape(-1, len(COUNTS)), columns=list(COUNTS))

    return counted(F.coalesce(text, F.lit("")).cast("binary"))


def base_failed(m: Column) -> Column:
    """Too few words, or more than a fifth of them in repeated windows."""
    return (m["n_words"] < 10) | (100 * m["n_repeat_words"] > 20 * m["n_words"])


def vector(m: Column) -> list[Column]:
    """Transformed statistics, as whole multiples of 1/UNITS."""
    words = F.greatest(m["n_words"], F.lit(1)).cast("double")
    chars = F.greatest(m["word_chars"], F.lit(1)).cast("double")
    parts = [F.log(words), F.log(chars / words), F.sqrt(m["n_symbols"] / chars), F.sqrt(m["n_dup_lines"] / words),
             F.sqrt(m["n_repeat_words"] / words)]
    return [F.round(p * UNITS).cast("long").alias(f"x{i}") for i, p in enumerate(parts)]


# --- chi-square ------------------------------------------------------------------

def chi2_cdf(x: float, df: int) -> float:
    a, z = df / 2, x / 2
    term = total = 1 / a
    k = a
    while term > total * 1e-17:
        k += 1
        term *= z / k
        total += term
    return total * math.exp(a * math.log(z) - z - math.lgamma(a)) if z > 0 else 0.0


def chi2_quantile(p: float, df: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_cdf(mid, df) < p else (low, mid)
    return high


def consistency(share: float) -> float:
    """What the scatter of the nearest ``share`` of normal vectors is multiplied by."""
    return share / chi2_cdf(chi2_quantile(share, DIMS), DIMS + 2)


# --- estimates ---------------------------------------------------------------------

_MOMENTS = ["n", *[f"s{i}" for i in range(DIMS)], *[f"q{i}{j}" for i, j in _PAIRS]]
_ESTIMATE = "key string, start int, mean array<double>, whiten array<double>, logdet double"


def _sums() -> list[Column]:
    return [F.count(F.lit(1)).alias("n"), *[F.sum(f"x{i}").alias(f"s{i}") for i in range(DIMS)],
            *[F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"q{i}{j}") for i, j in _PAIRS]]


def estimate(n: float, sums: np.ndarray, products: np.ndarray, factor: float) -> tuple[list, list, float]:
    """Moments -> mean, whitening matrix (lower triangle by rows), log determinant."""
    mean = sums / n
    scatter = np.zeros((DIMS, DIMS))
    for k, (i, j) in enumerate(_PAIRS):
        scatter[i, j] = scatter[j, i] = products[k] / n - mean[i] * mean[j]
    scatter = factor * scatter + np.diag((np.array(LEAST) * UNITS) ** 2)
    lower = np.linalg.cholesky(scatter)
    whiten = np.linalg.inv(lower)
    return mean.tolist(), [float(whiten[i, j]) for i, j in _PAIRS], float(2 * np.log(np.diag(lower)).sum())


def _estimates(factor: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in batches:
            out = []
            for r in df.itertuples(index=False):
                m = [float(getattr(r, c)) for c in _MOMENTS]
                out.append((r.key, int(r.start), *estimate(m[0], np.array(m[1:1 + DIMS]), np.array(m[1 + DIMS:]), factor)))
            yield pd.DataFrame(out, columns=["key", "start", "mean", "whiten", "logdet"])

    return run


def distance() -> Column:
    """Squared Mahalanobis distance of x0.. under the row's ``mean`` and ``whiten``."""
    gap = [F.col(f"x{i}") - F.col("mean")[i] for i in range(DIMS)]
    total = F.lit(0.0)
    for i in range(DIMS):
        part = F.lit(0.0)
        for k, (row, j) in enumerate(_PAIRS):
            if row == i:
                part = part + F.col("whiten")[k] * gap[j]
        total = total + part * part
    return total


def _bin(d2: Column) -> Column:
    return F.floor(F.log2(F.greatest(d2, F.lit(2.0 ** -20))) * BINS_PER_OCTAVE).cast("int")


def _concentrate(rows: DataFrame, estimates: DataFrame, sizes: DataFrame) -> DataFrame:
    """One concentration step: moments of the nearest ``h`` rows by (key, start)."""
    near = rows.join(estimates, "key").withColumn("bin", _bin(distance()))
    by_bin = near.groupBy("key", "start", "bin").agg(*_sums())
    run = Window.partitionBy("key", "start").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    ahead = by_bin.withColumn("ahead", F.coalesce(F.sum("n").over(run), F.lit(0))).join(sizes, "key")
    whole, part = F.col("ahead") + F.col("n") <= F.col("h"), F.col("ahead") < F.col("h")
    # all whole bins are exact sums of integers; one bin at most counts in part
    share = (F.col("h") - F.col("ahead")) / F.col("n")
    return ahead.groupBy("key", "start").agg(*[
        (F.coalesce(F.sum(F.when(whole, F.col(c))), F.lit(0)).cast("double")
         + F.coalesce(F.max(F.when(~whole & part, F.struct(F.lit(1), (F.col(c) * share).alias("v"))))["v"], F.lit(0.0)))
        .alias(c) for c in _MOMENTS])


def _medians(rows: DataFrame) -> DataFrame:
    """(key, dim, med, mad) from counts by value, in steps of ``COARSE``: a start needs no
    more. A component has about a thousand such values at most, so the counts are bounded
    by group, whatever the rows."""
    coarse = lambda c: F.floor(F.col(c) / COARSE) * COARSE
    values = F.inline(F.array(*[F.struct(F.lit(i).alias("dim"), coarse(f"x{i}").alias("v")) for i in range(DIMS)]))
    counts = rows.select("key", values).groupBy("key", "dim", "v").agg(F.count(F.lit(1)).alias("n"))
    counts = materialize(counts, "mcd-values")

    def middle(table: DataFrame, value: str, out: str) -> DataFrame:
        group = Window.partitionBy("key", "dim")
        upto = F.sum("n").over(group.orderBy(value).rangeBetween(Window.unboundedPreceding, 0))
        ranked = table.withColumn("upto", upto).withColumn("all", F.sum("n").over(group))
        return ranked.filter(F.col("upto") * 2 >= F.col("all")).groupBy("key", "dim").agg(F.min(value).alias(out))

    centre = middle(counts, "v", "med")
    away = counts.join(centre, ["key", "dim"]).withColumn("away", F.abs(F.col("v") - F.col("med")))
    return centre.join(middle(away, "away", "mad"), ["key", "dim"])


def _starts(rows: DataFrame) -> DataFrame:
    """Start 0: all rows; start 1: medians and absolute deviations, no covariance."""
    every = rows.groupBy("key").agg(*_sums()).withColumn("start", F.lit(0))
    by_dim = _medians(rows).groupBy("key").pivot("dim", list(range(DIMS))).agg(
        F.struct(F.first("med").alias("med"), F.first("mad").alias("mad")))
    centre = [F.col(str(i))["med"].cast("double") for i in range(DIMS)]
    spread = [F.col(str(i))["mad"] * 1.4826 for i in range(DIMS)]
    square = {(i, j): centre[i] * centre[j] + (spread[i] * spread[i] if i == j else F.lit(0.0)) for i, j in _PAIRS}
    robust = by_dim.select("key", F.lit(1).alias("start"), F.lit(1.0).alias("n"),
                           *[c.alias(f"s{i}") for i, c in enumerate(centre)],
                           *[square[i, j].alias(f"q{i}{j}") for i, j in _PAIRS])
    cols = ["key", "start", *[F.col(c).cast("double").alias(c) for c in _MOMENTS]]
    return every.select(*cols).unionByName(robust.select(*cols)).mapInPandas(_estimates(1.0), _ESTIMATE)


@dataclass
class Model:
    """``estimates``: one row per group (key, mean, whiten); ``keys``: the estimate
    that each (language, source) key uses."""

    estimates: DataFrame
    keys: DataFrame


def group_key(lang: Column, source: Column) -> Column:
    """One text per (language, source), nulls told apart from any value."""
    return F.to_json(F.struct(lang.alias("l"), source.alias("s")))


def fit(measured: DataFrame) -> Model:
    """The estimates of every group. ``measured``: rows of (key, x0..) that passed
    the base rules, written, since each step reads them again."""
    sizes = measured.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    keys = materialize(sizes.select("key", F.when(F.col("n") < MIN_ROWS, POOL).otherwise(F.col("key")).alias("used")),
                       "mcd-keys")
    rows = measured.join(keys, "key").select(F.col("used").alias("key"), *[f"x{i}" for i in range(DIMS)])
    need = F.ceil(F.col("n") * SHARE).cast("long")
    sizes = materialize(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).select("key", need.alias("h")), "mcd-sizes")
    now = materialize(_starts(rows), "mcd-estimates")
    factor = consistency(SHARE)
    for _ in range(MAX_STEPS):
        step = _concentrate(rows, now.select("key", "start", "mean", "whiten"), sizes)
        new = materialize(step.mapInPandas(_estimates(factor), _ESTIMATE), "mcd-estimates")
        moved = new.select("key", "start", F.col("logdet").alias("to")).join(now, ["key", "start"])
        now = new
        if moved.filter(F.abs(F.col("to") - F.col("logdet")) > STILL).isEmpty():
            break
    best = now.groupBy("key").agg(F.min_by(F.struct("mean", "whiten"), F.struct("logdet", "start")).alias("b"))
    best = best.select("key", "b.mean", "b.whiten")
    inner = rows.join(best, "key").filter(distance() <= chi2_quantile(REWEIGHT, DIMS))
    again = inner.groupBy("key").agg(*_sums()).withColumn("start", F.lit(0))
    final = materialize(again.mapInPandas(_estimates(consistency(REWEIGHT)), _ESTIMATE), "mcd-final")
    return Model(final.select("key", "mean", "whiten"), keys)


def _measured(docs: DataFrame, carry: list[Column], text_col: str, lang_col: str, source_col: str) -> DataFrame:
    m = docs.select(*carry, group_key(F.col(f"`{lang_col}`"), F.col(f"`{source_col}`")).alias("key"),
                    statistics(F.col(f"`{text_col}`")).alias("m"))
    return m.select("*", base_failed(F.col("m")).alias("base_failed"), *vector(F.col("m")))


def _judged(measured: DataFrame, model: Model) -> DataFrame:
    """Adds ``kept``. A group of which nothing passed the base rules has no estimate
    and nothing to judge."""
    known = model.keys.join(model.estimates.withColumnRenamed("key", "used"), "used").select("key", "mean", "whiten")
    near = F.coalesce(distance() <= chi2_quantile(CUT, DIMS), F.lit(True))
    return measured.join(known, "key", "left").withColumn("kept", ~F.col("base_failed") & near)


def verdicts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             source_col: str = "source") -> DataFrame:
    """Per row: doc_id, the five counts, base_failed, kept."""
    rows = materialize(_measured(docs, [F.col(f"`{id_col}`").alias("doc_id")], text_col, lang_col, source_col), "rules")
    model = fit(rows.filter(~F.col("base_failed")).select("key", *[f"x{i}" for i in range(DIMS)]))
    return _judged(rows, model).select("doc_id", "m.*", "base_failed", "kept")


def passing(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = materialize(_measured(docs, [whole], text_col, lang_col, source_col), "rules")
    model = fit(rows.filter(~F.col("base_failed")).select("key", *[f"x{i}" for i in range(DIMS)]))
    return _judged(rows, model).filter("kept").select("row.*")
