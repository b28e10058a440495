"""Scalar helpers: labels, rounding, CASE mappings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cartwright import fixed


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def wave_label(wave: str | Column | int) -> Column:
    """Zero-padded wave label (``7 -> '007'``; wider numbers are not cut)."""
    w = F.lit(wave) if isinstance(wave, int) else _c(wave)
    return F.format_string(fixed.WAVE_LABEL_FORMAT, w)


def utc_date_label(ts: str | Column) -> Column:
    """``yyyy-MM-dd`` partition label; the session time zone is UTC."""
    return F.date_format(_c(ts), "yyyy-MM-dd")


def exact_round_ratio(num: Column, den: Column, digits: int) -> Column:
    """``round(num / den, digits)`` half-up, computed exactly on integers:
    ``(2 * 10^n * num + den) div (2 * den) / 10^n`` (num >= 0). NULL when
    ``den`` is 0 or NULL.

    The source divides integers in decimal arithmetic and rounds half-up;
    rounding a double average instead can split a tie (1/160 = 0.00625)
    differently per engine. Integer parts stay exact below 2^53.
    """
    scale = 10 ** digits
    a = num.cast("long") * (2 * scale) + den.cast("long")
    b = F.nullif(den.cast("long"), F.lit(0)) * 2
    q = ((a - F.pmod(a, b)) / b).cast("long")
    return q / F.lit(float(scale))


def round_avg(c: str | Column, digits: int) -> Column:
    """``round(avg(x), n)`` of an integer column, exact half-up
    (NULLs ignored, as ``avg`` does; NULL for no values)."""
    col = _c(c)
    total = F.sum(col)
    whole = F.when(total != F.floor(total), F.raise_error(F.lit("round_avg: values that are not whole numbers")))
    return exact_round_ratio(F.coalesce(whole, total), F.count(col), digits)


def ratio_or_null(num: Column, den: Column, digits: int) -> Column:
    """``round(num / nullif(den, 0), n)`` of integer sums, exact half-up;
    a zero denominator gives NULL."""
    return exact_round_ratio(num, den, digits)


def day_name(dow: str | Column) -> Column:
    """C11: simple CASE over 0..6; anything else is NULL."""
    d = _c(dow)
    expr = None
    for i, name in enumerate(fixed.DAY_NAMES):
        expr = F.when(d == i, name) if expr is None else expr.when(d == i, name)
    return expr


def is_weekend(dow: str | Column) -> Column:
    """C10."""
    return _c(dow).isin(*fixed.WEEKEND_DAYS)


def day_part(hour: str | Column) -> Column:
    """Searched CASE with inclusive BETWEEN bounds."""
    h = _c(hour)
    expr = None
    for name, lo, hi in fixed.DAY_PARTS:
        expr = F.when(h.between(lo, hi), name) if expr is None else expr.when(h.between(lo, hi), name)
    return expr.otherwise(fixed.DAY_PART_OTHER)
