"""Deterministic hash surrogate keys.

``md5`` over the key parts cast to string, each NULL part replaced by a fixed
token *before* joining (``concat_ws`` would silently skip NULLs), joined with
``-``. Facts recompute the same key from the natural key, so they never need a
lookup join against the dimension (J9).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cartwright import fixed


def surrogate_key(*cols: str | Column) -> Column:
    parts = []
    for c in cols:
        c = F.col(c) if isinstance(c, str) else c
        parts.append(F.coalesce(c.cast("string"), F.lit(fixed.SURROGATE_NULL_TOKEN)))
    return F.md5(F.concat_ws(fixed.SURROGATE_SEPARATOR, *parts))
