"""Schema-on-read paths into a VARIANT payload.

A missing path or a JSON null reads NULL. With ``strict=True`` a value that
cannot be cast raises (abort on bad record, B14); otherwise it reads NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def variant_path(payload: str | Column, *keys: str, type_: str = "string", strict: bool = True) -> Column:
    """``payload:a:b::type``. Keys are quoted, so names like ``energy-kcal_100g`` work."""
    p = F.col(payload) if isinstance(payload, str) else payload
    path = "$" + "".join(f'["{k}"]' for k in keys)
    return F.variant_get(p, path, type_) if strict else F.try_variant_get(p, path, type_)
