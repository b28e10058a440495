"""Column-level functions (JVM-side built-ins only; no Python UDFs)."""

from cartwright.functions.keys import surrogate_key
from cartwright.functions.scalars import (
    day_name, day_part, is_weekend, ratio_or_null, round_avg, utc_date_label, wave_label,
)
from cartwright.functions.variant import variant_path

__all__ = ["surrogate_key", "wave_label", "utc_date_label", "round_avg", "ratio_or_null",
           "day_name", "day_part", "is_weekend", "variant_path"]
