"""Join helpers: strict lookup (J6), orphan count.

No side is broadcast by hint: the planner and AQE decide on measured bytes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def strict_lookup(left: DataFrame, right: DataFrame, key: str, value: str) -> DataFrame:
    """Attach ``right.value`` to every left row by ``key``; a left row with
    no match aborts the job. ``right`` must be unique on ``key`` (checked), so
    the join cannot fan out."""
    dupes = right.groupBy(key).count().where(F.col("count") > 1).limit(1).count()
    if dupes:
        raise ValueError(f"lookup side is not unique on {key}")
    joined = left.join(right.select(key, value), key, "left")
    return joined.withColumn(
        value,
        F.when(F.col(value).isNull(), F.raise_error(F.concat(F.lit(f"no {value} for {key}="),
                                                             F.col(key).cast("string"))))
        .otherwise(F.col(value)))


def orphan_count(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str | None = None) -> DataFrame:
    """Number of child rows whose non-NULL key has no parent row.

    Child keys are pre-aggregated first (partial aggregation absorbs a hot
    key), so the anti join only sees one row per distinct key.
    """
    parent_key = parent_key or child_key
    per_key = (child.where(F.col(child_key).isNotNull())
               .groupBy(F.col(child_key).alias("_k")).agg(F.count(F.lit(1)).alias("_n")))
    parents = parent.select(F.col(parent_key).alias("_k")).where(F.col("_k").isNotNull())
    missing = per_key.join(parents, "_k", "left_anti")
    return missing.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("n_orphans"))
