"""Exact per-group numbering that survives a hot group.

``row_number() over (partition by g order by o)`` sends a whole group to one
task; when one user or one order holds a third of the rows, that task is the
job. So rows are counted first, by ``BUCKETS`` hashes of ``g``. Buckets of at
most ``HOT_ROWS`` rows, as a rule all, hold no hot group: one window and one
shuffle number their rows. The rows of the others are range-partitioned on
``(g, o)``, so that a hot group is cut into ordered segments spread over many
tasks:

1. ``repartitionByRange(g, o)``; tag each row with its partition id and
   write the result as a reliable checkpoint (shared ``spark.checkpoint.dir``).
   The range bounds come from a random sample seeded per RDD, so two
   evaluations of the same plan may cut differently; the checkpoint makes the
   partition ids a fact that both sides of the later self-join read, and that
   survives a lost executor.
2. Number rows inside each ``(partition, g)`` segment (window on a key that
   is at most one partition large).
3. Aggregate one row per segment (size, last value), and run a prefix sum
   over the segments of each group: a group spans at most as many segments
   as there are partitions, so this window is small and balanced.
4. Join the segment offsets back on ``(partition, g)``. The rows are already
   hash-partitioned on that key by step 2, so only the small side moves.

``lag`` of a column is carried the same way: inside a segment it is the
ordinary lag, for a segment's first row it is the last value of the previous
segment of the same group.

Order keys must make the order total (add a unique key as the last one),
otherwise a retried task could number tied rows differently.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwright.session import RowWise, checkpoint_root

HOT_ROWS = 1_000_000
BUCKETS = 1 << 16

_PID, _LRN, _N, _OFF, _LAST, _PREV = "_seg_pid", "_seg_lrn", "_seg_n", "_seg_off", "_seg_last", "_seg_prev"


def number_within_groups(df: DataFrame, group_cols: list[str], order_cols: list[str], rn_col: str = "rn",
                         lag_of: dict[str, str] | None = None, num_partitions: int | None = None,
                         collapse: RowWise | None = None) -> DataFrame:
    """Add ``rn_col`` = row_number() over (partition by group order by order, ascending).

    ``lag_of`` maps a source column to the name of its lag-1 column in the
    same window. Returns all input columns plus the new ones; rows whose group has a
    NULL are left out. ``collapse`` makes the rows that are numbered, never more of a group
    than ``df`` has, by an aggregate on the group columns and others: it and the window then
    share one shuffle.
    """
    lag_of = lag_of or {}
    df = df.dropna(subset=group_cols)
    bucket = F.pmod(F.xxhash64(*group_cols), F.lit(BUCKETS))
    sizes = df.groupBy(bucket.alias("b")).count().where(F.col("count") > HOT_ROWS)
    hot = [r["b"] for r in sizes.collect()]  # at most one in HOT_ROWS rows

    def together(rows: DataFrame) -> DataFrame:
        return _by_window(collapse(rows.repartition(*group_cols)) if collapse else rows, group_cols, order_cols, rn_col, lag_of)

    if not hot:
        return together(df)
    large = df.where(bucket.isin(hot))
    spread = _by_ranges(collapse(large) if collapse else large, group_cols, order_cols, rn_col, lag_of, num_partitions)
    return together(df.where(~bucket.isin(hot))).unionByName(spread)


def _by_window(df: DataFrame, group_cols: list[str], order_cols: list[str], rn_col: str, lag_of: dict[str, str]) -> DataFrame:
    w = Window.partitionBy(*group_cols).orderBy(*order_cols)
    new = {out: F.lag(src).over(w) for src, out in lag_of.items()}
    return df.withColumns({rn_col: F.row_number().over(w).cast("long"), **new})


def _by_ranges(df: DataFrame, group_cols: list[str], order_cols: list[str], rn_col: str, lag_of: dict[str, str],
               num_partitions: int | None) -> DataFrame:
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [*group_cols, *order_cols]

    checkpoint_root(spark)
    ranged = df.repartitionByRange(n, *keys).withColumn(_PID, F.spark_partition_id()).checkpoint(eager=True)
    seg_keys = [_PID, *group_cols]
    w_local = Window.partitionBy(*seg_keys).orderBy(*order_cols)
    ranged = ranged.withColumn(_LRN, F.row_number().over(w_local))
    for src, out in lag_of.items():
        ranged = ranged.withColumn(f"{_PREV}_{out}", F.lag(src).over(w_local))

    seg_aggs = [F.count(F.lit(1)).alias(_N)]
    seg_aggs += [F.max_by(src, _LRN).alias(f"{_LAST}_{out}") for src, out in lag_of.items()]
    segments = ranged.groupBy(*seg_keys).agg(*seg_aggs)
    w_seg = Window.partitionBy(*group_cols).orderBy(_PID)
    segments = segments.withColumn(
        _OFF, F.coalesce(F.sum(_N).over(w_seg.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    for out in lag_of.values():
        segments = segments.withColumn(f"{_LAST}_{out}", F.lag(f"{_LAST}_{out}").over(w_seg))
    segments = segments.drop(_N)

    out_df = ranged.join(segments, seg_keys, "inner")
    out_df = out_df.withColumn(rn_col, (F.col(_OFF) + F.col(_LRN)).cast("long"))
    for out in lag_of.values():
        out_df = out_df.withColumn(
            out, F.when(F.col(_LRN) == 1, F.col(f"{_LAST}_{out}")).otherwise(F.col(f"{_PREV}_{out}")))
    helper = [_PID, _LRN, _OFF] + [f"{_LAST}_{o}" for o in lag_of.values()] + [f"{_PREV}_{o}" for o in
                                                                               lag_of.values()]
    return out_df.drop(*helper)
