"""Incremental delete+insert on a composite key.

The target is Parquet partitioned by the wave column. A batch replaces every
target row that shares its unique key (wherever it lives) and adds its own
rows. With ``replace`` it also replaces the named partitions: whatever they held
goes, rows that the batch no longer has and emptied partitions included. Only the
affected partitions are rewritten:

    affected = partitions of the batch + replaced partitions
             + partitions of target rows whose key is in the batch
    new(p)   = batch(p)                                        p replaced
             = target(p) anti-join batch keys UNION ALL batch(p)    else

Which partitions hold a key of the batch is looked up in the key index beside the
target (:mod:`cartwright.operators.key_index`); the key columns of the target itself are
read only for partitions that the index names and the batch does not rewrite anyway.
The new content is computed into a hidden folder (the target must not be read while it
is overwritten) and swapped in as a whole. NULL keys never match (anti-join semantics).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwright.operators.key_index import key_index, partitions_with
from cartwright.session import Pending, RowWise, path_exists, remove, scratch_dir, write_pending, write_pending_partitions
from cartwright.sinks.loads import partitions_of


class SchemaChangeError(RuntimeError):
    pass


def table_exists(spark: SparkSession, path: str) -> bool:
    return path_exists(spark, path)


def check_schema(batch: DataFrame, target: DataFrame, partition_col: str) -> None:
    """Fail when the batch adds, drops or retypes a column of the target.

    Compared as sets: Parquet puts the partition column last, and its type is
    inferred from folder names, so only its presence is checked.
    """
    def cols(df: DataFrame) -> set:
        return {(f.name, "partition" if f.name == partition_col else f.dataType.simpleString())
                for f in df.schema.fields}
    a, b = cols(batch), cols(target)
    if a != b:
        raise SchemaChangeError(f"schema change: batch-only {sorted(a - b)}, target-only {sorted(b - a)}")


def max_partition_value(spark: SparkSession, path: str, col: str) -> int:
    """C7 watermark: the largest value among the partition folders, without
    opening a file; 0 for a missing or empty target (everything is loaded)."""
    return max(_numbers(spark, path, col), default=0)


def _numbers(spark: SparkSession, path: str, col: str) -> set[int]:
    """The partition values; a partition of NULLs has no number."""
    return {int(v) for v in partitions_of(spark, path, col) if v.lstrip("-").isdigit()}


def delete_insert(spark: SparkSession, batch: DataFrame, target_path: str, unique_key: list[str],
                  partition_col: str, columns: list[str], replace: list[int] | None = None,
                  finish: RowWise | None = None) -> int:
    """Apply ``batch`` to the target; returns the number of partitions touched
    (-1: the target was missing or empty). ``replace`` names partitions that hold the
    batch's rows alone afterwards; all rows of the batch must be in them. ``finish`` gives
    the batch its columns row by row; it comes after the shuffles.
    """
    pending, affected = stage_delete_insert(spark, batch, target_path, unique_key, partition_col, columns, replace, finish)
    if pending is not None:
        pending.publish()
    return -1 if affected is None else len(affected)


def stage_delete_insert(spark: SparkSession, batch: DataFrame, target_path: str, unique_key: list[str], partition_col: str,
                        columns: list[str], replace: list[int] | None = None,
                        finish: RowWise | None = None) -> tuple[Pending | None, set[int] | None]:
    """As :func:`delete_insert`, up to the complete new content of the affected partitions
    (None: nothing changes), which the caller publishes or discards. Also returns the
    affected partitions, None for a missing or empty target.

    The batch is written once to the shared folder, since the search for affected
    partitions and the write both read it.
    """
    def finished(rows: DataFrame) -> DataFrame:
        return (finish(rows) if finish else rows).select(*columns)

    if finish is None:
        batch = batch.select(*columns)
    if not partitions_of(spark, target_path, partition_col):
        return write_pending(batch, target_path, partition_col, unique_key[0], finished), None
    schema = spark.read.parquet(target_path).schema
    check_schema(finished(batch), spark.createDataFrame([], schema), partition_col)
    staging = scratch_dir(spark, "delete-insert")
    try:
        batch = _staged(batch, f"{staging}/batch")
        return _stage(spark, batch, target_path, unique_key, partition_col, columns, replace, finished)
    finally:
        remove(spark, staging)


def _staged(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _stage(spark: SparkSession, batch: DataFrame, target_path: str, unique_key: list[str], partition_col: str,
           columns: list[str], replace: list[int] | None, finished: RowWise) -> tuple[Pending | None, set[int]]:
    target = spark.read.parquet(target_path).select(*columns)
    keys = batch.select(*unique_key).dropna(how="any").distinct()
    replaced = set(replace or ())
    # the partitions of the batch, and those with a key of it: one value per wave
    lead = unique_key[0]
    waves = batch.groupBy(partition_col).agg(F.min(lead), F.max(lead)).collect()
    own = {r[0] for r in waves}
    if None in own:
        raise ValueError(f"the batch has rows without {partition_col}")
    if replace is not None and own - replaced:
        raise ValueError(f"the batch has rows outside the partitions to replace: {sorted(own - replaced)}")
    bounds = [b for r in waves for b in r[1:] if b is not None]
    low, high = (min(bounds), max(bounds)) if bounds else (None, None)
    index = key_index(target_path, partition_col, lead, batch.schema[lead].dataType)
    others = partitions_with(spark, index, keys, low, high) - own - replaced
    holds = set()
    if others:
        near = target.where(F.col(partition_col).isin(sorted(others)))
        holds = {r[0] for r in near.join(keys, unique_key, "left_semi").select(partition_col).distinct().collect()}
    existing = _numbers(spark, target_path, partition_col)
    affected = own | holds | (replaced & existing)
    if not affected:
        return None, affected
    rewritten = (holds | (own & existing)) - replaced  # partitions that keep some of their rows
    if not rewritten:
        return write_pending_partitions(batch, target_path, partition_col, sorted(affected), unique_key[0], finished), affected
    kept = target.where(F.col(partition_col).isin(sorted(rewritten))).join(keys, unique_key, "left_anti")
    new = kept.unionByName(finished(batch))
    return write_pending_partitions(new, target_path, partition_col, sorted(affected), unique_key[0]), affected
