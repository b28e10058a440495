"""Where the keys of a partitioned table are: its leading key column by partition.

The index holds, for every partition, the distinct values of the leading key, sorted, with
Parquet bloom filters (:mod:`cartwright.operators.partition_state` keeps it in step). A
composite key can only be in a partition that holds its leading value, so a batch looks
its keys up here and opens the table for the partitions that may hold one, in most cases
none. For order lines the index has a row an order, not a row a line.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from cartwright.operators.partition_state import Derived


def key_index(target: str, column: str, lead: str, kind: DataType) -> Derived:
    """``kind`` is the type of the leading key column ``lead``."""
    return Derived(target, column, "index",
                   lambda rows: rows.where(F.col(lead).isNotNull()).select(lead, column).distinct(),
                   StructType().add(lead, kind), (lead,), lead, {f"parquet.bloom.filter.enabled#{lead}": "true"})


def partitions_with(spark: SparkSession, index: Derived, keys: DataFrame, low, high) -> set[int]:
    """The partitions that hold a leading key of ``keys``, which lie between ``low`` and
    ``high``, from the index, which is brought up to date first."""
    lead = index.schema.fieldNames()[0]
    if low is None:
        return set()
    near = index.read(spark).where(F.col(lead).between(low, high))
    hit = near.join(keys.select(lead).dropna().distinct(), lead, "left_semi")
    return {r[0] for r in hit.select(index.column).distinct().collect()}  # one value a partition
