"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import sys
from collections.abc import Callable
from types import ModuleType
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwright.session import scratch_dir

#: The white space of every text contract: space, tab, LF, VT, FF, CR.
SPACES = " \t\n\x0b\x0c\r"
WORD = "[^\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialize(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` once below ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage with committed files that outlive any executor; values
    that depend on the task layout (row keys) are fixed from here on.
    """
    return materialize_at(df, purpose)[0]


def materialize_at(df: DataFrame, purpose: str) -> tuple[DataFrame, str]:
    """As :func:`materialize`, with the folder, for those that remove it when
    nothing reads it any more."""
    spark = df.sparkSession
    path = scratch_dir(spark, f"llm-{purpose}")
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def whole_row(df: DataFrame) -> Column:
    """All columns of ``df`` as one struct, so that no helper column of an
    operator can clash with a column of the input."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def once_per_worker(key: tuple, make: Callable[[], Any]) -> Any:
    """``make()``, kept for the later tasks of the same Python worker. (Functions travel
    by value, so that globals of this module start anew with every task.)"""
    kept = sys.modules.setdefault("_cartwright_worker", ModuleType("_cartwright_worker")).__dict__
    if key not in kept:
        kept[key] = make()
    return kept[key]
