"""A1-A3: contract-typed CSV scans and landings.

Header row skipped, ``"`` quoting with ``""`` as the escaped quote, empty
field and ``""`` read as NULL, blanks around a value kept, any malformed record
aborts the job (B14). Quoted line breaks are read for contracts that say so
(``multi_line``: such files cannot be split, so it is not the default). The schema
always comes from the contract; nothing is inferred.

A wave table lands as one ``<table>_NNN.csv`` per wave in the table's folder, each
a file or a folder of part files.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwright import fixed
from cartwright.contracts import TableContract
from cartwright.session import list_names, move, remove, scratch_dir

_FORMAT = {"header": "true", "quote": '"', "escape": '"',
           "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
READ_OPTIONS = _FORMAT | {"mode": "FAILFAST", "nullValue": ""}


def read_contract_csv(spark: SparkSession, path: str | list[str], contract: TableContract) -> DataFrame:
    return (spark.read.schema(contract.schema()).options(**READ_OPTIONS, multiLine=str(contract.multi_line).lower())
            .csv(path).select(*contract.column_names))


def write_contract_csv(df: DataFrame, path: str, contract: TableContract, partition_by: str | None = None) -> None:
    """Land rows as CSV with a header, quoting where needed."""
    rows = df.select(*contract.column_names)
    if partition_by:
        rows = rows.hint("rebalance", partition_by)
    w = rows.write.mode("overwrite").options(**_FORMAT)
    if partition_by:
        w = w.partitionBy(partition_by)
    w.csv(path)


def wave_file_label(table: str, wave: int) -> str:
    """``<table>_NNN``, the name one wave of a table lands under."""
    return f"{table}_{fixed.WAVE_LABEL_FORMAT % wave}"


def csv_waves(spark: SparkSession, folder: str, contract: TableContract) -> dict[int, str]:
    """The landed waves of a table and where they are, from one listing."""
    name = re.compile(re.escape(contract.name) + r"_(\d{3,})\.csv")
    found = ((name.fullmatch(n), n) for n in list_names(spark, folder))
    return {int(m[1]): f"{folder}/{n}" for m, n in found if m}


def read_csv_waves(spark: SparkSession, folder: str, contract: TableContract,
                   waves: list[int] | None = None) -> DataFrame:
    """A2/A3: the given waves (all, if none are given) of a landed table; a wave
    without a file has no rows."""
    landed = csv_waves(spark, folder, contract)
    paths = [landed[w] for w in (sorted(landed) if waves is None else waves) if w in landed]
    if not paths:
        return spark.createDataFrame([], contract.schema())
    return read_contract_csv(spark, paths, contract)


def write_csv_waves(df: DataFrame, folder: str, contract: TableContract) -> None:
    """B1/B2: land a wave table as ``<folder>/<table>_NNN.csv``.

    Written as one job partitioned by wave (a big wave is spread over tasks), then
    each wave's folder is renamed; waves that are landed already are replaced.
    """
    spark = df.sparkSession
    staged = scratch_dir(spark, f"csv-{contract.name}")
    key = "_wave"
    rows = df.select(*contract.column_names, F.col(contract.wave_column).alias(key))
    rows.hint("rebalance", key).write.mode("overwrite").options(**_FORMAT).partitionBy(key).csv(staged)
    for name in list_names(spark, staged):
        if name.startswith(f"{key}="):
            target = f"{folder}/{wave_file_label(contract.name, int(name.split('=')[1]))}.csv"
            remove(spark, target)
            move(spark, f"{staged}/{name}", target)
    remove(spark, staged)
