"""Load modes and landing layouts.

Raw wave tables are Parquet partitioned by their wave column, so "delete the
wave, load it again" (B6) replaces one partition folder. Every replacement is
computed before anything old is touched and then swapped in by rename: a load that
fails leaves the table as it was, one that is killed leaves it old or new (readers
finish its swap), a rerun gives the same content, and a wave without a file ends up
empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwright import contracts
from cartwright.contracts import TableContract
from cartwright.operators.joins import strict_lookup
from cartwright.session import list_names, path_exists, recover, write_and_swap, write_pending_partitions
from cartwright.sources.csv import csv_waves, read_contract_csv, read_csv_waves, wave_file_label, write_contract_csv


def write_waves(df: DataFrame, path: str, wave_col: str | list[str] = "order_number", mode: str = "overwrite",
                max_records_per_file: int = 5_000_000) -> None:
    """B2: route every row to its wave partition ``<path>/<wave_col>=N/`` (with several
    columns, nested folders).

    Waves shrink steeply with N (everyone has a first order), so a plain
    hash repartition on the wave would put most rows in one task, and no
    repartition at all would make every input task write a file per wave.
    The ``rebalance`` hint clusters rows by wave and lets AQE split the big
    waves into advisory-size tasks and merge the small ones, without a
    sampling pass over the input; ``overwrite`` makes a rerun deterministic
    and drops waves that disappeared from the source.
    """
    columns = [wave_col] if isinstance(wave_col, str) else wave_col
    (df.hint("rebalance", *columns)
     .write.mode(mode).option("maxRecordsPerFile", max_records_per_file)
     .partitionBy(*columns).parquet(path))


def read_waves(spark: SparkSession, path: str, contract: TableContract) -> DataFrame:
    """A2/A3: a wave table with its contract schema; a filter on the wave
    column prunes partitions, a missing wave reads empty. A missing table folder
    is an error: a mistyped path must not pass for empty waves."""
    recover(spark, path)
    if not path_exists(spark, path):
        raise FileNotFoundError(f"nothing landed at {path}")
    return spark.read.schema(contract.schema()).parquet(path).select(*contract.column_names)


def read_landed(spark: SparkSession, folder: str, contract: TableContract,
                waves: list[int] | None = None) -> DataFrame:
    """The given waves of a landed wave table: ``<table>_NNN.csv`` files, or
    else Parquet partitions."""
    if not path_exists(spark, folder):
        raise FileNotFoundError(f"nothing landed at {folder}")
    if csv_waves(spark, folder, contract):
        return read_csv_waves(spark, folder, contract, waves)
    rows = read_waves(spark, folder, contract)
    return rows if waves is None else rows.where(F.col(contract.wave_column).isin(list(waves)))


def read_wave(spark: SparkSession, path: str, contract: TableContract, wave: int) -> DataFrame:
    return read_landed(spark, path, contract, [wave])


def split_waves(orders: DataFrame, lines: dict[str, DataFrame], landing: str) -> None:
    """B2 + J6: split orders by order_number, and each line table by the
    order_number of its order (strict lookup: a line without an order aborts).

    ``lines`` maps table name -> DataFrame of (order_id, product_id,
    add_to_cart_order, reordered).
    """
    write_waves(orders, f"{landing}/orders")
    order_map = orders.select("order_id", "order_number")
    for name, df in lines.items():
        contract = contracts.table(name)
        routed = strict_lookup(df, order_map, "order_id", "order_number")
        write_waves(routed.select(*contract.column_names), f"{landing}/{name}")


def with_loaded_at(df: DataFrame) -> DataFrame:
    """B4 audit column, stamped at load."""
    return df.withColumn("_loaded_at", F.current_timestamp())


def create_raw_table(spark: SparkSession, database: str, contract: TableContract, location: str) -> None:
    """Create-if-not-exists from the contract, plus the ``_loaded_at`` audit column."""
    cols = ", ".join(f"{c.name} {contracts.TYPE_MAP[c.type].simpleString()}" for c in contract.columns)
    part = f" PARTITIONED BY ({contract.wave_column})" if contract.load_mode == "wave" else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{contract.name} "
              f"({cols}, _loaded_at timestamp DEFAULT current_timestamp()) "
              f"USING parquet{part} LOCATION '{location}'")


def load_full(df: DataFrame, contract: TableContract, target: str) -> None:
    """Full refresh; the new content replaces the old once it is complete."""
    write_and_swap(with_loaded_at(df.select(*contract.column_names)), target)


def load_wave(spark: SparkSession, df: DataFrame | None, contract: TableContract, wave: int, target: str) -> None:
    """Replace exactly one wave. ``df`` is the wave's source rows (``None``
    when no file landed for the wave): the partition is emptied either way.
    Other waves are untouched; if the load fails, this one is too."""
    wave_col = contract.wave_column
    if df is None:
        df = spark.createDataFrame([], contract.schema())
    rows = with_loaded_at(df.where(F.col(wave_col) == wave).select(*contract.column_names)).drop(wave_col)
    write_and_swap(rows, f"{target}/{wave_col}={wave}")


def partitions_of(spark: SparkSession, target: str, column: str) -> dict[str, str]:
    """Partition value (as written in the folder name) -> folder."""
    recover(spark, target)
    return {n.split("=", 1)[1]: f"{target}/{n}" for n in list_names(spark, target) if n.startswith(f"{column}=")}


def load_waves(spark: SparkSession, df: DataFrame, contract: TableContract, waves: list[int], target: str) -> None:
    """B6 for several waves in one job: every listed wave is replaced by its
    rows in ``df``; listed waves without rows are gone. Waves not listed are
    untouched. All waves change together, or none if the load fails."""
    wave_col = contract.wave_column
    rows = with_loaded_at(df.where(F.col(wave_col).isin(waves)).select(*contract.column_names))
    write_pending_partitions(rows, target, wave_col, waves).publish()


def read_loaded_wave_table(spark: SparkSession, target: str, contract: TableContract) -> DataFrame:
    recover(spark, target)
    schema = contract.schema().add("_loaded_at", "timestamp")
    return spark.read.schema(schema).parquet(target).select(*contract.column_names, "_loaded_at")


def landing_selection(full: bool = False, wave: int | None = None) -> tuple[bool, bool]:
    """B13, landing side: which parts to land. Nothing asked = everything
    (reference tables and every wave); ``full`` wins over ``wave``.
    Returns (land_reference_tables, land_waves)."""
    return (full or wave is None), (not full)


def land_sources(spark: SparkSession, raw, landing: str, *, full: bool = False, wave: int | None = None) -> list[str]:
    """Land source tables under ``<landing>/<table>/`` — reference
    tables as CSV, wave tables in the wave layout (one wave or all)."""
    do_full, do_waves = landing_selection(full, wave)
    done = []
    if do_full:
        for c in contracts.FULL_TABLES:
            write_contract_csv(raw.table(c.name), f"{landing}/{c.name}", c)
            done.append(c.name)
    if do_waves:
        for c in contracts.WAVE_TABLES:
            df = raw.table(c.name)
            if wave is not None:
                load_waves(spark, df, c, [wave], f"{landing}/{c.name}")
                done.append(wave_file_label(c.name, wave))
            else:
                write_waves(df, f"{landing}/{c.name}")
                done.append(c.name)
    return done


def ingest(spark: SparkSession, landing: str, target_root: str, *, setup: str | None = None, full: bool = False,
           wave: int | None = None, reference_sources: dict[str, DataFrame] | None = None) -> list[str]:
    """The batch loader entry. ``setup`` names a database in which all raw
    tables are created if they do not exist (B4); ``full`` reloads the reference
    tables (from ``<landing>/<table>/`` CSVs unless DataFrames are given), ``wave``
    replaces that wave in every wave table, from ``<table>_NNN.csv`` or Parquet
    partitions. Any of them may be given together, in that order.
    Returns the tables made or written. Asking for nothing is an error.
    """
    if setup is None and not full and wave is None:
        raise ValueError("nothing to do: pass setup=DATABASE, full=True and/or wave=N")
    done = []
    if setup is not None:
        for c in contracts.TABLES:
            create_raw_table(spark, setup, c, f"{target_root}/{c.name}")
            done.append(f"{setup}.{c.name}")
    if full:
        for c in contracts.FULL_TABLES:
            if reference_sources is not None:
                src = reference_sources.get(c.name)
            elif path_exists(spark, f"{landing}/{c.name}"):
                src = read_contract_csv(spark, f"{landing}/{c.name}", c)  # landed CSV, contract schema
            else:
                src = None
            if src is None:
                raise FileNotFoundError(f"source for full-load table {c.name} not found")
            load_full(src, c, f"{target_root}/{c.name}")
            done.append(c.name)
    if wave is not None:
        landed = {c.name: read_landed(spark, f"{landing}/{c.name}", c, [wave]) for c in contracts.WAVE_TABLES}
        for c in contracts.WAVE_TABLES:
            load_wave(spark, landed[c.name], c, wave, f"{target_root}/{c.name}")
            done.append(f"{c.name}@{wave_file_label(c.name, wave)}")
    return done
