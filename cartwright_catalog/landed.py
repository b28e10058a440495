"""The landed raw layer: raw tables as Parquet under the shared folder.

In production the raw layer is whatever the loaders wrote. Here it is derived
once per session from the driver tables (see
:mod:`cartwright_catalog.driver_tables`) and written in the production layout:
wave tables partitioned by ``order_number``, the feed table append-only.
Every model query then reads these tables, so their work grows with the data.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from cartwright import contracts
from cartwright.session import make_folder, move, path_exists, remove, scratch_dir
from cartwright.sinks.loads import read_waves, write_waves
from cartwright.raw import RawLayer
from cartwright_catalog.driver_tables import feed_payloads, raw_layer, raw_order_lines, raw_orders, read_table

_LANDED: dict[tuple[str, str], tuple[str, RawLayer]] = {}


def land_raw_layer(spark: SparkSession, sf_dir: str, root: str | None = None) -> tuple[str, RawLayer]:
    """Write the raw layer derived from ``sf_dir``; return (root, layer read back)."""
    root = root or scratch_dir(spark, "raw")
    orders = raw_orders(read_table(spark, sf_dir, "orders"))
    write_waves(orders, f"{root}/orders")
    orders = read_waves(spark, f"{root}/orders", contracts.table("orders"))
    # both line tables are one write, whose folders become theirs
    lines = raw_order_lines(read_table(spark, sf_dir, "lineitem"), orders)
    write_waves(lines, f"{root}/.lines", ["eval_set", "order_number"])
    for name in contracts.LINE_TABLES:
        source = f"{root}/.lines/eval_set={name.rsplit('_', 1)[-1]}"
        if path_exists(spark, source):
            move(spark, source, f"{root}/{name}")
        else:
            make_folder(spark, f"{root}/{name}")
    remove(spark, f"{root}/.lines")
    raw = raw_layer(spark, sf_dir, lines, orders)
    for c in contracts.FULL_TABLES:
        raw.table(c.name).write.mode("overwrite").parquet(f"{root}/{c.name}")
    # events are dealt before their payloads are made: a file of few row groups is read by few tasks
    feed_payloads(read_table(spark, sf_dir, "events").hint("rebalance", "event_id")).write.mode("overwrite").parquet(
        f"{root}/off_products_raw")
    return root, read_raw_layer(spark, root)


def read_raw_layer(spark: SparkSession, root: str) -> RawLayer:
    tables = {c.name: read_waves(spark, f"{root}/{c.name}", c) for c in contracts.WAVE_TABLES}
    for c in contracts.FULL_TABLES:
        tables[c.name] = spark.read.schema(c.schema()).parquet(f"{root}/{c.name}")
    tables["off_products_raw"] = spark.read.parquet(f"{root}/off_products_raw")
    return RawLayer(**tables)


def landed_raw_layer(spark: SparkSession, sf_dir: str) -> RawLayer:
    """The raw layer for ``sf_dir``, landed on first use in this application."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _LANDED:
        _LANDED[key] = land_raw_layer(spark, sf_dir)
    return _LANDED[key][1]


def landed_raw_root(spark: SparkSession, sf_dir: str) -> str:
    landed_raw_layer(spark, sf_dir)
    return _LANDED[(spark.sparkContext.applicationId, sf_dir.rstrip("/"))][0]
