"""K2: incremental fact refresh driven by newly landed wave files.

The raw line tables are read as file streams; each micro-batch (a set of new
wave files) is turned into fact rows and applied with the delete+insert operator,
so a replayed batch is idempotent and the checkpoint guarantees every landed
file is applied once.

A line may land before its order. Orders are read anew for every batch, and
lines without one wait in a pending table: batch N takes what batch N-1 left,
applies what has its order now, and leaves the rest as pending N. A replay of N
reads the same pending N-1 again. Before the stream starts, and without new files,
waiting lines are tried once more. Lines whose order has landed but is not among those
that staging keeps will never have one there; they leave the pending table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwright import contracts
from cartwright.operators.incremental import delete_insert
from cartwright.plans.marts import FACT_ORDER_ITEMS_COLUMNS, fact_item_lines, with_item_keys
from cartwright.session import list_names, recover, remove, write_and_swap

LINES = ("order_id long, product_id int, add_to_cart_order int, reordered int, order_number int, source string")


def stream_order_products(spark: SparkSession, raw_root: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """stg_order_products as a stream over the raw wave folders."""
    parts = []
    for name in contracts.LINE_TABLES:
        c = contracts.table(name)
        reader = spark.readStream.schema(c.schema())
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        parts.append(reader.parquet(f"{raw_root}/{name}").select(
            *c.column_names, F.lit(name.rsplit("_", 1)[-1]).alias("source")))
    return parts[0].unionByName(parts[1])


def _settle(spark: SparkSession, lines: DataFrame, orders: DataFrame, landed: DataFrame, target: str, pending: str) -> None:
    """Apply the lines whose order is there; leave those whose order has not landed in
    ``pending``."""
    delete_insert(spark, fact_item_lines(lines, orders), target, ["order_id", "product_id"], "order_number",
                  FACT_ORDER_ITEMS_COLUMNS, finish=with_item_keys)
    # last, since ``lines`` may read what this replaces; a crash in between only repeats the step above
    waiting = lines.join(landed.select("order_id"), "order_id", "left_anti").select(*lines.columns)
    write_and_swap(waiting, pending)


def _left(spark: SparkSession, pending_root: str, before: int) -> tuple[int, DataFrame]:
    """The newest pending table older than ``before``; -1 and no rows without one."""
    recover(spark, pending_root)
    epoch = max((int(n) for n in list_names(spark, pending_root) if n.isdigit() and int(n) < before), default=-1)
    if epoch < 0:
        return epoch, spark.createDataFrame([], LINES)
    return epoch, spark.read.schema(LINES).parquet(f"{pending_root}/{epoch}")


def refresh_on_new_lines(spark: SparkSession, lines_stream: DataFrame, orders: Callable[[], DataFrame], target: str,
                         checkpoint: str, landed: Callable[[], DataFrame] | None = None) -> None:
    """``lines_stream``: streaming stg_order_products rows; ``orders``: gives
    stg_orders as it stands at the time of the call; ``landed``: gives the order_id of
    all landed orders, those included that staging filters out (default: ``orders``)."""
    landed = landed or orders
    pending = f"{checkpoint}_pending"

    def apply(batch: DataFrame, number: int) -> None:
        _, waiting = _left(spark, pending, number + 1)
        _settle(spark, batch.select(*waiting.columns).unionByName(waiting), orders(), landed(), target, f"{pending}/{number + 1}")
        for name in list_names(spark, pending):
            if name.isdigit() and int(name) < number:
                remove(spark, f"{pending}/{name}")

    newest, waiting = _left(spark, pending, 1 << 62)
    if newest >= 0 and not waiting.isEmpty():
        _settle(spark, waiting, orders(), landed(), target, f"{pending}/{newest}")
    q = (lines_stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception():
        raise q.exception()
