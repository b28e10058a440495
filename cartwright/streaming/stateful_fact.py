"""K2 as a join of two streams: lines and orders in any order of arrival.

Lines and orders are both read as file streams and joined in Spark's state store: a line
waits there for its order, an order for its lines. What joins is applied to the fact with
delete+insert, batch by batch, so that a replayed batch changes nothing.

The state is bounded by time: either side is kept until the newest landed file is ``wait``
younger than the file it came from (file modification times are the streams' event time).
That bounds the lines of orders that never land, and of orders that staging filters out:
these join, are dropped by the filter behind the join, and leave the state when their time
is over. A line whose order lands later than ``wait`` after it is not found any more; the
pending table of :mod:`cartwright.streaming.wave_refresh` has no such limit.

The state is kept in RocksDB, on the executors' disks and in bounded memory: in Spark's own
store all of it, twice, is on the heap. Lines are put into it packed: those of one order
that came with the same file time are one row, so that the state is read and written once
an order and not once a line. They are unpacked behind the join.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwright import contracts
from cartwright.operators.incremental import delete_insert
from cartwright.plans.marts import FACT_ORDER_ITEMS_COLUMNS, fact_item_lines, with_item_keys
from cartwright.plans.staging import stg_orders
from cartwright.session import remove, scratch_dir


# Lines that a task packs at once. Lines of an order that meet in no such chunk are several
# rows of the state, which changes no result.
PACK_ROWS = 1 << 20
_OUT_ROWS = 1 << 14
_PACKED = ["product_id", "add_to_cart_order", "reordered"]
_LINES = "order_id long, order_number int, _line_at timestamp, " + ", ".join(f"{c} array<int>" for c in _PACKED)

# A store an executor's memory does not have to hold, in one instance a partition (Spark's
# join has four otherwise) and without a read before each write that only counts rows. An
# instance is loaded anew by each run, from files: a log of changes would be replayed.
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE_SETTINGS = {
    _PROVIDER: _ROCKSDB,
    "spark.sql.streaming.join.stateFormatVersion": "3",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "false",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    # how soon the instances of a run that is over give their disk back
    "spark.sql.streaming.stateStore.maintenanceInterval": "10s",
}


@contextmanager
def _state_settings(spark: SparkSession) -> Iterator[None]:
    """The settings of a stream that starts meanwhile (it takes a copy); a session that
    names a store of its own keeps it."""
    before = {k: spark.conf.get(k, None) for k in STATE_SETTINGS}
    own = before[_PROVIDER]
    put = {} if own and "HDFSBacked" not in own and own != _ROCKSDB else STATE_SETTINGS
    try:
        for k, v in put.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k in put:
            spark.conf.unset(k) if before[k] is None else spark.conf.set(k, before[k])


def _stream(spark: SparkSession, folder: str, name: str, landed: str, max_files: int | None) -> DataFrame:
    c = contracts.table(name)
    reader = spark.readStream.schema(c.schema())
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    rows = reader.parquet(f"{folder}/{name}")
    return rows.select(*c.column_names, F.col("_metadata.file_modification_time").alias(landed))


def _pack(rows: int):
    """Arrow batches of lines -> batches with a row an order, wave and file time, a list a column."""
    def packed(lines: list) -> Iterator:
        import pyarrow as pa

        keys = ["order_id", "order_number", "_line_at"]
        # on one thread, which keeps the lists in step
        groups = pa.Table.from_batches(lines).group_by(keys, use_threads=False).aggregate([(c, "list") for c in _PACKED])
        yield from groups.rename_columns(
            [c.removesuffix("_list") for c in groups.column_names]).select([*keys, *_PACKED]).combine_chunks().to_batches(_OUT_ROWS)

    def run(batches: Iterator) -> Iterator:
        held, n = [], 0
        for b in batches:
            held.append(b)
            n += b.num_rows
            if n >= rows:
                yield from packed(held)
                held, n = [], 0
        if n:
            yield from packed(held)

    return run


def _packed_lines(spark: SparkSession, folder: str, name: str, wait: str, max_files: int | None) -> DataFrame:
    # a line without an order_id has no order
    lines = _stream(spark, folder, name, "_line_at", max_files).where(F.col("order_id").isNotNull())
    packed = lines.repartition("order_id").mapInArrow(_pack(PACK_ROWS), _LINES)
    return packed.withWatermark("_line_at", wait).withColumn("source", F.lit(name.rsplit("_", 1)[-1]))


def joined_lines(spark: SparkSession, folder: str, wait: str = "7 days", max_files: int | None = None) -> DataFrame:
    """Streaming lines, packed, with the raw columns of their order, all eval sets."""
    parts = [_packed_lines(spark, folder, name, wait, max_files) for name in contracts.LINE_TABLES]
    lines = parts[0].unionByName(parts[1])
    orders = _stream(spark, folder, "orders", "_order_at", max_files).withWatermark("_order_at", wait).select(
        F.col("order_id").alias("o_order_id"), "user_id", "eval_set", F.col("order_number").alias("o_order_number"), "order_dow",
        "order_hour_of_day", "days_since_prior_order", "_order_at")
    span = F.expr(f"interval {wait}")
    near = (F.col("_line_at") >= F.col("_order_at") - span) & (F.col("_line_at") <= F.col("_order_at") + span)
    return lines.join(orders, (F.col("order_id") == F.col("o_order_id")) & near)


def _unpacked(lines: DataFrame) -> DataFrame:
    rest = [c for c in lines.columns if c not in _PACKED]
    return lines.select(*rest, F.inline(F.arrays_zip(*_PACKED)))


def refresh_stateful(spark: SparkSession, folder: str, target: str, checkpoint: str, wait: str = "7 days",
                     max_files: int | None = None) -> None:
    """Apply what has landed below ``folder`` since the last run (``orders`` and the line
    tables, as wave partitions) to the fact at ``target``."""
    def apply(batch: DataFrame, _: int) -> None:
        # written once: every use of ``batch`` itself would run the join, and its state, again
        staging = scratch_dir(spark, "joined-lines")
        try:
            batch.drop("_line_at", "_order_at").write.mode("overwrite").parquet(staging)
            settle(spark.read.schema(batch.drop("_line_at", "_order_at").schema).parquet(staging))
        finally:
            remove(spark, staging)

    def settle(batch: DataFrame) -> None:
        lines = batch.select("order_id", *_PACKED, "order_number", "source")
        orders = batch.select(F.col("o_order_id").alias("order_id"), "user_id", "eval_set",
                              F.col("o_order_number").alias("order_number"), "order_dow", "order_hour_of_day",
                              "days_since_prior_order").distinct()
        rows = _unpacked(fact_item_lines(lines, stg_orders(orders)))
        delete_insert(spark, rows, target, ["order_id", "product_id"], "order_number", FACT_ORDER_ITEMS_COLUMNS,
                      finish=with_item_keys)

    with _state_settings(spark):
        q = (joined_lines(spark, folder, wait, max_files).writeStream.foreachBatch(apply)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception():
        raise q.exception()
