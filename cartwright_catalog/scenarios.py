"""Catalog queries that exercise loads and writes end to end.

Each scenario writes through a fresh folder below the shared checkpoint root,
then returns a DataFrame that reads what was written, so the check sees the
table a user would see after the run. All of them process the whole raw
layer.
"""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwright import contracts
from cartwright.operators import quality
from cartwright.operators.joins import orphan_count
from cartwright.plans.models import Models
from cartwright.plans.marts import FACT_ORDER_ITEMS_COLUMNS
from cartwright.plans.pipelines import (
    Warehouse, build_marts, mart_tables, read_raw, refresh_fact_order_items, register_layers, run_feed, run_pull,
    run_setup, run_wave,
)
from cartwright.session import configure, scratch_dir
from cartwright.sinks.feed_landing import land_json_arrays
from cartwright.sinks.loads import (
    ingest, land_sources, load_full, load_wave, load_waves, partitions_of, read_loaded_wave_table, read_waves,
    split_waves,
)
from cartwright.sources import feed as feed_src
from cartwright.sources.csv import csv_waves, read_contract_csv, write_contract_csv, write_csv_waves
from cartwright.streaming.json_ingest import ingest_json_arrays
from cartwright.streaming.wave_refresh import refresh_on_new_lines, stream_order_products
from cartwright_catalog.driver_tables import read_table
from cartwright_catalog.landed import landed_raw_layer, landed_raw_root


def _setup(spark: SparkSession, sf_dir: str):
    configure(spark)
    return landed_raw_layer(spark, sf_dir)


def _wave_counts(tables: dict[str, DataFrame]) -> DataFrame:
    parts = [df.groupBy("order_number").agg(F.count(F.lit(1)).alias("n_rows"))
             .select(F.lit(name).alias("table_name"), "order_number", "n_rows") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def _all_waves(spark: SparkSession, sf_dir: str) -> list[int]:
    """The wave numbers of the landed orders, from their folder names."""
    return sorted(map(int, partitions_of(spark, f"{landed_raw_root(spark, sf_dir)}/orders", "order_number")))


# --- wave split and wave loads ----------------------------------------------

def wave_split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J6 + B2 + E10: split orders by order_number and route each line to its
    order's wave through the strict lookup; rows per (table, wave)."""
    raw = _setup(spark, sf_dir)
    landing = scratch_dir(spark, "waves")
    lines = {name: raw.table(name).drop("order_number") for name in contracts.LINE_TABLES}
    split_waves(raw.orders, lines, landing)
    tables = {c.name: read_waves(spark, f"{landing}/{c.name}", c) for c in contracts.WAVE_TABLES}
    return _wave_counts(tables)


def wave_reload_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load every wave, reload wave 1 twice and a wave with no file once;
    rows per (table, wave) must equal the source."""
    raw = _setup(spark, sf_dir)
    root = landed_raw_root(spark, sf_dir)
    wh = Warehouse(scratch_dir(spark, "warehouse"))
    waves = _all_waves(spark, sf_dir)
    for c in contracts.WAVE_TABLES:
        src = read_waves(spark, f"{root}/{c.name}", c)
        load_waves(spark, src, c, waves, wh.raw(c.name))
        load_wave(spark, src, c, 1, wh.raw(c.name))
        load_wave(spark, src, c, 1, wh.raw(c.name))
        load_wave(spark, None, c, max(waves) + 1, wh.raw(c.name))
    tables = {c.name: read_loaded_wave_table(spark, wh.raw(c.name), c) for c in contracts.WAVE_TABLES}
    return _wave_counts(tables)


def full_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 + B5: land the reference tables as CSV, full-load them twice; the
    product table holds each row once."""
    raw = _setup(spark, sf_dir)
    landing = scratch_dir(spark, "csv")
    wh = Warehouse(scratch_dir(spark, "warehouse"))
    for c in contracts.FULL_TABLES:
        write_contract_csv(raw.table(c.name), f"{landing}/{c.name}", c)
        for _ in range(2):
            load_full(read_contract_csv(spark, f"{landing}/{c.name}", c), c, wh.raw(c.name))
    return spark.read.parquet(wh.raw("products")).select(*contracts.table("products").column_names)


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1/A2: raw orders landed as per-wave CSV and read back with the contract
    schema (numeric text such as ``8.0`` parses into numeric(38,0))."""
    raw = _setup(spark, sf_dir)
    c = contracts.table("orders")
    landing = scratch_dir(spark, "csv")
    write_contract_csv(raw.orders, f"{landing}/orders", c, partition_by="order_number")
    back = read_contract_csv(spark, f"{landing}/orders", c)
    return back.withColumn("days_since_prior_order", F.col("days_since_prior_order").cast("long"))


# --- product feed -------------------------------------------------------------

def _feed_rows(raw_feed: DataFrame) -> DataFrame:
    p = F.col("payload")
    return raw_feed.select(
        F.variant_get(p, "$.code", "string").alias("product_code"),
        F.variant_get(p, "$.product_name", "string").alias("product_name"),
        F.variant_get(p, "$.brands", "string").alias("brands"),
        F.variant_get(p, '$.nutriments["energy-kcal_100g"]', "double").alias("energy_kcal_100g"),
        F.variant_get(p, "$.nutriments.fat_100g", "double").alias("fat_100g"),
        F.col("last_modified_t"))


def _land_feed(feed: DataFrame, landing: str) -> None:
    land_json_arrays(feed, landing, F.timestamp_seconds("last_modified_t"), "feed_seq")


def json_array_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B3 + A4/A5 + K1: land the feed as JSON arrays under dt= folders, ingest
    with the exactly-once file stream, return the loaded rows."""
    raw = _setup(spark, sf_dir)
    landing = scratch_dir(spark, "feed-landing")
    wh = Warehouse(scratch_dir(spark, "warehouse"))
    _land_feed(raw.off_products_raw, landing)
    ingest_json_arrays(spark, landing, wh.raw("off_products_raw"), wh.checkpoint("off_products_raw"))
    return _feed_rows(spark.read.parquet(wh.raw("off_products_raw")))


def append_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ingest, ingest again (adds nothing), land newer pulls, ingest (adds
    only them). Every landed product version is in the table exactly once."""
    raw = _setup(spark, sf_dir)
    landing = scratch_dir(spark, "feed-landing")
    wh = Warehouse(scratch_dir(spark, "warehouse"))
    feed = raw.off_products_raw
    mid = feed.agg(F.expr("(min(last_modified_t) + max(last_modified_t)) div 2")).first()[0]
    target, ckpt = wh.raw("off_products_raw"), wh.checkpoint("off_products_raw")
    _land_feed(feed.where(F.col("last_modified_t") <= mid), landing)
    ingest_json_arrays(spark, landing, target, ckpt)
    ingest_json_arrays(spark, landing, target, ckpt)
    _land_feed(feed.where(F.col("last_modified_t") > mid), landing)
    ingest_json_arrays(spark, landing, target, ckpt)
    return _feed_rows(spark.read.parquet(target))


def high_water_mark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """coalesce(max(last_modified_t), 0) of the loaded feed table."""
    return feed_src.high_water_mark(_setup(spark, sf_dir).off_products_raw)


def feed_above_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An uncapped pull of everything newer than the watermark; the
    watermark is the midpoint of the feed's time range."""
    feed = _setup(spark, sf_dir).off_products_raw
    wm = feed.agg(F.expr("(min(last_modified_t) + max(last_modified_t)) div 2")).first()[0]
    fresh = feed_src.above_watermark(feed, wm)
    return fresh.select(F.variant_get("payload", "$.code", "string").alias("product_code"), "last_modified_t",
                        F.col("feed_seq").alias("feed_pos"))


def feed_capped_topn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A backfill pull (watermark 0) capped at page_size x max_pages,
    newest first with a stable tie-break."""
    feed = _setup(spark, sf_dir).off_products_raw
    pulled = feed_src.extract(feed, 0, contracts.FeedContract(), capped=True, tie_breaks=["feed_seq"])
    return pulled.select(F.variant_get("payload", "$.code", "string").alias("product_code"), "last_modified_t",
                         F.col("feed_seq").alias("feed_pos"))


# --- incremental fact ---------------------------------------------------------

def fact_order_items_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C7 + B10: load waves 1-3 and build the fact, then load every later wave
    and advance the fact incrementally, then run the increment once more
    (adds nothing). The result equals a full build."""
    raw = _setup(spark, sf_dir)
    root = landed_raw_root(spark, sf_dir)
    wh = Warehouse(scratch_dir(spark, "warehouse"))
    waves = _all_waves(spark, sf_dir)
    first, rest = [w for w in waves if w <= 3], [w for w in waves if w > 3]
    for c in contracts.FULL_TABLES:
        load_full(raw.table(c.name), c, wh.raw(c.name))
    for step in (first, rest, []):
        for c in contracts.WAVE_TABLES:
            if step:
                load_waves(spark, read_waves(spark, f"{root}/{c.name}", c), c, step, wh.raw(c.name))
        refresh_fact_order_items(spark, Models(spark, read_raw(spark, wh)), wh)
    return spark.read.parquet(wh.mart("fact_order_items")).select(
        "order_id", "product_id", "order_number", "add_to_cart_order", "reordered", "source", "product_key",
        "user_key", "time_key")


def fact_order_items_streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2: the landed line files are read as streams; each micro-batch of files
    is applied to the fact with delete+insert (several batches, files once)."""
    raw = _setup(spark, sf_dir)
    root = landed_raw_root(spark, sf_dir)
    wh = Warehouse(scratch_dir(spark, "warehouse"))
    lines = stream_order_products(spark, root, max_files_per_trigger=16)
    refresh_on_new_lines(spark, lines, lambda: Models(spark, raw).stg_orders, wh.mart("fact_order_items"), wh.checkpoint("fact_order_items"))
    return spark.read.parquet(wh.mart("fact_order_items")).select(*FACT_ORDER_ITEMS_COLUMNS)


def warehouse_run_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three runs end to end: setup from landed CSVs, the waves in two runs
    (1-3, then the rest), one feed run over landed JSON arrays; returns the
    gate's per-test failure counts (the gate raises if any is non-zero)."""
    raw = _setup(spark, sf_dir)
    root = landed_raw_root(spark, sf_dir)
    csv_landing = scratch_dir(spark, "csv")
    feed_landing = scratch_dir(spark, "feed-landing")
    wh = Warehouse(scratch_dir(spark, "warehouse"))
    for c in contracts.FULL_TABLES:
        write_contract_csv(raw.table(c.name), f"{csv_landing}/{c.name}", c)
    run_setup(spark, wh, csv_landing)
    _land_feed(raw.off_products_raw, feed_landing)
    run_feed(spark, wh, feed_landing)
    waves = _all_waves(spark, sf_dir)
    run_wave(spark, wh, root, [w for w in waves if w <= 3])
    run_wave(spark, wh, root, [w for w in waves if w > 3])
    return quality.evaluate(quality.MART_TESTS, mart_tables(spark, wh))


# --- faults that must not lose, keep or change rows ------------------------------

def _loaded(spark: SparkSession, sf_dir: str) -> Warehouse:
    """A warehouse with every wave loaded and the line fact built."""
    raw, root = _setup(spark, sf_dir), landed_raw_root(spark, sf_dir)
    wh = Warehouse(scratch_dir(spark, "warehouse"))
    for c in contracts.FULL_TABLES:
        load_full(raw.table(c.name), c, wh.raw(c.name))
    waves = _all_waves(spark, sf_dir)
    for c in contracts.WAVE_TABLES:
        load_waves(spark, read_waves(spark, f"{root}/{c.name}", c), c, waves, wh.raw(c.name))
    refresh_fact_order_items(spark, Models(spark, read_raw(spark, wh)), wh)
    return wh


def fact_order_items_corrected_wave(spark: SparkSession, sf_dir: str) -> DataFrame:
    """After a full load the lines of some waves are corrected: waves 2
    and 3 lose every third product, wave 4 loses all lines, and lines of wave 5 whose
    product is divisible by 4 turn up in wave 6. Replacing these waves gives exactly
    the corrected lines."""
    wh = _loaded(spark, sf_dir)
    root = landed_raw_root(spark, sf_dir)
    product, wave = F.col("product_id"), F.col("order_number")
    for name in contracts.LINE_TABLES:
        c = contracts.table(name)
        lines = read_waves(spark, f"{root}/{name}", c)
        kept = lines.where(~((wave.isin(2, 3) & (product % 3 == 0)) | (wave == 4)))
        moved = kept.withColumn("order_number", F.when((wave == 5) & (product % 4 == 0), 6).otherwise(wave))
        load_waves(spark, moved.select(*c.column_names), c, [2, 3, 4, 5, 6], wh.raw(name))
    m = Models(spark, read_raw(spark, wh))
    # wave 5 is left to the deletion of its moved keys
    refresh_fact_order_items(spark, m, wh, waves=[2, 3, 4, 6])
    return spark.read.parquet(wh.mart("fact_order_items")).select(*FACT_ORDER_ITEMS_COLUMNS)


def fact_order_items_rebuilt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of wave 2 are corrected in place (every line reordered); the
    increment cannot see it, the full rebuild does."""
    wh = _loaded(spark, sf_dir)
    c = contracts.table("order_products_prior")
    lines = read_waves(spark, f"{landed_raw_root(spark, sf_dir)}/{c.name}", c).where("order_number = 2")
    load_wave(spark, lines.withColumn("reordered", F.lit(1)), c, 2, wh.raw(c.name))
    m = Models(spark, read_raw(spark, wh))
    refresh_fact_order_items(spark, m, wh)
    refresh_fact_order_items(spark, m, wh, full=True)
    return spark.read.parquet(wh.mart("fact_order_items")).select(*FACT_ORDER_ITEMS_COLUMNS)


def fact_order_items_late_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """all lines are streamed while only orders with an even id have landed; the
    other orders come later, without a new line. No line is lost."""
    raw, root = _setup(spark, sf_dir), landed_raw_root(spark, sf_dir)
    wh = Warehouse(scratch_dir(spark, "warehouse"))
    target, checkpoint = wh.mart("fact_order_items"), wh.checkpoint("fact_order_items")
    for landed in (raw.orders.where("order_id % 2 = 0"), raw.orders):
        orders = Models(spark, replace(raw, orders=landed)).stg_orders
        lines = stream_order_products(spark, root, max_files_per_trigger=16)
        refresh_on_new_lines(spark, lines, lambda orders=orders: orders, target, checkpoint, lambda landed=landed: landed)
    return spark.read.parquet(target).select(*FACT_ORDER_ITEMS_COLUMNS)


def load_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sources landed (reference tables as CSV, waves as
    partitions), raw tables set up, everything loaded; rows, and rows that carry a load
    time, of every raw table through the catalog."""
    raw = _setup(spark, sf_dir)
    landing = scratch_dir(spark, "landing")
    wh = Warehouse(scratch_dir(spark, "warehouse"))
    db = "cw_audit_" + wh.root.rstrip("/").rsplit("-", 1)[-1]
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    land_sources(spark, raw, landing)
    ingest(spark, landing, f"{wh.root}/raw", setup=db, full=True, wave=1)
    waves = _all_waves(spark, sf_dir)
    for c in contracts.WAVE_TABLES:
        load_waves(spark, read_waves(spark, f"{landing}/{c.name}", c), c, waves, wh.raw(c.name))
        spark.sql(f"ALTER TABLE {db}.{c.name} RECOVER PARTITIONS")
    for c in contracts.TABLES:
        spark.catalog.refreshTable(f"{db}.{c.name}")
    return reduce(DataFrame.unionByName, [
        spark.table(f"{db}.{c.name}").agg(F.count("*").alias("n_rows"), F.count("_loaded_at").alias("n_stamped"))
        .select(F.lit(c.name).alias("table_name"), "n_rows", "n_stamped") for c in contracts.TABLES])


def _failing(df: DataFrame, column: str) -> DataFrame:
    """``df`` with a bad record among its rows: one fails while it is written."""
    bad = F.raise_error(F.lit("bad record")).cast(df.schema[column].dataType)
    low = df.agg(F.min(column)).first()[0]
    return df.withColumn(column, F.when(F.col(column) == low, bad).otherwise(F.col(column)))


def _fails(load, why: str = "bad record") -> None:
    try:
        load()
    except Exception as e:  # noqa: BLE001 - any abort will do, as long as it is this one
        if why not in str(e):
            raise
    else:
        raise AssertionError("the load should have failed")


def reload_after_failed_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full refresh that meets a bad record midway leaves the table."""
    raw = _setup(spark, sf_dir)
    wh = Warehouse(scratch_dir(spark, "warehouse"))
    c = contracts.table("products")
    load_full(raw.products, c, wh.raw(c.name))
    _fails(lambda: load_full(_failing(raw.products, "product_id"), c, wh.raw(c.name)))
    return spark.read.parquet(wh.raw(c.name)).select(*c.column_names)


def wave_after_failed_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replacing one wave or several with a bad record among them leaves all
    waves as they were; rows per (table, wave)."""
    _setup(spark, sf_dir)
    root = landed_raw_root(spark, sf_dir)
    wh = Warehouse(scratch_dir(spark, "warehouse"))
    waves = _all_waves(spark, sf_dir)
    for c in contracts.WAVE_TABLES:
        rows = read_waves(spark, f"{root}/{c.name}", c)
        load_waves(spark, rows, c, waves, wh.raw(c.name))
        bad = _failing(rows, "order_id")
        first = bad.where("order_number = 1")
        _fails(lambda c=c, first=first: load_wave(spark, _failing(first.select(*c.column_names), "order_id"), c, 1,
                                                  wh.raw(c.name)))
        _fails(lambda c=c, bad=bad: load_waves(spark, bad, c, waves, wh.raw(c.name)))
    return _wave_counts({c.name: read_loaded_wave_table(spark, wh.raw(c.name), c) for c in contracts.WAVE_TABLES})


def stg_off_products_ingested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed is pulled in two runs (the older half by time, then
    everything above the mark), landed, ingested, and staged from there."""
    raw = _setup(spark, sf_dir)
    wh = Warehouse(scratch_dir(spark, "warehouse"))
    landing = scratch_dir(spark, "feed-landing")
    feed = raw.off_products_raw
    mid = feed.agg(F.expr("(min(last_modified_t) + max(last_modified_t)) div 2")).first()[0]
    for part in (feed.where(F.col("last_modified_t") <= mid), feed):
        run_pull(spark, wh, part, landing, F.timestamp_seconds("last_modified_t"))
        ingest_json_arrays(spark, landing, wh.raw("off_products_raw"), wh.checkpoint("off_products_raw"))
    staged = Models(spark, read_raw(spark, wh)).stg_off_products
    return staged.withColumn("categories_tags", F.to_json("categories_tags"))


def feed_uncapped_pull(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A pull that ignores the mark of a loaded feed table takes every event,
    and what is landed is the whole feed."""
    raw = _setup(spark, sf_dir)
    wh = Warehouse(scratch_dir(spark, "warehouse"))
    first, again = scratch_dir(spark, "feed-landing"), scratch_dir(spark, "feed-landing")
    when = F.timestamp_seconds("last_modified_t")
    run_pull(spark, wh, raw.off_products_raw, first, when)
    ingest_json_arrays(spark, first, wh.raw("off_products_raw"), wh.checkpoint("off_products_raw"))
    run_pull(spark, wh, raw.off_products_raw, again, when, ignore_mark=True)
    pulled = Warehouse(scratch_dir(spark, "warehouse"))
    ingest_json_arrays(spark, again, pulled.raw("off_products_raw"), pulled.checkpoint("off_products_raw"))
    return spark.read.schema(contracts.FEED_RAW_SCHEMA).parquet(pulled.raw("off_products_raw")).select(
        F.variant_get("payload", "$.code", "string").alias("product_code"), "last_modified_t",
        F.col("feed_seq").alias("feed_pos"))


def csv_wave_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All waves landed as ``<table>_NNN.csv``; wave 1 loaded by the
    batch loader, all waves by the wave run's reader; every loaded line."""
    raw = _setup(spark, sf_dir)
    landing = scratch_dir(spark, "csv-waves")
    wh = Warehouse(scratch_dir(spark, "warehouse"))
    for c in contracts.FULL_TABLES:
        load_full(raw.table(c.name), c, wh.raw(c.name))
    for c in contracts.WAVE_TABLES:
        write_csv_waves(raw.table(c.name), f"{landing}/{c.name}", c)
    ingest(spark, landing, f"{wh.root}/raw", wave=1)
    run_wave(spark, wh, landing, sorted(csv_waves(spark, f"{landing}/orders", contracts.table("orders"))))
    return Models(spark, read_raw(spark, wh)).stg_order_products


def _awkward_texts(part: DataFrame) -> DataFrame:
    """Product names with blanks around, quotes, commas, line breaks, none at all."""
    name = (F.when(F.col("p_partkey") % 5 == 0, F.concat(F.lit("  "), "p_name", F.lit("\t ")))
            .when(F.col("p_partkey") % 5 == 1, F.concat(F.lit('"'), "p_name", F.lit('", "'), "p_brand", F.lit('"')))
            .when(F.col("p_partkey") % 5 == 2, F.concat("p_name", F.lit("\n"), "p_type", F.lit("\n\n,")))
            .when(F.col("p_partkey") % 5 == 3, F.concat(F.lit("\\"), "p_name", F.lit("\\\"\\"))))
    return part.select(F.col("p_partkey").cast("int").alias("aisle_id"), name.alias("aisle"))


def csv_text_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with blanks, quotes, separators, backslashes and line breaks."""
    configure(spark)
    c = replace(contracts.table("aisles"), multi_line=True)
    landing = scratch_dir(spark, "csv")
    write_contract_csv(_awkward_texts(read_table(spark, sf_dir, "part")), f"{landing}/texts", c)
    return read_contract_csv(spark, f"{landing}/texts", c)



# --- smoke queries and data tests on the built marts ---------------------------

_BUILT: dict[tuple[str, str], Warehouse] = {}


def built_marts(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The marts as tables, built once per application from the landed raw
    layer (the tests of the source warehouse run after the build, on tables)."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _BUILT:
        raw = _setup(spark, sf_dir)
        wh = Warehouse(scratch_dir(spark, "warehouse"))
        build_marts(spark, Models(spark, raw), wh)
        _BUILT[key] = wh
    return mart_tables(spark, _BUILT[key])


_REGISTERED: set[str] = set()


def _catalog_prefix(spark: SparkSession, sf_dir: str) -> str:
    """Databases of the built warehouse: ``<prefix>raw``, ``<prefix>marts``, ...
    (registered once per application)."""
    built_marts(spark, sf_dir)
    wh = _BUILT[(spark.sparkContext.applicationId, sf_dir.rstrip("/"))]
    prefix = "cw_" + wh.root.rstrip("/").rsplit("-", 1)[-1] + "_"
    if prefix not in _REGISTERED or not spark.catalog.tableExists(f"{prefix}marts.fact_order_items"):
        register_layers(spark, wh, prefix=prefix, raw_root=landed_raw_root(spark, sf_dir))
        _REGISTERED.add(prefix)
    return prefix


def fact_rows_per_wave(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the line fact per wave, in wave order (Spark SQL on the
    registered marts layer)."""
    p = _catalog_prefix(spark, sf_dir)
    return spark.sql(f"SELECT order_number, count(*) AS n_rows FROM {p}marts.fact_order_items "
                     f"GROUP BY order_number ORDER BY order_number")


def orphan_product_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact lines whose product key has no product dimension row."""
    marts = built_marts(spark, sf_dir)
    return orphan_count(marts["fact_order_items"], marts["dim_product"], "product_key")


def _dq_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    tables = dict(built_marts(spark, sf_dir))
    tables["lineitem"] = read_table(spark, sf_dir, "lineitem")
    return tables


# Extra unique-combination check on the source line table, which does repeat
# (order, part) pairs: the test must find them.
LINEITEM_UNIQUE_PAIR = quality.DataTest("unique_combination", "lineitem", ("l_orderkey", "l_partkey"))


def dq_tests(kind: str | None) -> list[quality.DataTest]:
    tests = [t for t in quality.MART_TESTS if kind is None or t.kind == kind]
    if kind == "unique_combination":
        tests.append(LINEITEM_UNIQUE_PAIR)
    return tests


def _dq_query(kind: str | None):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return quality.evaluate(dq_tests(kind), _dq_tables(spark, sf_dir))
    run.__name__ = f"dq_{kind or 'all'}"
    return run


dq_not_null = _dq_query("not_null")
dq_unique = _dq_query("unique")
dq_relationships = _dq_query("relationships")
dq_accepted_values = _dq_query("accepted_values")
dq_unique_combination = _dq_query("unique_combination")
dq_all_mart_tests = _dq_query(None)


# Tests that do fail on the data (F10): the same operators, non-zero counts.
FAILING_TESTS = (
    quality.DataTest("not_null", "fact_orders", ("basket_size",)),
    quality.DataTest("unique", "lineitem", ("l_orderkey",)),
    quality.DataTest("relationships", "lineitem", ("l_orderkey",), "fact_orders", "order_id"),
    quality.DataTest("accepted_values", "raw_orders", ("eval_set",), values=("prior", "train")),
    LINEITEM_UNIQUE_PAIR,
)


def dq_failing_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1-Q5 on inputs that fail: itemless orders, repeated and unloaded orders'
    lines, test orders, repeated (order, part) pairs."""
    tables = _dq_tables(spark, sf_dir)
    tables["raw_orders"] = _setup(spark, sf_dir).orders
    return quality.evaluate(FAILING_TESTS, tables)


def orphan_line_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source lines whose order is not among the fact's orders."""
    marts = built_marts(spark, sf_dir)
    return orphan_count(read_table(spark, sf_dir, "lineitem"), marts["fact_orders"], "l_orderkey", "order_id")


def dim_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The time dimension with the number of orders of each hour (J5 pairs
    without an order included)."""
    m = Models(spark, _setup(spark, sf_dir))
    per_hour = m.fact_orders.groupBy("time_key").agg(F.count("*").alias("n"))
    return m.dim_time.join(per_hour, "time_key", "left").select(
        *m.dim_time.columns, F.coalesce("n", F.lit(0)).alias("n_orders"))


def orders_by_day_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M11 in use: completed orders per day name, weekend flag and day part."""
    m = Models(spark, _setup(spark, sf_dir))
    return (m.fact_orders.join(m.dim_time, "time_key")
            .groupBy("day_name", "is_weekend", "day_part").agg(F.count("*").alias("n_orders")))


STAGING_VIEWS = ("stg_aisles", "stg_departments", "stg_products", "stg_orders", "stg_order_products", "stg_off_products")


def staging_sql_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All six staging views, and the metrics view, through Spark SQL: rows,
    and a sum over a key of each."""
    p = _catalog_prefix(spark, sf_dir)
    keys = ("aisle_id", "department_id", "product_id", "order_id", "order_id * product_id", "last_modified_t")
    parts = [f"SELECT '{v}' AS view_name, count(*) AS n_rows, CAST(sum(CAST({k} AS DECIMAL(38,0))) AS STRING) AS checksum "
             f"FROM {p}staging.{v}" for v, k in zip(STAGING_VIEWS, keys)]
    parts.append("SELECT 'int_user_metrics', count(*), CAST(sum(CAST(round(reorder_ratio * 10000) AS DECIMAL(38,0)) "
                 f"+ total_items_purchased) AS STRING) FROM {p}intermediate.int_user_metrics")
    return spark.sql(" UNION ALL ".join(parts))
