"""The three runs of the warehouse (setup, one wave, product feed).

Each run is one Spark application; state passes between runs only through
tables under ``warehouse`` (raw/, marts/ folders). Layout:

    <warehouse>/raw/<table>/[order_number=N/]      raw tables (B4-B7)
    <warehouse>/raw/off_products_raw/             feed table (append-only)
    <warehouse>/intermediate/int_order_metrics/   reused aggregate (B9)
    <warehouse>/marts/<model>/                    marts (B9, B10)
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from cartwright import contracts, fixed
from cartwright.operators import quality
from cartwright.operators.incremental import (
    delete_insert, max_partition_value, stage_delete_insert, table_exists,
)
from cartwright.plans.marts import FACT_ORDER_ITEMS_COLUMNS, fact_item_lines, with_item_keys
from cartwright.plans.models import Models
from cartwright.plans.views import VIEWS
from cartwright.raw import RawLayer
from cartwright.session import Pending, path_exists, recover, write_and_swap, write_pending
from cartwright.sinks.feed_landing import land_json_arrays
from cartwright.sinks.loads import (
    create_raw_table, load_full, load_waves, partitions_of, read_landed, read_loaded_wave_table,
)
from cartwright.sources import feed as feed_source
from cartwright.sources.csv import read_contract_csv
from cartwright.streaming.json_ingest import ingest_json_arrays

MART_TABLES = ["dim_product", "dim_user", "dim_time", "dim_food_product", "fact_orders"]


@dataclass(frozen=True)
class Warehouse:
    root: str

    def raw(self, name: str) -> str:
        return f"{self.root}/raw/{name}"

    def mart(self, name: str) -> str:
        return f"{self.root}/marts/{name}"

    def intermediate(self, name: str) -> str:
        return f"{self.root}/intermediate/{name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.root}/_checkpoints/{name}"


def read_raw(spark: SparkSession, wh: Warehouse) -> RawLayer:
    """The loaded raw tables (without the audit column); a table not loaded
    yet reads as empty with its contract schema."""
    t = {}
    recover(spark, f"{wh.root}/raw")
    for c in contracts.TABLES:
        if not path_exists(spark, wh.raw(c.name)):
            t[c.name] = spark.createDataFrame([], c.schema())
        elif c.load_mode == "wave":
            t[c.name] = read_loaded_wave_table(spark, wh.raw(c.name), c).select(*c.column_names)
        else:
            t[c.name] = spark.read.parquet(wh.raw(c.name)).select(*c.column_names)
    feed = wh.raw("off_products_raw")
    t["off_products_raw"] = (spark.read.schema(contracts.FEED_RAW_SCHEMA).parquet(feed) if table_exists(spark, feed)
                             else spark.createDataFrame([], contracts.FEED_RAW_SCHEMA))
    return RawLayer(**t)


def run_setup(spark: SparkSession, wh: Warehouse, csv_landing: str, database: str | None = None) -> None:
    """Reference tables: full refresh from their landed CSVs (B5). With
    ``database``, all raw tables are created in it first if they do not exist (B4)."""
    if database is not None:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
        for c in contracts.TABLES:
            create_raw_table(spark, database, c, wh.raw(c.name))
    for c in contracts.FULL_TABLES:
        load_full(read_contract_csv(spark, f"{csv_landing}/{c.name}", c), c, wh.raw(c.name))


FACT_KEY, FACT_PARTITION = ["order_id", "product_id"], "order_number"


def _fact_batch(spark: SparkSession, m: Models, path: str, waves: list[int] | None) -> DataFrame | None:
    """The lines a refresh applies, with natural keys; None if nothing is new."""
    op = m.stg_order_products
    if waves is not None:
        lines = op.where(op.order_number.isin(list(waves)))
    else:
        lines = op.where(op.order_number > max_partition_value(spark, path, FACT_PARTITION))
        if lines.isEmpty():  # partition-pruned probe: nothing new
            return None
    return fact_item_lines(lines, m.stg_orders)


def refresh_fact_order_items(spark: SparkSession, m: Models, wh: Warehouse, waves: list[int] | None = None,
                             full: bool = False) -> int:
    """M14 incremental: lines with ``order_number`` above the target's maximum
    (0 for an empty or missing target), applied with delete+insert on
    (order_id, product_id).

    ``waves`` selects explicit waves instead (a corrected or out-of-order wave
    would never pass the ``> max`` filter): afterwards these waves hold exactly
    the lines that the raw tables hold for them, none if they hold none, and
    lines that moved into them are gone elsewhere. ``full`` rebuilds everything.
    """
    path = wh.mart("fact_order_items")
    if full:
        write_and_swap(fact_item_lines(m.stg_order_products, m.stg_orders), path, FACT_PARTITION, FACT_KEY[0], with_item_keys)
        return -1
    batch = _fact_batch(spark, m, path, waves)
    if batch is None:
        return 0
    return delete_insert(spark, batch, path, FACT_KEY, FACT_PARTITION, FACT_ORDER_ITEMS_COLUMNS, replace=waves, finish=with_item_keys)


@dataclass
class StagedMart:
    """New content of a mart that nothing reads yet. ``affected``: the partitions it
    replaces, None for the whole table."""

    name: str
    pending: Pending
    watch: quality.Watch
    affected: set[int] | None = None

    def rows(self, spark: SparkSession, schema: StructType) -> DataFrame:
        return spark.read.schema(schema).parquet(self.pending.path)


def stage_marts(spark: SparkSession, m: Models, wh: Warehouse, include_feed: bool = True, fact_waves: list[int] | None = None,
                threads: int = 4, full: bool = False, tests=()) -> list[StagedMart]:
    """B9, up to complete but hidden tables: the reused aggregate first, which the marts
    read, then the marts.

    The marts do not depend on each other, so their writes are submitted from
    ``threads`` driver threads at once (as the source builds independent
    models in parallel); each is its own Spark job sharing the executors. Tests that can
    be answered row by row are answered by the writes (``tests``).
    """
    staged: list[StagedMart] = []

    def table(name: str, df: DataFrame, target: str) -> None:
        watch = quality.Watch(name, tests)
        staged.append(StagedMart(name, write_pending(watch(df), target), watch))

    def fact() -> None:
        path = wh.mart("fact_order_items")
        if full or not partitions_of(spark, path, FACT_PARTITION):
            lines = m.stg_order_products
            if fact_waves is not None and not full:
                lines = lines.where(lines.order_number.isin(list(fact_waves)))
            watch = quality.Watch("fact_order_items", tests)
            pending = write_pending(fact_item_lines(lines, m.stg_orders), path, FACT_PARTITION, FACT_KEY[0],
                                    lambda rows: watch(with_item_keys(rows)))
            staged.append(StagedMart("fact_order_items", pending, watch))
            return
        batch = _fact_batch(spark, m, path, fact_waves)
        if batch is not None:
            pending, affected = stage_delete_insert(spark, batch, path, FACT_KEY, FACT_PARTITION, FACT_ORDER_ITEMS_COLUMNS,
                                                    replace=fact_waves, finish=with_item_keys)
            if pending is not None:
                staged.append(StagedMart("fact_order_items", pending, quality.Watch("fact_order_items", ()), affected))

    try:
        schema = m.int_order_metrics.schema
        table("int_order_metrics", m.int_order_metrics, wh.intermediate("int_order_metrics"))
        m.use_materialized("int_order_metrics", staged[0].rows(spark, schema))
        names = [n for n in MART_TABLES if include_feed or n != "dim_food_product"]
        tasks = [lambda n=n: table(n, m.get(n), wh.mart(n)) for n in names] + [fact]
        with ThreadPoolExecutor(max_workers=max(1, threads)) as pool:
            for f in [pool.submit(t) for t in tasks]:
                f.result()  # re-raise the first failure
    except BaseException:
        discard(staged)
        raise
    return staged


def discard(staged: list[StagedMart]) -> None:
    for s in staged:
        s.pending.discard()


def publish(staged: list[StagedMart]) -> None:
    for s in staged:
        s.pending.publish()


def audit(spark: SparkSession, m: Models, wh: Warehouse, staged: list[StagedMart],
          tests: tuple[quality.DataTest, ...] | list[quality.DataTest]) -> list[tuple[str, int]]:
    """Q6 before anything is published: the tests on the staged marts, and on published
    ones that are not staged. Tests that no row failed while it was written are not run
    again; the line fact is tested from what is kept per wave and the staged waves."""
    tables, passed = mart_tables(spark, wh), []
    fact = next((s for s in staged if s.name == "fact_order_items"), None)
    for s in staged:
        passed += s.watch.passed()
        schema = m.get(s.name).schema
        if s is fact:
            schema = StructType([schema[c] for c in FACT_ORDER_ITEMS_COLUMNS])
        tables[s.name] = s.rows(spark, schema)
    todo = [t for t in tests if t not in passed]
    results = []
    if "fact_order_items" in tables and (fact is None or fact.affected is not None):
        lines = [t for t in todo if t.model == "fact_order_items"]
        todo = [t for t in todo if t not in lines]
        rows, affected = (None, ()) if fact is None else (tables["fact_order_items"], fact.affected)
        if lines:
            results.append(quality.evaluate_incremental(spark, lines, tables, wh.mart("fact_order_items"), FACT_PARTITION,
                                                        rows, affected))
    if todo:
        results.append(quality.evaluate(todo, tables))
    done = quality.gate(reduce(DataFrame.unionByName, results)) if results else []
    return sorted(done + [(t.name, 0) for t in passed])


def build_marts(spark: SparkSession, m: Models, wh: Warehouse, include_feed: bool = True,
                fact_waves: list[int] | None = None, threads: int = 4, full: bool = False) -> None:
    """Every mart is replaced when the new content of all of them is complete."""
    publish(stage_marts(spark, m, wh, include_feed, fact_waves, threads, full))
    m.use_materialized("int_order_metrics", spark.read.parquet(wh.intermediate("int_order_metrics")))


def register_layers(spark: SparkSession, wh: Warehouse, prefix: str = "", raw_root: str | None = None) -> dict[str, str]:
    """One database per layer (``<prefix><layer>``) over the warehouse folders.

    Raw tables have their contract schema and the audit column (B4) whether they
    hold rows or not; written marts and the reused aggregate are external Parquet
    tables (wave-partitioned ones with their partitions recovered); the staging
    models and ``int_user_metrics`` are views (B8). The layers can be queried with
    Spark SQL, e.g. ``SELECT ... FROM marts.fact_orders``. Existing registrations
    are never dropped: a name that already points at another location is an error
    (pick another ``prefix``). Returns name -> location (or "view").
    """
    out = {}
    for layer in fixed.LAYERS:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {prefix}{layer} LOCATION '{wh.root}/{layer}'")

    def register(db: str, name: str, loc: str, schema, partitioned: bool) -> None:
        current = _location_of(spark, db, name)
        if current is not None and current.rstrip("/") != loc.replace("file:", "").rstrip("/"):
            raise ValueError(f"{db}.{name} is already registered at {current}; use another prefix")
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}"
                         + (" DEFAULT current_timestamp()" if f.name == "_loaded_at" else "") for f in schema.fields)
        part = " PARTITIONED BY (order_number)" if partitioned else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {db}.{name} ({cols}) USING parquet{part} LOCATION '{loc}'")
        if partitioned:
            spark.sql(f"ALTER TABLE {db}.{name} RECOVER PARTITIONS")
        spark.catalog.refreshTable(f"{db}.{name}")
        out[f"{db}.{name}"] = loc

    for c in contracts.TABLES:
        register(f"{prefix}raw", c.name, f"{raw_root or wh.root + '/raw'}/{c.name}",
                 c.schema().add("_loaded_at", "timestamp"), c.load_mode == "wave")
    register(f"{prefix}raw", "off_products_raw", f"{raw_root or wh.root + '/raw'}/off_products_raw",
             contracts.FEED_RAW_SCHEMA, False)
    for layer, names in (("intermediate", ["int_order_metrics"]), ("marts", MART_TABLES + ["fact_order_items"])):
        for name in names:
            loc = f"{wh.root}/{layer}/{name}"
            partitioned = name == "fact_order_items"
            if partitions_of(spark, loc, "order_number") if partitioned else path_exists(spark, loc):
                register(f"{prefix}{layer}", name, loc, spark.read.parquet(loc).schema, partitioned)
    for name, (layer, sql) in VIEWS.items():
        if "{intermediate}.int_order_metrics" in sql and f"{prefix}intermediate.int_order_metrics" not in out:
            continue
        db = f"{prefix}{layer}"
        spark.sql(f"CREATE OR REPLACE VIEW {db}.{name} AS " + sql.format(
            **{x: f"{prefix}{x}" for x in fixed.LAYERS}))
        out[f"{db}.{name}"] = "view"
    return out


def _location_of(spark: SparkSession, db: str, name: str) -> str | None:
    if not spark.catalog.tableExists(f"{db}.{name}"):
        return None
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {db}.{name}").where("col_name = 'Location'").collect()
    return rows[0].data_type.replace("file:", "") if rows else None


def mart_tables(spark: SparkSession, wh: Warehouse) -> dict[str, DataFrame]:
    recover(spark, f"{wh.root}/marts")
    out = {n: spark.read.parquet(wh.mart(n)) for n in MART_TABLES + ["fact_order_items"]
           if table_exists(spark, wh.mart(n))}
    return out


def run_gate(spark: SparkSession, wh: Warehouse, models: list[str] | None = None,
             skip: tuple[str, ...] = ()) -> list[tuple[str, int]]:
    """Q6 over the built marts: all tests, or those on ``models``, but those
    that touch a model in ``skip``. A model that a test needs and that is not built
    is an error, not a passed test."""
    tests = [t for t in quality.MART_TESTS if (models is None or t.model in models) and not {t.model, t.to_model} & set(skip)]
    return quality.gate(quality.evaluate(tests, mart_tables(spark, wh)))


def run_wave(spark: SparkSession, wh: Warehouse, landing: str, waves: list[int],
             replace_waves: bool = False, full: bool = False) -> list[tuple[str, int]]:
    """One (or several) waves: replace them in the raw wave tables, from
    ``<landing>/<table>/<table>_NNN.csv`` or Parquet partitions, rebuild the marts,
    advance the incremental fact (or, with ``replace_waves``, replace exactly these
    waves in it, or, with ``full``, rebuild it), and gate on the data tests. The marts are
    tested before they are published: if a test fails, all marts stay as they were. The
    feed's dimension is not part of a wave; it is left out until there is a feed."""
    landed = {c.name: read_landed(spark, f"{landing}/{c.name}", c, waves) for c in contracts.WAVE_TABLES}
    for c in contracts.WAVE_TABLES:
        load_waves(spark, landed[c.name], c, waves, wh.raw(c.name))
    m = Models(spark, read_raw(spark, wh))
    feed = table_exists(spark, wh.raw("off_products_raw"))
    tests = [t for t in quality.MART_TESTS if feed or "dim_food_product" not in (t.model, t.to_model)]
    staged = stage_marts(spark, m, wh, feed, list(waves) if replace_waves else None, full=full, tests=tests)
    return _audited(spark, m, wh, staged, tests)


def _audited(spark: SparkSession, m: Models, wh: Warehouse, staged: list[StagedMart],
             tests: list[quality.DataTest]) -> list[tuple[str, int]]:
    """Publish what passes its tests, and nothing otherwise."""
    try:
        results = audit(spark, m, wh, staged, tests)
    except BaseException:
        discard(staged)
        raise
    publish(staged)
    return results


def run_pull(spark: SparkSession, wh: Warehouse, feed: DataFrame, feed_landing: str, pulled_at,
             contract: contracts.FeedContract | None = None, ignore_mark: bool = False, capped: bool = False,
             order_col: str = fixed.FEED_SEQUENCE_FIELD) -> tuple[int, int]:
    """One extractor run (A8, A9, B3): mark, selection above it, dated landing.

    The mark is the newest product version in the raw feed table, 0 before the
    first load or with ``ignore_mark``. ``feed`` is the source as a DataFrame
    (``payload`` VARIANT and ``order_col``, its position there). Returns the mark and
    the number of rows that a ``capped`` pull left behind (0 otherwise).
    """
    mark = 0 if ignore_mark else feed_source.read_high_water_mark(spark, wh.raw("off_products_raw"))
    pulled = feed_source.extract(feed, mark, contract, capped=capped, tie_breaks=[order_col], ordered=False)
    land_json_arrays(pulled, feed_landing, pulled_at, order_col)
    return mark, feed_source.left_behind(feed, mark, contract) if capped else 0


def run_feed(spark: SparkSession, wh: Warehouse, feed_landing: str) -> list[tuple[str, int]]:
    """Product feed: ingest new landed files once (K1), build the feed dimension, publish it
    if it passes its tests."""
    ingest_json_arrays(spark, feed_landing, wh.raw("off_products_raw"), wh.checkpoint("off_products_raw"))
    m = Models(spark, read_raw(spark, wh))
    tests = [t for t in quality.MART_TESTS if t.model == "dim_food_product"]
    watch = quality.Watch("dim_food_product", tests)
    staged = [StagedMart("dim_food_product", write_pending(watch(m.dim_food_product), wh.mart("dim_food_product")), watch)]
    return _audited(spark, m, wh, staged, tests)
