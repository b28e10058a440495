"""Catalog queries on tables that are kept up to date: killed swaps, audits before
publishing, incremental tests, the key index, bad records and changed schemas.

As in :mod:`cartwright_catalog.scenarios`, each writes through a fresh folder and returns
what a user would read afterwards.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cartwright import contracts
from cartwright.operators import quality
from cartwright.operators.incremental import SchemaChangeError, delete_insert
from cartwright.plans.maintained import LatestProducts, UserTotals
from cartwright.plans.marts import FACT_ORDER_ITEMS_COLUMNS, dim_food_product, dim_user
from cartwright.plans.models import Models
from cartwright.plans.pipelines import FACT_KEY, FACT_PARTITION, Warehouse, read_raw, refresh_fact_order_items, run_wave
from cartwright.session import list_names, make_folder, move, remove, scratch_dir, write_pending, write_pending_partitions
from cartwright.sinks.load_ledger import ingest_with_history, read_history
from cartwright.sinks.loads import load_full, load_waves, partitions_of, read_waves, write_waves
from cartwright.sources.csv import read_contract_csv, write_contract_csv
from cartwright.sources.pull_ledger import PullLedger
from cartwright.streaming.json_ingest import ingest_json_arrays
from cartwright.streaming.stateful_fact import refresh_stateful
from cartwright_catalog.driver_tables import read_table
from cartwright_catalog.landed import landed_raw_root
from cartwright_catalog.scenarios import _all_waves, _fails, _land_feed, _loaded, _setup, built_marts



# --- a process that stops while it replaces a table (B5, B6, B9) --------------------

def wave_after_killed_swap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The process stops at four points of replacing waves of the prior lines, each
    time with complete new content (every second product): before the commit (wave 1
    stays), between the two renames (wave 2 is new), with an earlier swap's leftovers
    (wave 3 is new), and midway through a swap of several partitions (waves 4 and 5 are
    new, wave 6 is gone). What the next reader finds."""
    _setup(spark, sf_dir)
    c = contracts.table("order_products_prior")
    lines = read_waves(spark, f"{landed_raw_root(spark, sf_dir)}/{c.name}", c)
    target = scratch_dir(spark, "killed") + f"/{c.name}"
    load_waves(spark, lines, c, _all_waves(spark, sf_dir), target)
    half = lines.where(F.col("product_id") % 2 == 0).withColumn("_loaded_at", F.current_timestamp())

    def folder(wave: int, prefix: str = "") -> str:
        return f"{target}/{prefix}{c.wave_column}={wave}"

    def pending(wave: int) -> str:
        return write_pending(half.where(F.col("order_number") == wave).drop(c.wave_column), folder(wave)).path

    pending(1)
    move(spark, pending(2), folder(2, ".ready-"))
    move(spark, folder(2), folder(2, ".old-"))
    move(spark, folder(3), folder(3, ".old-"))
    move(spark, pending(3), folder(3))
    move(spark, write_pending(half.where(F.col("order_number") == 3).drop(c.wave_column), folder(3)).path, folder(3, ".ready-"))
    several = write_pending_partitions(half.where(F.col("order_number").isin(4, 5)), target, c.wave_column, [4, 5, 6])
    move(spark, several.path, f"{target}/.ready-partitions")
    remove(spark, folder(4))
    if f"{c.wave_column}=4" in list_names(spark, f"{target}/.ready-partitions"):
        move(spark, f"{target}/.ready-partitions/{c.wave_column}=4", folder(4))
    remove(spark, folder(5))
    return read_waves(spark, target, c)


# --- tests before publishing (Q6) -----------------------------------------------------

def audit_before_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q6: all waves are loaded and published; then wave 2 comes again with lines that no
    test should pass (flags that are not 0 or 1, products that do not exist). The run
    fails, and the line fact, the order fact and the users are those of before."""
    raw, root = _setup(spark, sf_dir), landed_raw_root(spark, sf_dir)
    wh = Warehouse(scratch_dir(spark, "warehouse"))
    for c in contracts.FULL_TABLES:
        load_full(raw.table(c.name), c, wh.raw(c.name))
    waves = _all_waves(spark, sf_dir)
    run_wave(spark, wh, root, [w for w in waves if w <= 4])
    run_wave(spark, wh, root, [w for w in waves if w > 4])
    bad = scratch_dir(spark, "bad-waves")
    for c in contracts.WAVE_TABLES:
        rows = read_waves(spark, f"{root}/{c.name}", c).where(F.col("order_number") == 2)
        if c.name in contracts.LINE_TABLES:
            rows = rows.withColumn("reordered", F.when(F.col("product_id") % 3 == 0, 7).otherwise(F.col("reordered"))).withColumn(
                "product_id", F.when(F.col("product_id") % 5 == 0, -F.col("product_id")).otherwise(F.col("product_id")))
        load_waves(spark, rows.select(*c.column_names), c, [2], f"{bad}/{c.name}")
    try:
        run_wave(spark, wh, bad, [2], replace_waves=True)
    except quality.DataQualityError as e:
        failed = {name for name, _ in e.failures}
        expected = {"accepted_values_fact_order_items_reordered", "relationships_fact_order_items_product_key__dim_product"}
        if failed != expected:
            raise
    else:
        raise AssertionError("the bad wave should have failed its tests")
    items, orders, users = (spark.read.parquet(wh.mart(n)) for n in ("fact_order_items", "fact_orders", "dim_user"))
    return (items.join(orders.select("order_id", "basket_size"), "order_id")
            .join(users.select("user_key", "total_items_purchased"), "user_key")
            .select(*FACT_ORDER_ITEMS_COLUMNS, "basket_size", "total_items_purchased"))


# --- tests that read new waves only (Q2, Q5) ---------------------------------------------

FACT_TESTS = tuple(t for t in quality.MART_TESTS if t.model == "fact_order_items")


def dq_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1-Q5 on the line fact after each of four changes, from what is kept per wave:
    waves 1 to 3; all waves; wave 2 with flags, products and (order, product) pairs that
    fail; wave 3 holding lines of wave 4 once more. Each time only changed waves are read."""
    marts = dict(built_marts(spark, sf_dir))
    fact = marts["fact_order_items"].select(*FACT_ORDER_ITEMS_COLUMNS)
    target = scratch_dir(spark, "incremental") + "/fact_order_items"
    waves = _all_waves(spark, sf_dir)
    bad = fact.where(F.col("order_number") == 2).withColumn("reordered", F.when(F.col("product_id") % 3 == 0, 7).otherwise(F.col("reordered")))
    bad = bad.withColumn("product_key", F.when(F.col("product_id") % 5 == 0, F.lit("nowhere")).when(F.col("product_id") % 7 != 0, F.col("product_key")))
    bad = bad.unionByName(fact.where((F.col("order_number") == 2) & (F.col("product_id") % 4 == 0)))
    twice = fact.where(F.col("order_number") == 3).unionByName(fact.where((F.col("order_number") == 4) & (F.col("product_id") % 2 == 0)).withColumn("order_number", F.lit(3)))
    steps = [(fact.where(F.col("order_number") <= 3), [1, 2, 3]), (fact.where(F.col("order_number") > 3), [w for w in waves if w > 3]), (bad, [2]), (twice, [3])]
    out = []
    for i, (rows, changed) in enumerate(steps):
        write_pending_partitions(rows, target, FACT_PARTITION, changed, FACT_KEY[0], balance=False).publish()
        results = quality.evaluate_incremental(spark, FACT_TESTS, marts, target, FACT_PARTITION)
        out.append(spark.createDataFrame(results.withColumn("step", F.lit(i + 1)).collect(), results.schema.add("step", "integer")))
    return reduce(DataFrame.unionByName, out)


def dq_incremental_sql(models, select) -> str:
    """Each step's table spelt out, and the tests' own SQL on it."""
    bad = """
SELECT * REPLACE (CASE WHEN product_id % 3 = 0 THEN 7 ELSE reordered END AS reordered,
                  CASE WHEN product_id % 5 = 0 THEN 'nowhere' WHEN product_id % 7 <> 0 THEN product_key END AS product_key)
FROM fact_order_items WHERE order_number = 2
UNION ALL FROM fact_order_items WHERE order_number = 2 AND product_id % 4 = 0"""
    rest = "FROM fact_order_items WHERE order_number <> 2"
    tables = ["FROM fact_order_items WHERE order_number <= 3", "FROM fact_order_items", f"{bad} UNION ALL {rest}",
              f"{bad} UNION ALL {rest} UNION ALL SELECT * REPLACE (CAST(3 AS INTEGER) AS order_number) "
              "FROM fact_order_items WHERE order_number = 4 AND product_id % 2 = 0"]
    parts, names = [], []
    for i, body in enumerate(tables, 1):
        names.append(f"step{i} AS ({body})")
        for t in FACT_TESTS:
            parts.append(f"SELECT *, {i} AS step FROM ({select(t).replace('FROM fact_order_items', f'FROM step{i}')})")
    return models("SELECT * FROM (WITH " + ", ".join(names) + " " + "\nUNION ALL\n".join(parts) + ")")


# --- tests that compare values of different types (Q1-Q4) ---------------------------------

MIXED_TESTS = (
    quality.DataTest("not_null", "lines", ("partner",)),
    quality.DataTest("unique", "lines", ("l_shipdate",)),
    quality.DataTest("accepted_values", "lines", ("l_linestatus",), values=("O", "F")),
    quality.DataTest("accepted_values", "lines", ("l_returnflag",), values=("A", "N")),
    quality.DataTest("accepted_values", "lines", ("l_linenumber",), values=(1, 2, 3, 4, 5, 6, 7)),
    quality.DataTest("accepted_values", "lines", ("l_quantity",), values=tuple(range(1, 51))),
    quality.DataTest("accepted_values", "lines", ("l_discount",), values=(0, 0.05)),
    quality.DataTest("accepted_values", "lines", ("whole",), values=(0, 1, 2.0, 2.5)),
    quality.DataTest("relationships", "lines", ("l_partkey",), "doubles", "part_number"),
    quality.DataTest("relationships", "lines", ("half_part",), "doubles", "part_number"),
    quality.DataTest("relationships", "lines", ("l_suppkey",), "doubles", "part_number"),
    quality.DataTest("relationships", "lines", ("l_orderkey",), "decimals", "order_number"),
    quality.DataTest("unique", "doubles", ("part_number",)),
    quality.DataTest("relationships", "doubles", ("part_number",), "lines", "l_partkey"),
    quality.DataTest("not_null", "decimals", ("order_number",)),
    quality.DataTest("unique", "decimals", ("order_number",)),
)
MIXED_SQL = """WITH lines AS (
  SELECT *, CASE WHEN l_linenumber > 5 THEN NULL ELSE l_suppkey END AS partner, l_linenumber % 4 AS whole,
         l_partkey / 2 AS half_part FROM lineitem),
doubles AS (SELECT CAST(p_partkey AS DOUBLE) AS part_number FROM part),
decimals AS (SELECT CAST(o_orderkey AS DECIMAL(20,0)) AS order_number FROM orders WHERE o_orderstatus <> 'O')
"""


def dq_mixed_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1-Q4: integer, double, decimal, text and time columns of one model tested
    together, keys compared across types; zero and non-zero counts of every kind."""
    lines = read_table(spark, sf_dir, "lineitem")
    tables = {
        "lines": lines.withColumns({"partner": F.when(F.col("l_linenumber") <= 5, F.col("l_suppkey")),
                                    "whole": F.col("l_linenumber") % 4, "half_part": F.col("l_partkey") / 2}),
        "doubles": read_table(spark, sf_dir, "part").select(F.col("p_partkey").cast("double").alias("part_number")),
        "decimals": read_table(spark, sf_dir, "orders").where("o_orderstatus <> 'O'").select(
            F.col("o_orderkey").cast("decimal(20,0)").alias("order_number")),
    }
    return quality.evaluate(MIXED_TESTS, tables)


# --- the key index (B10, J8, M14) ------------------------------------------------------------

def fact_order_items_moved_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys move between waves in batches that know nothing of where they were.
    Every third product's line of wave 1 turns up in wave 3 and every fifth one's in wave 4;
    then the index of the fact is lost, and lines of wave 5 move to wave 2; then one of its
    partitions falls behind, and lines of wave 3 move to wave 1."""
    wh = _loaded(spark, sf_dir)
    path = wh.mart("fact_order_items")
    index = wh.mart(".index-fact_order_items")
    fact = Models(spark, read_raw(spark, wh)).fact_order_items

    def apply(source: int, divisor: int, to: int) -> None:
        batch = fact.where((F.col("order_number") == source) & (F.col("product_id") % divisor == 0)).withColumn("order_number", F.lit(to))
        delete_insert(spark, batch, path, FACT_KEY, FACT_PARTITION, FACT_ORDER_ITEMS_COLUMNS)

    apply(1, 3, 3)
    apply(1, 5, 4)
    remove(spark, index)
    apply(5, 2, 2)
    for value, folder in partitions_of(spark, index, FACT_PARTITION).items():
        if value == "3":
            for sig in list_names(spark, folder):
                move(spark, f"{folder}/{sig}", f"{folder}/sig=behind")
    apply(3, 4, 1)
    return spark.read.parquet(path).select(*FACT_ORDER_ITEMS_COLUMNS)


MOVED = """
SELECT * REPLACE (CAST(CASE WHEN order_number = 1 AND product_id % 5 = 0 THEN 4 WHEN order_number = 1 AND product_id % 3 = 0 THEN 3
                            WHEN order_number = 5 AND product_id % 2 = 0 THEN 2
                            WHEN order_number = 3 AND product_id % 4 = 0 THEN 1 ELSE order_number END AS INTEGER) AS order_number)
FROM fact_order_items"""


# --- aborted loads (B11, B14) -------------------------------------------------------------------

def products_after_bad_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A landed CSV with one record whose number is text aborts the full refresh;
    the loaded products stay."""
    raw = _setup(spark, sf_dir)
    wh = Warehouse(scratch_dir(spark, "warehouse"))
    landing = scratch_dir(spark, "csv")
    c = contracts.table("products")
    write_contract_csv(raw.products, f"{landing}/good", c)
    load_full(read_contract_csv(spark, f"{landing}/good", c), c, wh.raw(c.name))
    low = raw.products.agg(F.min("product_id")).first()[0]
    text = F.when(F.col("product_id") == low, F.lit("twelve")).otherwise(F.col("aisle_id").cast("string"))
    raw.products.withColumn("aisle_id", text).select(*c.column_names).write.options(header=True).csv(f"{landing}/bad")
    _fails(lambda: load_full(read_contract_csv(spark, f"{landing}/bad", c), c, wh.raw(c.name)), "Malformed records")
    return spark.read.parquet(wh.raw(c.name)).select(*c.column_names)


def fact_after_schema_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches of wave 2 with a column more, a column less and another type fail;
    the fact stays as it was."""
    wh = _loaded(spark, sf_dir)
    path = wh.mart("fact_order_items")
    batch = Models(spark, read_raw(spark, wh)).fact_order_items.where(F.col("order_number") == 2).withColumn("reordered", F.lit(1))
    changed = [(batch.withColumn("discount", F.lit(0.1)), [*FACT_ORDER_ITEMS_COLUMNS, "discount"]),
               (batch, [c for c in FACT_ORDER_ITEMS_COLUMNS if c != "source"]),
               (batch.withColumn("reordered", F.lit("1")), FACT_ORDER_ITEMS_COLUMNS)]
    for rows, columns in changed:
        try:
            delete_insert(spark, rows, path, FACT_KEY, FACT_PARTITION, columns)
        except SchemaChangeError:
            continue
        raise AssertionError("the changed schema should have failed")
    refresh_fact_order_items(spark, Models(spark, read_raw(spark, wh)), wh)
    return spark.read.parquet(path).select(*FACT_ORDER_ITEMS_COLUMNS)


# --- models that follow their sources (M8, M10, W1, M12) -----------------------------------------

def dim_user_maintained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User totals are refreshed after waves 1 to 3, after all waves, and
    after corrections: waves 2 and 3 lose every third product, wave 4 all its lines, and
    lines of wave 5 lie in wave 6. Users come out as from a full build of what is there."""
    root = landed_raw_root(spark, sf_dir)
    wh = Warehouse(scratch_dir(spark, "warehouse"))
    raw_root = f"{wh.root}/raw"
    totals = UserTotals(spark, raw_root, wh.intermediate("user_totals"))
    waves = _all_waves(spark, sf_dir)
    for step in ([w for w in waves if w <= 3], [w for w in waves if w > 3]):
        for c in contracts.WAVE_TABLES:
            load_waves(spark, read_waves(spark, f"{root}/{c.name}", c), c, step, wh.raw(c.name))
        totals.refresh()
    for name in contracts.LINE_TABLES:
        c = contracts.table(name)
        lines = read_waves(spark, f"{root}/{name}", c)
        kept = lines.where("NOT (order_number IN (2, 3) AND product_id % 3 = 0) AND order_number <> 4")
        moved = kept.withColumn("order_number", F.expr("if(order_number = 5 AND product_id % 4 = 0, 6, order_number)"))
        load_waves(spark, moved.select(*c.column_names), c, [2, 3, 4, 5, 6], wh.raw(name))
    totals.refresh()
    return dim_user(totals.metrics())


DIM_USER_CORRECTED = """
SELECT md5(CAST(user_id AS VARCHAR)) AS user_key, user_id, total_orders, avg_days_between_orders, total_items_purchased,
       avg_basket_size, reorder_ratio
FROM (
  SELECT user_id, count(*) AS total_orders, {days} AS avg_days_between_orders, CAST(sum(n) AS BIGINT) AS total_items_purchased,
         {basket} AS avg_basket_size, {ratio} AS reorder_ratio
  FROM raw_orders LEFT JOIN (
    SELECT order_id, count(*) AS n, sum(reordered) AS r FROM raw_lines
    WHERE eval_set <> 'test' AND NOT (order_number IN (2, 3) AND product_id % 3 = 0) AND order_number <> 4 GROUP BY order_id)
  USING (order_id) WHERE eval_set <> 'test' GROUP BY user_id)"""


def dim_food_product_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product versions arrive in four loads that are merged one by one: every
    third event, the others in two loads (late old versions and ties among them), and the
    first load once more. Products come out as from a full dedup."""
    raw = _setup(spark, sf_dir)
    wh = Warehouse(scratch_dir(spark, "warehouse"))
    landing = scratch_dir(spark, "feed-landing")
    latest = LatestProducts(spark, wh.raw("off_products_raw"), wh.intermediate("latest_products"))
    feed = raw.off_products_raw
    for part in (2, 0, 1, 2):
        _land_feed(feed.where(F.col("feed_seq") % 3 == part), landing)
        ingest_json_arrays(spark, landing, wh.raw("off_products_raw"), wh.checkpoint("off_products_raw"))
        latest.refresh()
    return dim_food_product(latest.products())


# --- pulls and loads that are written down (A8, A9, B7) -------------------------------------------

def feed_resumed_pull(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Capped pulls, each of about a fifth of the feed. Two while only the older
    half is there, one that stops after its landing and before its commit, one that stops
    after its commit, then as many as it takes. Every event is in the raw table once."""
    raw = _setup(spark, sf_dir)
    wh = Warehouse(scratch_dir(spark, "warehouse"))
    landing = scratch_dir(spark, "feed-landing")
    feed = raw.off_products_raw
    mid, n = feed.agg(F.expr("(min(last_modified_t) + max(last_modified_t)) div 2"), F.count(F.lit(1))).first()
    contract = contracts.FeedContract(max_pages=n // 500 + 1)
    ledger = PullLedger(spark, wh.checkpoint("pulls"), landing)
    when = F.timestamp_seconds("last_modified_t")
    half = feed.where(F.col("last_modified_t") <= mid)
    for _ in range(2):
        ledger.pull(half, when, contract)

    def stop(*_) -> None:
        raise InterruptedError

    for step in ("_commit", "finish"):
        stopped = PullLedger(spark, ledger.path, landing)
        whole = getattr(stopped, step)
        calls = iter([whole, stop] if step == "finish" else [stop])
        setattr(stopped, step, lambda *a, calls=calls: next(calls)(*a))
        try:
            stopped.pull(feed, when, contract)
        except InterruptedError:
            continue
        raise AssertionError("the pull should have stopped")
    while ledger.pull(feed, when, contract):
        pass
    ingest_json_arrays(spark, landing, wh.raw("off_products_raw"), wh.checkpoint("off_products_raw"))
    return spark.read.schema(contracts.FEED_RAW_SCHEMA).parquet(wh.raw("off_products_raw")).select(
        F.variant_get("payload", "$.code", "string").alias("product_code"), "last_modified_t", F.col("feed_seq").alias("feed_pos"))


def append_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Odd events are landed and loaded, twice (the second load adds nothing). Then
    one file is rewritten at its path, the even events are landed, and the rows of a load
    that stopped before its entries lie in the table. Rows as loaded, with their load."""
    raw = _setup(spark, sf_dir)
    landing, root = scratch_dir(spark, "feed-landing"), scratch_dir(spark, "ledger")
    target, history = f"{root}/off_products_raw", f"{root}/history"
    feed = raw.off_products_raw
    rare = F.col("feed_seq") % 1000 == 1  # the file that will be rewritten

    def land(rows: DataFrame, name: str) -> None:
        folder = scratch_dir(spark, "one-file")
        numbered = rows.select(F.concat(F.lit('{"feed_seq":'), F.col("feed_seq"), F.lit(","), F.substr(F.to_json("payload"), F.lit(2))))
        numbered.coalesce(1).write.mode("overwrite").text(folder)
        file = next(n for n in list_names(spark, folder) if n.startswith("part-"))
        remove(spark, f"{landing}/dt=2024-01-01/{name}")
        move(spark, f"{folder}/{file}", f"{landing}/dt=2024-01-01/{name}")

    _land_feed(feed.where((F.col("feed_seq") % 2 == 1) & ~rare), landing)
    land(feed.where(rare), "products_1.txt")
    for _ in range(2):
        ingest_with_history(spark, landing, target, history)
    land(feed.where(rare & (F.col("feed_seq") % 3 == 0)), "products_1.txt")
    _land_feed(feed.where(F.col("feed_seq") % 2 == 0), landing)
    spark.read.schema(contracts.FEED_RAW_SCHEMA).parquet(f"{target}/load_id=1").limit(5).write.parquet(f"{target}/load_id=2")
    ingest_with_history(spark, landing, target, history)
    rows = spark.read.schema(StructType(list(contracts.FEED_RAW_SCHEMA.fields)).add("load_id", "integer")).parquet(target)
    loads = read_history(spark, history).groupBy("load_id").agg(F.sum("n_lines").alias("lines")).where("lines > 0")
    return rows.join(loads.select("load_id"), "load_id").select(
        F.variant_get("payload", "$.code", "string").alias("product_code"), "last_modified_t", F.col("feed_seq").alias("feed_pos"),
        "load_id")


APPENDED = """
SELECT code AS product_code, last_modified_t, event_id AS feed_pos, CAST(CASE WHEN event_id % 2 = 1 THEN 1 ELSE 2 END AS INTEGER) AS load_id
FROM raw_off
UNION ALL
SELECT code, last_modified_t, event_id, 2 FROM raw_off WHERE event_id % 1000 = 1 AND event_id % 3 = 0"""


# --- lines and orders as streams (K2) -----------------------------------------------------------------

def fact_order_items_stateful(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2: the lines of waves 1 to 3 land without an order; then the even orders; then all
    other orders, before the lines of wave 5 and later; then these, with the lines of wave
    4. Every line of a loaded order is in the fact once."""
    root = landed_raw_root(spark, sf_dir)
    wh = Warehouse(scratch_dir(spark, "warehouse"))
    folder = scratch_dir(spark, "streams")
    for c in contracts.WAVE_TABLES:
        make_folder(spark, f"{folder}/{c.name}")

    def land(name: str, where: str) -> None:
        c = contracts.table(name)
        write_waves(read_waves(spark, f"{root}/{name}", c).where(where), f"{folder}/{name}", mode="append")

    steps = [(contracts.LINE_TABLES, "order_number <= 3"), (["orders"], "order_id % 2 = 0"), (["orders"], "order_id % 2 = 1"),
             (contracts.LINE_TABLES, "order_number > 3")]
    for tables, where in steps:
        for name in tables:
            land(name, where)
        refresh_stateful(spark, folder, wh.mart("fact_order_items"), wh.checkpoint("stateful"))
    return spark.read.parquet(wh.mart("fact_order_items")).select(*FACT_ORDER_ITEMS_COLUMNS)
