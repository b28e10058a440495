"""Adapter: the driver's TPC-H-like tables reshaped into the raw layer.

The raw layer normally arrives as landed CSV and JSON files. For tests and
benchmarks it is derived from ``orders``, ``lineitem``, ``part`` and
``events`` instead, all as Spark jobs over the whole tables:

* orders -> raw.orders: user = customer, wave (order_number) = position of
  the order in the customer's history, days since prior order from the
  previous order's date.
* lineitem -> raw.order_products_prior / _train: one line per (order, part),
  cart position, reordered flag (part bought in an earlier order of the same
  user); lines of ``test`` orders are not loaded.
* part -> raw.products / aisles / departments.
* events -> raw.off_products_raw: one product version per event, kept as a
  VARIANT payload.

The per-user and per-order numbering uses :mod:`cartwright_catalog.numbering`
so a single huge customer or order does not land in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartwright.raw import RawLayer
from cartwright_catalog import numbering
from cartwright_catalog.numbering import number_within_groups

DRIVER_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
                 "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

# --- fixed values: adapter mappings of the driver tables --------------------
# Order status -> eval set.
STATUS_TO_EVAL_SET = [("F", "prior"), ("O", "train")]
EVAL_SET_OTHER = "test"
# Part type -> aisle id; any other type (PROMO) is aisle 6.
TYPE_TO_AISLE = [("STANDARD", 1), ("ECONOMY", 2), ("MEDIUM", 3), ("SMALL", 4), ("LARGE", 5)]
AISLE_OTHER = 6
# Department id = the number after this brand prefix ("Brand#17" -> 17).
BRAND_PREFIX_LEN = len("Brand#")
# Feed payload: blank code for every 50th user; no brand for every 7th event;
# brand label = "B" + event_id mod 5.
BLANK_CODE_EVERY = 50
NO_BRAND_EVERY = 7
BRAND_MOD = 5
# --- end of fixed values ----------------------------------------------------


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _eval_set(status):
    expr = None
    for code, name in STATUS_TO_EVAL_SET:
        expr = F.when(status == code, name) if expr is None else expr.when(status == code, name)
    return expr.otherwise(EVAL_SET_OTHER)


def raw_orders(orders: DataFrame) -> DataFrame:
    """raw.orders in contract order and types."""
    base = orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        _eval_set(F.col("o_orderstatus")).alias("eval_set"),
        F.col("o_orderdate").alias("_odate"),
        (F.dayofweek("o_orderdate") - 1).cast("int").alias("order_dow"),
        (F.col("o_orderkey") % 24).cast("int").alias("order_hour_of_day"),
    )
    seq = number_within_groups(base, ["user_id"], ["_odate", "order_id"], rn_col="_rn",
                               lag_of={"_odate": "_prev_odate"})
    return seq.select(
        "order_id", "user_id", "eval_set",
        F.col("_rn").cast("int").alias("order_number"),
        "order_dow", "order_hour_of_day",
        F.datediff(F.col("_odate").cast("date"), F.col("_prev_odate").cast("date"))
        .cast("decimal(38,0)").alias("days_since_prior_order"),
    )


def raw_order_lines(lineitem: DataFrame, orders_raw: DataFrame) -> DataFrame:
    """All loaded order lines (prior + train) with an ``eval_set`` column.

    ``lineitem`` repeats (order, part) pairs, so it is first collapsed to one
    line per pair, keeping the smallest line number as the cart position key.
    """
    items = lineitem.select(F.col("l_orderkey").alias("order_id"), F.col("l_partkey").cast("int").alias("product_id"),
                            F.col("l_linenumber").alias("_ln"))
    numbered = number_within_groups(items, ["order_id"], ["_ln", "product_id"], rn_col="_cart",
                                    collapse=lambda rows: rows.groupBy("order_id", "product_id").agg(F.min("_ln").alias("_ln")))
    lines = numbered.join(orders_raw.select("order_id", "user_id", "order_number", "eval_set"), "order_id", "inner")
    lines = _with_first_number(lines, orders_raw)
    return (lines.where(F.col("eval_set").isin("prior", "train"))
            .select("order_id", "product_id",
                    F.col("_cart").cast("int").alias("add_to_cart_order"),
                    F.when(F.col("_first_number") < F.col("order_number"), 1).otherwise(0).cast("int")
                    .alias("reordered"),
                    "order_number", "eval_set"))


def _with_first_number(lines: DataFrame, orders_raw: DataFrame) -> DataFrame:
    """Add ``_first_number``, the order in which the line's user first bought its product;
    lines without a product are left out. A user has no more lines of a product than orders,
    so a window takes them in one task unless a history is longer than HOT_ROWS."""
    longest = orders_raw.agg(F.max("order_number")).first()[0]
    if longest is None or longest <= numbering.HOT_ROWS:
        w = Window.partitionBy("user_id", "product_id")
        return lines.dropna(subset=["user_id", "product_id"]).withColumn("_first_number", F.min("order_number").over(w))
    first = lines.groupBy("user_id", "product_id").agg(F.min("order_number").alias("_first_number"))
    return lines.join(first, ["user_id", "product_id"], "inner")


def _aisle_id():
    aisle = None
    for t, i in TYPE_TO_AISLE:
        aisle = F.when(F.col("p_type") == t, i) if aisle is None else aisle.when(F.col("p_type") == t, i)
    return aisle.otherwise(AISLE_OTHER).cast("int")


def _department_id():
    return F.substring("p_brand", BRAND_PREFIX_LEN + 1, 1 << 20).cast("int")


def raw_products(part: DataFrame) -> DataFrame:
    return part.select(
        F.col("p_partkey").cast("int").alias("product_id"),
        F.col("p_name").alias("product_name"),
        _aisle_id().alias("aisle_id"),
        _department_id().alias("department_id"),
    )


def raw_aisles(part: DataFrame) -> DataFrame:
    """One row per aisle id; the name is the part type (the smallest one when
    several types share the catch-all aisle)."""
    return part.groupBy(_aisle_id().alias("aisle_id")).agg(F.min("p_type").alias("aisle"))


def raw_departments(part: DataFrame) -> DataFrame:
    return part.groupBy(_department_id().alias("department_id")).agg(F.min("p_brand").alias("department"))


def feed_payloads(events: DataFrame) -> DataFrame:
    """events -> raw.off_products_raw rows (payload VARIANT, last_modified_t, lineage).

    ``feed_seq`` carries the event id: the source-side sequence that orders two
    versions of one product with the same modification second.
    """
    code = F.when(F.col("user_id") % BLANK_CODE_EVERY == 0, F.lit("")).otherwise(
        F.concat(F.lit("P"), F.col("user_id").cast("string")))
    brands = F.when(F.col("event_id") % NO_BRAND_EVERY == 0, F.lit(None).cast("string")).otherwise(
        F.concat(F.lit("B"), (F.col("event_id") % BRAND_MOD).cast("string")))
    t = F.unix_seconds(F.col("ts").cast("timestamp"))
    obj = F.struct(
        code.alias("code"),
        F.col("event_type").alias("product_name"),
        brands.alias("brands"),
        F.array("event_type").alias("categories_tags"),
        F.struct(F.col("value").alias("energy-kcal_100g"),
                 F.get_json_object("props", "$.k").cast("double").alias("fat_100g")).alias("nutriments"),
        t.alias("last_modified_t"),
    )
    return events.select(
        F.to_variant_object(obj).alias("payload"),
        t.alias("last_modified_t"),
        F.col("event_id").alias("feed_seq"),
        F.lit(None).cast("timestamp").alias("_loaded_at"),
    )


def raw_layer(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None, orders: DataFrame | None = None) -> RawLayer:
    """The raw layer; ``lines`` and ``orders`` replace what is derived here."""
    if orders is None:
        orders = raw_orders(read_table(spark, sf_dir, "orders"))
    if lines is None:
        lines = raw_order_lines(read_table(spark, sf_dir, "lineitem"), orders)
    cols = ["order_id", "product_id", "add_to_cart_order", "reordered", "order_number"]
    part = read_table(spark, sf_dir, "part")
    return RawLayer(
        orders=orders,
        order_products_prior=lines.where(F.col("eval_set") == "prior").select(*cols),
        order_products_train=lines.where(F.col("eval_set") == "train").select(*cols),
        products=raw_products(part),
        aisles=raw_aisles(part),
        departments=raw_departments(part),
        off_products_raw=feed_payloads(read_table(spark, sf_dir, "events")),
    )
