"""Staging models M1-M6 (views over the raw layer).

Each function takes raw DataFrames and returns a DataFrame; nothing is
materialised here, so Catalyst prunes columns and pushes filters from the
consumers all the way into the raw scans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwright import fixed
from cartwright.functions.variant import variant_path


def stg_aisles(aisles: DataFrame) -> DataFrame:
    """M1 (C1)."""
    return aisles.select("aisle_id", F.col("aisle").alias("aisle_name"))


def stg_departments(departments: DataFrame) -> DataFrame:
    """M2 (C1)."""
    return departments.select("department_id", F.col("department").alias("department_name"))


def stg_products(products: DataFrame) -> DataFrame:
    """M3 (C1)."""
    return products.select("product_id", "product_name", "aisle_id", "department_id")


def stg_orders(orders: DataFrame) -> DataFrame:
    """M4 (C1, C4): completed orders only; ``test`` orders have no lines.

    ``days_since_prior_order`` is exposed as double: the raw contract stores
    it as numeric(38,0), the analytics downstream average it.
    """
    return (orders.where(F.col("eval_set").isin(*fixed.LOADED_EVAL_SETS))
            .select("order_id", "user_id", "eval_set", "order_number",
                    F.col("order_dow").alias("order_day_of_week"), "order_hour_of_day",
                    F.col("days_since_prior_order").cast("double").alias("days_since_prior_order")))


def stg_order_products(prior: DataFrame, train: DataFrame) -> DataFrame:
    """M5 (C2, U1): UNION ALL of both line sets with a constant source tag.

    A filter on ``source`` prunes the other branch at planning time.
    """
    cols = ["order_id", "product_id", "add_to_cart_order", "reordered", "order_number"]
    return (prior.select(*cols, F.lit("prior").alias("source"))
            .unionByName(train.select(*cols, F.lit("train").alias("source"))))


def parse_off_products(raw: DataFrame) -> DataFrame:
    """Typed columns out of the VARIANT payload (I2-I4, C5), before dedup.

    Only rows without a feed position need the payload's text, as a last tie-break. They
    are read apart, so that the scan of all others takes the payload's named fields only
    (a Parquet file without such rows is skipped by its null counts).
    """
    p = F.col("payload")
    cols = [
        variant_path(p, "code").alias("product_code"),
        variant_path(p, "product_name").alias("product_name"),
        variant_path(p, "brands").alias("brands"),
        variant_path(p, "categories_tags", type_="variant").alias("categories_tags"),
    ]
    cols += [variant_path(p, "nutriments", key, type_="double").alias(out) for key, out in fixed.NUTRIMENT_FIELDS]
    cols += [
        F.col("last_modified_t"),
        F.timestamp_seconds("last_modified_t").cast("timestamp_ntz").alias("last_modified_at"),
    ]
    seq = fixed.FEED_SEQUENCE_FIELD
    order = [F.col(c) for c in (seq, "_loaded_at") if c in raw.columns]

    def typed(rows: DataFrame, text: Column) -> DataFrame:
        return rows.select(*cols, *order, text.alias("_payload_text")).where(F.coalesce(F.col("product_code"), F.lit("")) != "")

    if seq not in raw.columns:
        return typed(raw, F.to_json(p))
    return typed(raw.where(F.col(seq).isNotNull()), F.lit(None).cast("string")).unionByName(
        typed(raw.where(F.col(seq).isNull()), F.to_json(p)))


def latest_version(df: DataFrame, key: str, order_col: str, tie_breaks: list[str]) -> DataFrame:
    """Keep one row per ``key``, the newest by ``order_col`` (NULL counts as
    newest, as in the source warehouse), then by the tie-break columns
    descending.

    ``row_number() = 1`` is planned as a partial ``WindowGroupLimit`` before the
    shuffle, so a hot key sends at most one row per map task across the network.
    """
    order = [F.col(order_col).desc_nulls_first()] + [F.col(c).desc_nulls_last() for c in tie_breaks]
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


OFF_PRODUCT_COLUMNS = ["product_code", "product_name", "brands", "categories_tags",
                       *[out for _, out in fixed.NUTRIMENT_FIELDS], "last_modified_t", "last_modified_at"]


def stg_off_products(off_products_raw: DataFrame) -> DataFrame:
    """M6: flatten the product payload, drop blank codes, keep the latest version per code.

    Versions of one second are ordered by feed position, then load time, then
    (rows without a position) the payload's text; what still ties is the same version.
    """
    parsed = parse_off_products(off_products_raw)
    ties = [c for c in (fixed.FEED_SEQUENCE_FIELD, "_loaded_at", "_payload_text") if c in parsed.columns]
    return latest_version(parsed, "product_code", "last_modified_t", ties).select(*OFF_PRODUCT_COLUMNS)
