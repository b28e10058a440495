"""Intermediate models M7, M8.

Both are hash aggregates: Spark plans a partial aggregate before the shuffle,
so a hot order or user contributes one row per map task to the exchange.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwright.functions.scalars import ratio_or_null, round_avg


def int_order_metrics(order_products: DataFrame) -> DataFrame:
    """M7 (E1-E3): one row per order that has lines. Reused by M8 and M13, so
    pipelines materialise it (B9)."""
    return order_products.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("basket_size"),
        F.sum("reordered").cast("long").alias("num_reordered"),
        round_avg("reordered", 4).alias("reorder_ratio"),
    )


def int_user_metrics(orders: DataFrame, order_metrics: DataFrame) -> DataFrame:
    """M8 (J3, E4-E8): per user over completed orders; users whose orders have
    no lines keep NULL totals (not 0)."""
    joined = orders.select("order_id", "user_id", "days_since_prior_order").join(
        order_metrics.select("order_id", "basket_size", "num_reordered"), "order_id", "left")
    return joined.groupBy("user_id").agg(
        F.count_distinct("order_id").alias("total_orders"),
        round_avg("days_since_prior_order", 2).alias("avg_days_between_orders"),
        F.sum("basket_size").alias("total_items_purchased"),
        round_avg("basket_size", 2).alias("avg_basket_size"),
        ratio_or_null(F.sum("num_reordered"), F.sum("basket_size"), 4).alias("reorder_ratio"),
    )
