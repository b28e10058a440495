"""Marts M9-M14: a constellation of two facts and four dimensions.

Facts carry hash surrogate keys recomputed from the natural keys (J9), so no
fact ever joins a dimension to look its key up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwright import fixed
from cartwright.functions.keys import surrogate_key
from cartwright.functions.scalars import day_name, day_part, is_weekend


def dim_product(products: DataFrame, aisles: DataFrame, departments: DataFrame) -> DataFrame:
    """M9 (I1, J2): products with aisle and department names flattened in;
    names stay NULL when the code is unknown."""
    a = aisles.select("aisle_id", "aisle_name")
    d = departments.select("department_id", "department_name")
    return (products.join(a, "aisle_id", "left").join(d, "department_id", "left")
            .select(surrogate_key("product_id").alias("product_key"), "product_id", "product_name", "aisle_id",
                    "aisle_name", "department_id", "department_name"))


def dim_user(user_metrics: DataFrame) -> DataFrame:
    """M10 (I1)."""
    return user_metrics.select(surrogate_key("user_id").alias("user_key"), "user_id", "total_orders",
                               "avg_days_between_orders", "total_items_purchased", "avg_basket_size",
                               "reorder_ratio")


def time_spine(spark) -> DataFrame:
    """A7 + J5: every (day of week, hour of day) pair, 0-based.

    One ``range`` of 7 x 24 ids split by div/mod yields the same pairs as the
    cross join of two number series, without a cartesian product.
    """
    n = fixed.DAYS_PER_WEEK * fixed.HOURS_PER_DAY
    return spark.range(n).select(
        (F.col("id") / fixed.HOURS_PER_DAY).cast("int").alias("order_day_of_week"),
        (F.col("id") % fixed.HOURS_PER_DAY).cast("int").alias("order_hour_of_day"))


def dim_time(spark) -> DataFrame:
    """M11 (C9-C12, I1)."""
    s = time_spine(spark)
    return s.select(
        surrogate_key("order_day_of_week", "order_hour_of_day").alias("time_key"),
        "order_day_of_week",
        day_name("order_day_of_week").alias("day_name"),
        is_weekend("order_day_of_week").alias("is_weekend"),
        "order_hour_of_day",
        day_part("order_hour_of_day").alias("day_part"),
    )


def dim_food_product(off_products: DataFrame) -> DataFrame:
    """M12 (I1): the feed's product dimension (drops tags and raw epoch)."""
    return off_products.select(
        surrogate_key("product_code").alias("food_product_key"), "product_code", "product_name", "brands",
        *[out for _, out in fixed.NUTRIMENT_FIELDS], "last_modified_at")


def fact_orders(orders: DataFrame, order_metrics: DataFrame) -> DataFrame:
    """M13 (I1, J4): one row per completed order; itemless orders keep NULL measures."""
    return (orders.join(order_metrics, "order_id", "left")
            .select("order_id",
                    surrogate_key("user_id").alias("user_key"),
                    surrogate_key("order_day_of_week", "order_hour_of_day").alias("time_key"),
                    "order_number", "eval_set", "days_since_prior_order",
                    "basket_size", "num_reordered", "reorder_ratio"))


FACT_ORDER_ITEMS_COLUMNS = ["order_id", "product_id", "order_number", "add_to_cart_order", "reordered", "source",
                            "product_key", "user_key", "time_key"]


def fact_item_lines(order_products: DataFrame, orders: DataFrame) -> DataFrame:
    """Lines of completed orders with the natural keys of their dimensions.

    A hot order on the line side is split by AQE's skew-join handling; the
    order side is unique per order_id.
    """
    o = orders.select("order_id", "user_id", "order_day_of_week", "order_hour_of_day")
    return (order_products.join(o, "order_id", "inner")
            .select("order_id", "product_id", "order_number", "add_to_cart_order", "reordered", "source",
                    "user_id", "order_day_of_week", "order_hour_of_day"))


def with_item_keys(lines: DataFrame) -> DataFrame:
    """Three hash keys instead of the natural ones. 96 random characters a line, so
    writers add them behind their last shuffle."""
    return lines.select("order_id", "product_id", "order_number", "add_to_cart_order", "reordered", "source",
                        surrogate_key("product_id").alias("product_key"),
                        surrogate_key("user_id").alias("user_key"),
                        surrogate_key("order_day_of_week", "order_hour_of_day").alias("time_key"))


def fact_order_items(order_products: DataFrame, orders: DataFrame) -> DataFrame:
    """M14 full build."""
    return with_item_keys(fact_item_lines(order_products, orders))
