"""The model graph (staging -> intermediate -> marts) over one raw layer.

``Models`` resolves each model lazily from the raw DataFrames, in the order
the model references imply. Nothing is written; pipelines decide what to
materialise.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from cartwright.plans import intermediate, marts, staging
from cartwright.raw import RawLayer


class Models:
    def __init__(self, spark: SparkSession, raw: RawLayer):
        self.spark = spark
        self.raw = raw

    # staging (views)
    @cached_property
    def stg_aisles(self) -> DataFrame:
        return staging.stg_aisles(self.raw.aisles)

    @cached_property
    def stg_departments(self) -> DataFrame:
        return staging.stg_departments(self.raw.departments)

    @cached_property
    def stg_products(self) -> DataFrame:
        return staging.stg_products(self.raw.products)

    @cached_property
    def stg_orders(self) -> DataFrame:
        return staging.stg_orders(self.raw.orders)

    @cached_property
    def stg_order_products(self) -> DataFrame:
        return staging.stg_order_products(self.raw.order_products_prior, self.raw.order_products_train)

    @cached_property
    def stg_off_products(self) -> DataFrame:
        return staging.stg_off_products(self.raw.off_products_raw)

    # intermediate
    @cached_property
    def int_order_metrics(self) -> DataFrame:
        return intermediate.int_order_metrics(self.stg_order_products)

    @cached_property
    def int_user_metrics(self) -> DataFrame:
        return intermediate.int_user_metrics(self.stg_orders, self.int_order_metrics)

    # marts
    @cached_property
    def dim_product(self) -> DataFrame:
        return marts.dim_product(self.stg_products, self.stg_aisles, self.stg_departments)

    @cached_property
    def dim_user(self) -> DataFrame:
        return marts.dim_user(self.int_user_metrics)

    @cached_property
    def dim_time(self) -> DataFrame:
        return marts.dim_time(self.spark)

    @cached_property
    def dim_food_product(self) -> DataFrame:
        return marts.dim_food_product(self.stg_off_products)

    @cached_property
    def fact_orders(self) -> DataFrame:
        return marts.fact_orders(self.stg_orders, self.int_order_metrics)

    @cached_property
    def fact_order_items(self) -> DataFrame:
        return marts.fact_order_items(self.stg_order_products, self.stg_orders)

    def get(self, name: str) -> DataFrame:
        return getattr(self, name)

    def use_materialized(self, name: str, table: DataFrame) -> None:
        """Let downstream models read ``name`` from its written table
        instead of recomputing it."""
        self.__dict__[name] = table


MODEL_NAMES = ["stg_aisles", "stg_departments", "stg_products", "stg_orders", "stg_order_products",
               "stg_off_products", "int_order_metrics", "int_user_metrics", "dim_product", "dim_user", "dim_time",
               "dim_food_product", "fact_orders", "fact_order_items"]
