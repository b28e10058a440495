"""The raw layer: what the loaders write and the models read."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame


@dataclass
class RawLayer:
    """The raw tables as DataFrames (lazy plans)."""

    orders: DataFrame
    order_products_prior: DataFrame
    order_products_train: DataFrame
    products: DataFrame
    aisles: DataFrame
    departments: DataFrame
    off_products_raw: DataFrame

    def table(self, name: str) -> DataFrame:
        return getattr(self, name)
