"""Ingestion contracts (N1, N2) and their validation (Q7).

A table contract fixes the ordered column list, the load mode and, for wave
tables, the column a wave is identified by. The schema handed to every reader
comes from here; nothing is inferred.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

from cartwright import fixed

# Contract type name -> Spark type. ``numeric`` without precision is (38, 0).
TYPE_MAP = {
    "integer": T.IntegerType(),
    "bigint": T.LongType(),
    "text": T.StringType(),
    "numeric": T.DecimalType(38, 0),
    "number": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
}


@dataclass(frozen=True)
class Column:
    name: str
    type: str


@dataclass(frozen=True)
class TableContract:
    name: str
    load_mode: str  # "full" or "wave"
    columns: tuple[Column, ...]
    source_file: str | None = None
    wave_dir: str | None = None
    wave_column: str | None = None
    multi_line: bool = False  # text fields may hold line breaks

    @property
    def column_names(self) -> list[str]:
        return [c.name for c in self.columns]

    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, TYPE_MAP[c.type], True) for c in self.columns])

    def validate(self) -> None:
        """Q7: the loader relies on these invariants."""
        if self.load_mode not in ("full", "wave"):
            raise ValueError(f"{self.name}: load_mode must be full or wave, got {self.load_mode!r}")
        if not self.columns:
            raise ValueError(f"{self.name}: no columns")
        for c in self.columns:
            if not c.name or c.type not in TYPE_MAP:
                raise ValueError(f"{self.name}: bad column {c}")
        if self.load_mode == "full":
            if not (self.source_file or "").endswith(".csv"):
                raise ValueError(f"{self.name}: full load needs a .csv source_file")
        else:
            if not self.wave_dir:
                raise ValueError(f"{self.name}: wave load needs wave_dir")
            if self.wave_column not in self.column_names:
                raise ValueError(f"{self.name}: wave_column {self.wave_column!r} is not a column")


def _cols(*pairs: tuple[str, str]) -> tuple[Column, ...]:
    return tuple(Column(n, t) for n, t in pairs)


# --- fixed values: the ingestion contract ------------------------------------
_LINE_COLUMNS = _cols(("order_id", "bigint"), ("product_id", "integer"), ("add_to_cart_order", "integer"),
                      ("reordered", "integer"), ("order_number", "integer"))

# The batch ingestion contract.
TABLES: tuple[TableContract, ...] = (
    TableContract("aisles", "full", _cols(("aisle_id", "integer"), ("aisle", "text")), source_file="aisles.csv"),
    TableContract("departments", "full", _cols(("department_id", "integer"), ("department", "text")),
                  source_file="departments.csv"),
    TableContract("products", "full",
                  _cols(("product_id", "integer"), ("product_name", "text"), ("aisle_id", "integer"),
                        ("department_id", "integer")), source_file="products.csv"),
    TableContract("orders", "wave",
                  _cols(("order_id", "bigint"), ("user_id", "bigint"), ("eval_set", "text"),
                        ("order_number", "integer"), ("order_dow", "integer"), ("order_hour_of_day", "integer"),
                        ("days_since_prior_order", "numeric")),
                  wave_dir="waves/orders", wave_column="order_number"),
    TableContract("order_products_prior", "wave", _LINE_COLUMNS, wave_dir="waves/order_products_prior",
                  wave_column="order_number"),
    TableContract("order_products_train", "wave", _LINE_COLUMNS, wave_dir="waves/order_products_train",
                  wave_column="order_number"),
)
# --- end of fixed values ------------------------------------------------------

TABLES_BY_NAME = {t.name: t for t in TABLES}
FULL_TABLES = [t for t in TABLES if t.load_mode == "full"]
WAVE_TABLES = [t for t in TABLES if t.load_mode == "wave"]
LINE_TABLES = ["order_products_prior", "order_products_train"]


def table(name: str) -> TableContract:
    return TABLES_BY_NAME[name]


@dataclass(frozen=True)
class FeedContract:
    """The product-feed contract (newest-first pages above a high-water mark)."""

    name: str = "off_products"
    page_size: int = fixed.FEED_PAGE_SIZE
    max_pages: int = fixed.FEED_MAX_PAGES
    sort_by: str = fixed.FEED_WATERMARK_FIELD
    watermark_field: str = fixed.FEED_WATERMARK_FIELD
    fields: tuple[str, ...] = field(default_factory=lambda: tuple(fixed.FEED_FIELDS))
    landing_prefix: str = "raw/off_products_api"
    raw_table: str = "off_products_raw"

    @property
    def cap(self) -> int:
        return self.page_size * self.max_pages

    def validate(self) -> None:
        if not 0 < self.page_size <= fixed.FEED_PAGE_SIZE:
            raise ValueError(f"page_size must be in 1..{fixed.FEED_PAGE_SIZE}")
        if self.max_pages < 1:
            raise ValueError("max_pages must be >= 1")
        if self.watermark_field not in self.fields:
            raise ValueError("watermark_field must be one of the extracted fields")
        if self.sort_by != self.watermark_field:
            raise ValueError("the feed must be sorted by its watermark field")
        if not self.landing_prefix.startswith("raw/"):
            raise ValueError("landing_prefix must sit under raw/")


# Raw table of the product feed: whole product object kept as VARIANT.
FEED_RAW_SCHEMA = T.StructType([
    T.StructField("payload", T.VariantType(), True),
    T.StructField("last_modified_t", T.LongType(), True),
    T.StructField("feed_seq", T.LongType(), True),
    T.StructField("_loaded_at", T.TimestampType(), True),
])


def validate_all() -> None:
    for t in TABLES:
        t.validate()
    FeedContract().validate()
