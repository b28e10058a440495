"""Incremental product feed: high-water mark (A9) and selection above it.

The feed is a DataFrame of product objects (``payload`` VARIANT), newest
first by the watermark field. Rows strictly newer than the watermark are
kept; a missing or NULL timestamp counts as 0, numeric strings are accepted,
anything else aborts (strict cast).

On a feed sorted newest-first the fresh rows are a prefix of the order, so
"page until the first stale row" equals "filter, then sort". A pull takes all of
them. The per-run cap (``page_size * max_pages``) is taken only when asked for:
the next mark is the newest loaded row, so rows a capped pull leaves behind are
not pulled again; :func:`left_behind` counts them for the caller, and
:mod:`cartwright.sources.pull_ledger` keeps such gaps open.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwright.contracts import FeedContract
from cartwright.functions.variant import variant_path
from cartwright.session import path_exists


WM = "_wm"


def watermark_value(feed: DataFrame, field: str = "last_modified_t") -> Column:
    """The watermark of each row: the column extracted at load time when the
    table has it, else the payload field; missing counts as 0."""
    src = F.col(field) if field in feed.columns else variant_path("payload", field, type_="bigint")
    return F.coalesce(src, F.lit(0))


def with_watermark(feed: DataFrame, field: str = "last_modified_t") -> DataFrame:
    """Project the watermark once, so filters and the top-k comparator read a
    plain bigint instead of re-parsing the payload per comparison."""
    return feed if WM in feed.columns else feed.withColumn(WM, watermark_value(feed, field))


def high_water_mark(raw: DataFrame, col: str = "last_modified_t") -> DataFrame:
    """``coalesce(max(t), 0)`` of a loaded raw table, as a one-row DataFrame."""
    return raw.agg(F.coalesce(F.max(col), F.lit(0)).cast("long").alias("watermark"))


def read_high_water_mark(spark: SparkSession, path: str, col: str = "last_modified_t") -> int:
    """The watermark of the raw table at ``path``; 0 only when the table does
    not exist yet (any other error propagates)."""
    if not path_exists(spark, path):
        return 0
    return int(high_water_mark(spark.read.schema(f"{col} long").parquet(path), col).first()["watermark"])


def above_watermark(feed: DataFrame, watermark: int | Column, field: str = "last_modified_t",
                    inclusive: bool = False) -> DataFrame:
    """Rows strictly newer than the watermark.

    ``inclusive=True`` also re-pulls rows of the watermark second itself, so
    a version modified in the same second as the last loaded one is not lost
    (the strict filter drops it); the repeats collapse in the latest-version
    dedup of the staging model.
    """
    wm = watermark if isinstance(watermark, Column) else F.lit(int(watermark))
    w = F.col(WM)
    return with_watermark(feed, field).where(w >= wm if inclusive else w > wm)


def newest_first(tie_breaks: list[str] | None = None) -> list[Column]:
    """Newest first, then the tie-break columns descending (a stable order)."""
    return [F.col(WM).desc()] + [F.col(c).desc() for c in (tie_breaks or [])]


def extract(feed: DataFrame, watermark: int, contract: FeedContract | None = None, capped: bool = False,
            tie_breaks: list[str] | None = None, inclusive: bool = False, ordered: bool = True) -> DataFrame:
    """One extractor run: all rows above the watermark, newest first; with
    ``capped`` only the first ``page_size * max_pages`` of them (G3, planned as
    TakeOrderedAndProject). ``ordered=False`` leaves an uncapped pull unsorted, for a
    landing, which does not keep the order but each row's feed position."""
    contract = contract or FeedContract()
    fresh = above_watermark(feed, watermark, contract.watermark_field, inclusive=inclusive)
    rows = fresh.orderBy(*newest_first(tie_breaks)) if ordered or capped else fresh
    return (rows.limit(contract.cap) if capped else rows).drop(WM)


def left_behind(feed: DataFrame, watermark: int, contract: FeedContract | None = None,
                inclusive: bool = False) -> int:
    """How many rows above the watermark a capped pull does not take."""
    contract = contract or FeedContract()
    return max(0, above_watermark(feed, watermark, contract.watermark_field, inclusive).count() - contract.cap)
