"""Newest-first feed above a high-water mark."""
import json

import pytest
from pyspark.sql import functions as F

from cartwright.contracts import FeedContract
from cartwright.sources import feed as feed_src

SMALL = FeedContract(page_size=2, max_pages=3)  # a cap of 6


def _feed(spark, products):
    rows = [(json.dumps(p), i) for i, p in enumerate(products)]
    df = spark.createDataFrame(rows, "j string, seq long")
    return df.select(F.parse_json("j").alias("payload"), F.col("seq").alias("feed_seq"))


def _codes(df):
    return [r.code for r in df.select(F.variant_get("payload", "$.code", "string").alias("code")).collect()]


def seen(code, t=None):
    return {"code": code} | ({} if t is None else {"last_modified_t": t})


JARS = [seen("plum", 71), seen("fig", 64), seen("kiwi", 64), seen("lime", 30), seen("date", 12)]


def test_only_rows_above_the_mark(spark):
    assert _codes(feed_src.extract(_feed(spark, JARS), 30, tie_breaks=["feed_seq"])) == ["plum", "kiwi", "fig"]
    assert _codes(feed_src.extract(_feed(spark, JARS), 71)) == []
    assert len(_codes(feed_src.extract(_feed(spark, JARS), 0))) == 5


def test_all_rows_unless_a_cap_is_asked_for(spark):
    feed = _feed(spark, [seen(f"jar{i}", 5 + 3 * i) for i in range(17)])
    assert len(_codes(feed_src.extract(feed, 0, SMALL))) == 17
    assert len(_codes(feed_src.extract(feed, 0))) == 17
    assert _codes(feed_src.extract(feed, 0, SMALL, capped=True)) == [f"jar{i}" for i in range(16, 10, -1)]
    assert feed_src.left_behind(feed, 0, SMALL) == 11
    assert feed_src.left_behind(feed, 5 + 3 * 12, SMALL) == 0


def test_missing_timestamp_counts_as_zero(spark):
    feed = _feed(spark, [seen("undated"), seen("plum", 3)])
    assert _codes(feed_src.extract(feed, 0)) == ["plum"]
    assert _codes(feed_src.extract(feed, -1)) == ["plum", "undated"]


def test_numeric_text_is_a_timestamp(spark):
    assert _codes(feed_src.extract(_feed(spark, [seen("plum", "91"), seen("fig", "8")]), 10)) == ["plum"]


def test_tie_break_is_stable(spark):
    feed = _feed(spark, [seen("plum", 4), seen("fig", 4), seen("kiwi", 4)])
    assert _codes(feed_src.extract(feed, 0, tie_breaks=["feed_seq"])) == ["kiwi", "fig", "plum"]


def test_high_water_mark(spark, scratch):
    assert feed_src.read_high_water_mark(spark, f"{scratch}/missing") == 0
    df = spark.createDataFrame([(5,), (None,), (9,)], "last_modified_t long")
    assert feed_src.high_water_mark(df).first()["watermark"] == 9
    empty = spark.createDataFrame([], "last_modified_t long")
    assert feed_src.high_water_mark(empty).first()["watermark"] == 0
    df.write.parquet(f"{scratch}/t")
    assert feed_src.read_high_water_mark(spark, f"{scratch}/t") == 9


def test_bad_timestamp_aborts(spark):
    with pytest.raises(Exception):
        feed_src.extract(_feed(spark, [seen("plum", "noon")]), 0).collect()


def test_inclusive_mark_keeps_rows_of_the_same_second(spark):
    assert _codes(feed_src.extract(_feed(spark, JARS), 64, inclusive=True, tie_breaks=["feed_seq"])) == [
        "plum", "kiwi", "fig"]


def test_pull_marks_selects_and_lands(spark, scratch):
    from cartwright.contracts import FEED_RAW_SCHEMA
    from cartwright.plans.pipelines import Warehouse, run_pull
    from cartwright.streaming.json_ingest import ingest_json_arrays

    wh = Warehouse(f"{scratch}/wh")
    landing = f"{scratch}/landing"
    target = wh.raw("off_products_raw")

    def pull(products, **how):
        out = run_pull(spark, wh, _feed(spark, products), landing, F.lit("2024-03-05").cast("timestamp"), **how)
        return out, ingest_json_arrays(spark, landing, target, wh.checkpoint("feed"))

    assert pull(JARS[2:]) == ((0, 0), 3)
    assert pull(JARS) == ((64, 0), 1)  # fig shares the mark's second
    assert pull(JARS, ignore_mark=True) == ((0, 0), 5)
    assert pull([seen(f"jar{i}", 100 + i) for i in range(9)], capped=True, contract=SMALL) == ((71, 3), 6)
    rows = spark.read.schema(FEED_RAW_SCHEMA).parquet(target)
    assert rows.where("feed_seq IS NULL").count() == 0
    assert pull([]) == ((108, 0), 0)
