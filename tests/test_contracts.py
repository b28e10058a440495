"""Q7: contract shapes the loaders rely on (mirrors the source's config tests)."""
import dataclasses

import pytest
from pyspark.sql import types as T

from cartwright import contracts


def test_table_contracts_shape():
    contracts.validate_all()
    for t in contracts.TABLES:
        assert t.load_mode in ("full", "wave"), t.name
        assert t.columns, t.name
        if t.load_mode == "full":
            assert t.source_file.endswith(".csv")
        else:
            assert t.wave_dir
            assert t.wave_column in t.column_names


def test_contract_schema_types():
    orders = contracts.table("orders").schema()
    assert orders["order_id"].dataType == T.LongType()
    assert orders["order_number"].dataType == T.IntegerType()
    assert orders["days_since_prior_order"].dataType == T.DecimalType(38, 0)
    assert contracts.table("orders").column_names[-1] == "days_since_prior_order"


def test_wave_column_must_exist():
    bad = dataclasses.replace(contracts.table("orders"), wave_column="nope")
    with pytest.raises(ValueError):
        bad.validate()


def test_feed_contract():
    f = contracts.FeedContract()
    f.validate()
    assert 0 < f.page_size <= 100
    assert f.max_pages >= 1
    assert f.watermark_field in f.fields and f.sort_by == f.watermark_field
    assert f.landing_prefix.startswith("raw/")
    assert f.cap == 500
    with pytest.raises(ValueError):
        dataclasses.replace(f, page_size=101).validate()
    with pytest.raises(ValueError):
        dataclasses.replace(f, sort_by="code").validate()


def test_cluster_profile_keeps_explicit_settings(spark):
    from cartwright.session import CLUSTER_SETTINGS, configure
    old = {k: spark.conf.get(k) for k in CLUSTER_SETTINGS}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "128MB")  # Spark's default
        configure(spark, profile="cluster")
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "256m"
        assert spark.conf.get("spark.sql.shuffle.partitions") == "8"  # explicit test setting kept
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
        configure(spark)


def test_shuffles_are_sized_unless_the_session_says_otherwise(spark):
    from cartwright.session import SIZING, configure
    advisory, parts = SIZING
    old = {k: spark.conf.get(k, None) for k in SIZING}
    try:
        for k in SIZING:
            spark.conf.unset(k)
        configure(spark)
        assert {k: spark.conf.get(k) for k in SIZING} == SIZING
        spark.conf.set(advisory, "40m")
        configure(spark)
        assert spark.conf.get(advisory) == "40m"
        spark.conf.set(advisory, SIZING[advisory])
        configure(spark, profile="cluster")
        assert spark.conf.get(advisory) == "128m" and spark.conf.get(parts, None) is None
    finally:
        from cartwright.session import CLUSTER_SETTINGS
        for k in CLUSTER_SETTINGS:
            if k != "spark.sql.shuffle.partitions":
                spark.conf.unset(k)
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
        configure(spark)


def test_tables_are_written_with_zstd_unless_the_session_says_otherwise(spark):
    from cartwright.session import configure
    codec = "spark.sql.parquet.compression.codec"
    old = spark.conf.get(codec, None)
    try:
        spark.conf.unset(codec)
        assert configure(spark).conf.get(codec) == "zstd"
        spark.conf.set(codec, "gzip")
        assert configure(spark).conf.get(codec) == "gzip"
    finally:
        spark.conf.set(codec, old) if old else spark.conf.unset(codec)
