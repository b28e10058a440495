"""The query catalog: one callable ``(spark, sf_dir) -> DataFrame`` per
operator / model of the warehouse, plus the DuckDB SQL that must give the
same rows. ``__spark_entry__`` exposes both.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwright.plans.models import Models
from cartwright.session import configure
from cartwright_catalog import oracle, scenarios, upkeep
from cartwright_catalog.landed import landed_raw_layer

QueryFn = Callable[[SparkSession, str], DataFrame]


def models(spark: SparkSession, sf_dir: str) -> Models:
    configure(spark)
    return Models(spark, landed_raw_layer(spark, sf_dir))


def _model_query(name: str) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return models(spark, sf_dir).get(name)
    run.__name__ = name
    return run


def q_stg_off_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M6; the VARIANT tag list is returned as its JSON text."""
    df = models(spark, sf_dir).stg_off_products
    return df.withColumn("categories_tags", F.to_json("categories_tags"))


QUERIES: dict[str, QueryFn] = {
    "stg_aisles": _model_query("stg_aisles"),
    "stg_departments": _model_query("stg_departments"),
    "stg_products": _model_query("stg_products"),
    "stg_orders": _model_query("stg_orders"),
    "stg_order_products": _model_query("stg_order_products"),
    "stg_off_products": q_stg_off_products,
    "int_order_metrics": _model_query("int_order_metrics"),
    "int_user_metrics": _model_query("int_user_metrics"),
    "dim_product": _model_query("dim_product"),
    "dim_user": _model_query("dim_user"),
    "dim_time": scenarios.dim_time,
    "dim_food_product": _model_query("dim_food_product"),
    "fact_orders": _model_query("fact_orders"),
    "fact_order_items_full": _model_query("fact_order_items"),
    "fact_order_items_incremental": scenarios.fact_order_items_incremental,
    "fact_order_items_streamed": scenarios.fact_order_items_streamed,
    "wave_split_counts": scenarios.wave_split_counts,
    "wave_reload_idempotent": scenarios.wave_reload_idempotent,
    "full_refresh": scenarios.full_refresh,
    "csv_roundtrip": scenarios.csv_roundtrip,
    "json_array_ingest": scenarios.json_array_ingest,
    "append_once": scenarios.append_once,
    "high_water_mark": scenarios.high_water_mark,
    "feed_above_watermark": scenarios.feed_above_watermark,
    "feed_capped_topn": scenarios.feed_capped_topn,
    "fact_rows_per_wave": scenarios.fact_rows_per_wave,
    "orphan_product_count": scenarios.orphan_product_count,
    "dq_not_null": scenarios.dq_not_null,
    "dq_unique": scenarios.dq_unique,
    "dq_relationships": scenarios.dq_relationships,
    "dq_accepted_values": scenarios.dq_accepted_values,
    "dq_unique_combination": scenarios.dq_unique_combination,
    "dq_all_mart_tests": scenarios.dq_all_mart_tests,
    "warehouse_run_gate": scenarios.warehouse_run_gate,
    "fact_order_items_corrected_wave": scenarios.fact_order_items_corrected_wave,
    "fact_order_items_rebuilt": scenarios.fact_order_items_rebuilt,
    "fact_order_items_late_orders": scenarios.fact_order_items_late_orders,
    "reload_after_failed_load": scenarios.reload_after_failed_load,
    "wave_after_failed_load": scenarios.wave_after_failed_load,
    "stg_off_products_ingested": scenarios.stg_off_products_ingested,
    "feed_uncapped_pull": scenarios.feed_uncapped_pull,
    "csv_wave_load": scenarios.csv_wave_load,
    "load_audit": scenarios.load_audit,
    "csv_text_roundtrip": scenarios.csv_text_roundtrip,
    "dq_failing_tests": scenarios.dq_failing_tests,
    "orphan_line_count": scenarios.orphan_line_count,
    "orders_by_day_part": scenarios.orders_by_day_part,
    "staging_sql_views": scenarios.staging_sql_views,
    "wave_after_killed_swap": upkeep.wave_after_killed_swap,
    "audit_before_publish": upkeep.audit_before_publish,
    "dq_incremental": upkeep.dq_incremental,
    "dq_mixed_types": upkeep.dq_mixed_types,
    "fact_order_items_moved_keys": upkeep.fact_order_items_moved_keys,
    "products_after_bad_csv": upkeep.products_after_bad_csv,
    "fact_after_schema_change": upkeep.fact_after_schema_change,
    "dim_user_maintained": upkeep.dim_user_maintained,
    "dim_food_product_merged": upkeep.dim_food_product_merged,
    "feed_resumed_pull": upkeep.feed_resumed_pull,
    "append_ledger": upkeep.append_ledger,
    "fact_order_items_stateful": upkeep.fact_order_items_stateful,
}

ORACLE: dict[str, str] = {
    "stg_aisles": oracle.with_models("SELECT * FROM stg_aisles"),
    "stg_departments": oracle.with_models("SELECT * FROM stg_departments"),
    "stg_products": oracle.with_models("SELECT * FROM stg_products"),
    "stg_orders": oracle.with_models("SELECT * FROM stg_orders"),
    "stg_order_products": oracle.with_models("SELECT * FROM stg_order_products"),
    "stg_off_products": oracle.with_models(
        "SELECT * REPLACE (to_json(categories_tags)::VARCHAR AS categories_tags) FROM stg_off_products"),
    "int_order_metrics": oracle.with_models("SELECT * FROM int_order_metrics"),
    "int_user_metrics": oracle.with_models("SELECT * FROM int_user_metrics"),
    "dim_product": oracle.with_models("SELECT * FROM dim_product"),
    "dim_user": oracle.with_models("SELECT * FROM dim_user"),
    "dim_time": oracle.with_models("""
SELECT t.*, count(f.order_id) AS n_orders FROM dim_time t LEFT JOIN fact_orders f ON f.time_key = t.time_key
GROUP BY ALL"""),
    "dim_food_product": oracle.with_models("SELECT * FROM dim_food_product"),
    "fact_orders": oracle.with_models("SELECT * FROM fact_orders"),
    "fact_order_items_full": oracle.with_models("SELECT * FROM fact_order_items"),
    **oracle.SCENARIOS,
    "fact_order_items_streamed": oracle.with_models("SELECT * FROM fact_order_items"),
    "fact_order_items_late_orders": oracle.with_models("SELECT * FROM fact_order_items"),
    "dq_failing_tests": oracle.dq_sql(scenarios.FAILING_TESTS),
    "dq_not_null": oracle.dq_sql(scenarios.dq_tests("not_null")),
    "dq_unique": oracle.dq_sql(scenarios.dq_tests("unique")),
    "dq_relationships": oracle.dq_sql(scenarios.dq_tests("relationships")),
    "dq_accepted_values": oracle.dq_sql(scenarios.dq_tests("accepted_values")),
    "dq_unique_combination": oracle.dq_sql(scenarios.dq_tests("unique_combination")),
    "dq_all_mart_tests": oracle.dq_sql(scenarios.dq_tests(None)),
    "warehouse_run_gate": oracle.dq_sql(scenarios.dq_tests(None)),
    "wave_after_killed_swap": oracle.with_models("""
SELECT * FROM raw_order_products_prior
WHERE order_number <> 6 AND (order_number NOT IN (2, 3, 4, 5) OR product_id % 2 = 0)"""),
    "audit_before_publish": oracle.with_models("""
SELECT f.*, o.basket_size, u.total_items_purchased FROM fact_order_items f
JOIN fact_orders o USING (order_id) JOIN dim_user u ON u.user_key = f.user_key"""),
    "dq_incremental": upkeep.dq_incremental_sql(oracle.with_models, oracle.dq_select),
    "dq_mixed_types": upkeep.MIXED_SQL + "\nUNION ALL\n".join(oracle.dq_select(t) for t in upkeep.MIXED_TESTS),
    "fact_order_items_moved_keys": oracle.with_models(upkeep.MOVED),
    "products_after_bad_csv": oracle.with_models("SELECT * FROM raw_products"),
    "fact_after_schema_change": oracle.with_models("SELECT * FROM fact_order_items"),
    "dim_user_maintained": oracle.with_models(upkeep.DIM_USER_CORRECTED.format(
        days=oracle.rounded_ratio("sum(days_since_prior_order)", "count(days_since_prior_order)", 2),
        basket=oracle.rounded_ratio("sum(n)", "count(n)", 2), ratio=oracle.rounded_ratio("sum(r)", "sum(n)", 4))),
    "dim_food_product_merged": oracle.with_models("SELECT * FROM dim_food_product"),
    "feed_resumed_pull": oracle.with_models(
        "SELECT code AS product_code, last_modified_t, event_id AS feed_pos FROM raw_off WHERE last_modified_t > 0"),
    "append_ledger": oracle.with_models(upkeep.APPENDED),
    "fact_order_items_stateful": oracle.with_models("SELECT * FROM fact_order_items"),
}
