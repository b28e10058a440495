"""Filters and column selection reach the Parquet scans; no cartesian products."""
import re

from pyspark.sql import functions as F

from cartwright.plans.models import Models
from cartwright_catalog.landed import landed_raw_layer
from conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _scans(plan: str) -> list[str]:
    return [line for line in plan.splitlines() if "FileScan" in line]


def _models(spark):
    return Models(spark, landed_raw_layer(spark, SF_SMALL))


def test_eval_set_filter_is_pushed_to_the_orders_scan(spark):
    scans = _scans(_plan(_models(spark).stg_orders))
    assert len(scans) == 1 and "PushedFilters: [In(eval_set, [prior,train])" in scans[0]


def test_order_metrics_read_only_their_columns(spark):
    for scan in _scans(_plan(_models(spark).int_order_metrics)):
        schema = re.search(r"ReadSchema: (struct<.*>)", scan).group(1)
        assert schema == "struct<order_id:bigint,reordered:int>", schema


def test_incremental_predicate_prunes_wave_partitions(spark):
    op = _models(spark).stg_order_products
    scans = _scans(_plan(op.where(F.col("order_number") > 3)))
    assert len(scans) == 2
    for scan in scans:
        assert "PartitionFilters: [isnotnull(order_number" in scan and "(order_number" in scan and "> 3)" in scan


def test_source_filter_prunes_the_other_union_branch(spark):
    op = _models(spark).stg_order_products
    assert len(_scans(_plan(op.where(F.col("source") == "prior")))) == 1


def test_no_cartesian_product_in_any_model(spark):
    m = _models(spark)
    for name in ["dim_time", "dim_product", "dim_user", "fact_orders", "fact_order_items", "int_user_metrics",
                 "stg_off_products", "dim_food_product"]:
        plan = _plan(m.get(name))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
