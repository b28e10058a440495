"""A hot order (a third of all lines) is split by AQE in the fact join.

Thresholds are lowered to test scale and size-based broadcasting is off, as
for tables far above any broadcast threshold."""
from pyspark.sql import functions as F

from cartwright.plans.marts import fact_order_items

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
    "spark.sql.shuffle.partitions": "32",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def test_hot_order_is_split_in_fact_join(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    try:
        for k, v in SKEW_CONF.items():
            spark.conf.set(k, v)
        n = 300_000
        lines = spark.range(n).select(
            F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 5000).alias("order_id"),
            (F.col("id") % 1000).cast("int").alias("product_id"), F.lit(1).alias("order_number"),
            F.lit(1).alias("add_to_cart_order"), F.lit(0).alias("reordered"), F.lit("prior").alias("source"))
        orders = spark.range(5000).select(F.col("id").alias("order_id"), (F.col("id") % 97).alias("user_id"),
                                          F.lit(1).alias("order_day_of_week"), F.lit(2).alias("order_hour_of_day"))
        df = fact_order_items(lines, orders)
        qe = df._jdf.queryExecution()
        assert qe.toRdd().count() == n  # runs the adaptive plan of this Dataset
        plan = qe.executedPlan().toString()
        assert "isFinalPlan=true" in plan
        assert "SortMergeJoin(skew=true)" in plan
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
