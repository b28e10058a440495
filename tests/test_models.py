"""Model properties on the smallest driver tables (sf0.001)."""
from pyspark.sql import functions as F

from cartwright.functions.keys import surrogate_key
from cartwright.plans import marts
from cartwright.plans.models import Models
from cartwright_catalog.landed import landed_raw_layer
from conftest import SF_SMALL


def _models(spark):
    return Models(spark, landed_raw_layer(spark, SF_SMALL))


def test_dim_time_has_168_unique_rows(spark):
    d = marts.dim_time(spark)
    assert d.count() == 168
    assert d.select("time_key").distinct().count() == 168
    row = d.where("order_day_of_week = 0 AND order_hour_of_day = 5").first()
    assert (row.day_name, row.is_weekend, row.day_part) == ("Saturday", True, "Morning")
    assert d.where("order_hour_of_day = 21").select("day_part").distinct().first()[0] == "Night"


def test_surrogate_key_null_and_int_forms(spark):
    df = spark.createDataFrame([(1, None)], "a int, b int")
    got = df.select(surrogate_key("a", "b").alias("k"), F.md5(F.lit("1-_dbt_utils_surrogate_key_null_"))
                    .alias("want")).first()
    assert got.k == got.want


def test_basket_sizes_sum_to_line_count(spark):
    m = _models(spark)
    lines = m.stg_order_products.count()
    assert m.int_order_metrics.agg(F.sum("basket_size")).first()[0] == lines
    assert m.fact_order_items.count() == lines


def test_every_fact_key_resolves(spark):
    from cartwright.operators import quality
    m = _models(spark)
    tables = {n: m.get(n) for n in ["fact_order_items", "fact_orders", "dim_product", "dim_user", "dim_time",
                                    "dim_food_product"]}
    results = quality.gate(quality.evaluate(quality.MART_TESTS, tables))
    assert len(results) == 21


def test_unknown_aisle_keeps_null_name(spark):
    m = _models(spark)
    aisles = m.stg_aisles.where("aisle_id <> 6")
    d = marts.dim_product(m.stg_products, aisles, m.stg_departments)
    assert d.count() == m.stg_products.count()
    assert d.where("aisle_id = 6").where("aisle_name IS NOT NULL").count() == 0
    assert d.where("aisle_id = 6").count() > 0


def test_itemless_orders_keep_null_measures(spark):
    m = _models(spark)
    f = m.fact_orders
    assert f.count() == m.stg_orders.count()
    itemless = f.where("basket_size IS NULL")
    assert itemless.count() == f.join(m.int_order_metrics, "order_id", "left_anti").count()


def test_latest_version_prefers_null_then_tie_break(spark):
    from cartwright.plans.staging import latest_version
    df = spark.createDataFrame([("a", 5, 1), ("a", 9, 2), ("a", 9, 3), ("b", None, 1), ("b", 7, 2)],
                               "k string, t long, pos long")
    got = sorted(tuple(r) for r in latest_version(df, "k", "t", ["pos"]).collect())
    assert got == [("a", 9, 3), ("b", None, 1)]


def test_exact_half_up_rounding(spark):
    from cartwright.functions.scalars import exact_round_ratio
    rows = [(1, 160, 4, 0.0063), (1, 8, 2, 0.13), (201, 200, 2, 1.01), (0, 5, 2, 0.0), (2, 3, 4, 0.6667),
            (1, 0, 2, None), (None, 3, 2, None), (5, None, 2, None)]
    df = spark.createDataFrame([r[:3] for r in rows], "n long, d long, k int")
    got = [df.where(f"k = {k}").select(exact_round_ratio(F.col("n"), F.col("d"), k).alias("r")).collect()
           for k in (2, 4)]
    flat = {}
    for k, res in zip((2, 4), got):
        src = [r for r in rows if r[2] == k]
        for r, g in zip(src, res):
            flat[r[:3]] = g.r
    assert flat == {r[:3]: r[3] for r in rows}
