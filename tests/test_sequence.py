"""The skew-safe numbering operator equals row_number/lag, hot group included."""
from pyspark.sql import Window
from pyspark.sql import functions as F

from cartwright_catalog import numbering
from cartwright_catalog.numbering import number_within_groups


def test_matches_window_on_skewed_groups(spark):
    # group 0 holds about a third of the rows
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 97).alias("g"),
        (F.col("id") * 7919 % 10_007).alias("o"), F.col("id").alias("k"))
    w = Window.partitionBy("g").orderBy("o", "k")
    want = df.select("g", "o", "k", F.row_number().over(w).alias("rn"), F.lag("o").over(w).alias("prev_o"))
    for partitions in (1, 5, 16):
        got = number_within_groups(df, ["g"], ["o", "k"], rn_col="rn", lag_of={"o": "prev_o"}, num_partitions=partitions)
        a = got.select("g", "o", "k", "rn", "prev_o")
        assert a.count() == 30_000
        assert a.exceptAll(want).count() == 0 and want.exceptAll(a).count() == 0


def test_hot_group_is_spread_over_partitions(spark):
    df = spark.range(20_000).select(F.lit(1).alias("g"), F.col("id").alias("o"))
    got = number_within_groups(df, ["g"], ["o"], num_partitions=8)
    assert got.agg(F.min("rn"), F.max("rn"), F.count_distinct("rn")).first() == (1, 20_000, 20_000)


def _skewed(spark):
    return spark.range(3_000).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 97).alias("g"),
                                     (F.col("id") * 7919 % 10_007).alias("o"), F.col("id").alias("k"))


def test_hot_and_other_groups_together(spark, monkeypatch):
    monkeypatch.setattr(numbering, "HOT_ROWS", 100)
    df = _skewed(spark).withColumn("g", F.when(F.col("k") % 50 != 1, F.col("g")))  # rows without a group are left out
    w = Window.partitionBy("g").orderBy("o", "k")
    want = df.where("g IS NOT NULL").select("g", "o", "k", F.row_number().over(w).cast("long").alias("rn"), F.lag("o").over(w).alias("prev_o"))
    got = number_within_groups(df, ["g"], ["o", "k"], lag_of={"o": "prev_o"}, num_partitions=5)
    assert "Union" in got._jdf.queryExecution().executedPlan().toString()
    a = got.select("g", "o", "k", "rn", "prev_o")
    assert a.count() == 2_940 and a.exceptAll(want).count() == 0 and want.exceptAll(a).count() == 0


def test_groups_that_fit_a_task_are_shuffled_once(spark):
    got = number_within_groups(_skewed(spark), ["g"], ["o", "k"], lag_of={"o": "prev_o"})
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan


def test_order_lines_read_the_lines_once(spark, monkeypatch):
    """The lines are collapsed, numbered and marked from one scan; a long history or a large
    order (thresholds lowered) give the same rows, as do repeated and missing keys."""
    from cartwright_catalog.driver_tables import raw_order_lines

    lines = spark.createDataFrame(
        [(o, p, n) for o in range(1, 9) for n, p in enumerate((o % 3, 5, None, o % 3, 6), 1)] + [(None, 5, 1), (99, 5, 1)],
        "l_orderkey long, l_partkey long, l_linenumber int")
    orders = spark.createDataFrame([(o, o % 2, 1 + o // 2, "test" if o == 7 else "prior") for o in (1, 2, 3, 4, 5, 6, 7, 8, 8)],
                                   "order_id long, user_id long, order_number int, eval_set string")
    df = raw_order_lines(lines, orders)
    assert df._jdf.queryExecution().optimizedPlan().collectLeaves().size() == 2  # lines and orders
    got = sorted(map(tuple, df.collect()))
    assert (1, 1, 1, 0, 1, "prior") in got and (3, 5, 2, 1, 2, "prior") in got and not [r for r in got if r[0] in (7, 99)]
    assert len(got) == 8 * 3  # no line without a product; order 8 is there twice
    for limit in (3, 1):
        monkeypatch.setattr(numbering, "HOT_ROWS", limit)
        assert sorted(map(tuple, raw_order_lines(lines, orders).collect())) == got
