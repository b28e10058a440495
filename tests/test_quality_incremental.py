"""Q6 gate and B10/B11 incremental delete+insert."""
import pytest
from pyspark.sql import functions as F

from cartwright.operators import quality
from cartwright.operators.incremental import SchemaChangeError, delete_insert

COLS = ["order_id", "product_id", "v", "order_number"]
SCHEMA = "order_id long, product_id int, v string, order_number int"


def _read(spark, path):
    return sorted(tuple(r) for r in spark.read.parquet(path).select(*COLS).collect())


def test_gate_raises_on_failure(spark):
    dim = spark.createDataFrame([("k1",), ("k1",), (None,)], "user_key string")
    tests = [quality.DataTest("unique", "dim", ("user_key",)), quality.DataTest("not_null", "dim", ("user_key",))]
    with pytest.raises(quality.DataQualityError) as e:
        quality.gate(quality.evaluate(tests, {"dim": dim}))
    assert dict(e.value.failures) == {"unique_dim_user_key": 1, "not_null_dim_user_key": 1}


def test_relationships_and_accepted_values(spark):
    child = spark.createDataFrame([("a", 0), ("x", 1), ("x", 2), (None, None)], "k string, r int")
    parent = spark.createDataFrame([("a",)], "k string")
    tests = [quality.DataTest("relationships", "c", ("k",), "p", "k"),
             quality.DataTest("accepted_values", "c", ("r",), values=(0, 1))]
    got = {r.test_name: r.n_failed for r in quality.evaluate(tests, {"c": child, "p": parent}).collect()}
    assert got == {"relationships_c_k__p": 2, "accepted_values_c_r": 1}


def test_delete_insert_replaces_keys_and_is_idempotent(spark, scratch):
    target = f"{scratch}/fact"
    first = spark.createDataFrame([(1, 10, "a", 1), (2, 10, "b", 1), (3, 10, "c", 2)], SCHEMA)
    delete_insert(spark, first, target, ["order_id", "product_id"], "order_number", COLS)
    batch = spark.createDataFrame([(1, 10, "a2", 2), (4, 10, "d", 3)], SCHEMA)
    n = delete_insert(spark, batch, target, ["order_id", "product_id"], "order_number", COLS)
    assert n == 3  # waves 2 and 3 from the batch, wave 1 because key (1,10) lived there
    want = [(1, 10, "a2", 2), (2, 10, "b", 1), (3, 10, "c", 2), (4, 10, "d", 3)]
    assert _read(spark, target) == want
    delete_insert(spark, batch, target, ["order_id", "product_id"], "order_number", COLS)
    assert _read(spark, target) == want


def test_partition_left_empty_is_cleared(spark, scratch):
    target = f"{scratch}/fact"
    delete_insert(spark, spark.createDataFrame([(1, 10, "a", 1)], SCHEMA), target, ["order_id", "product_id"],
                  "order_number", COLS)
    delete_insert(spark, spark.createDataFrame([(1, 10, "moved", 2)], SCHEMA), target, ["order_id", "product_id"],
                  "order_number", COLS)
    assert _read(spark, target) == [(1, 10, "moved", 2)]


def test_schema_change_fails(spark, scratch):
    target = f"{scratch}/fact"
    delete_insert(spark, spark.createDataFrame([(1, 10, "a", 1)], SCHEMA), target, ["order_id", "product_id"],
                  "order_number", COLS)
    bad = spark.createDataFrame([(1, 10, 5, 1)], "order_id long, product_id int, v int, order_number int")
    with pytest.raises(SchemaChangeError):
        delete_insert(spark, bad, target, ["order_id", "product_id"], "order_number", COLS)


def test_waves_loaded_incrementally_equal_full_build(spark):
    from conftest import SF_SMALL

    import __spark_entry__ as e
    inc = e.queries()["fact_order_items_incremental"](spark, SF_SMALL)
    full = e.queries()["fact_order_items_full"](spark, SF_SMALL)
    assert inc.count() == full.count()
    assert inc.exceptAll(full.select(*inc.columns)).count() == 0
    assert inc.groupBy("order_id", "product_id").count().where(F.col("count") > 1).count() == 0


def test_explicit_wave_replacement_reaches_old_waves(spark):
    """H3: a corrected old wave never passes ``order_number > max``; the
    explicit-wave mode replaces it."""
    from conftest import SF_SMALL

    from cartwright import contracts
    from cartwright.plans.models import Models
    from cartwright.plans.pipelines import Warehouse, read_raw, refresh_fact_order_items
    from cartwright.session import scratch_dir
    from cartwright.sinks.loads import load_full, load_wave, load_waves, read_waves
    from cartwright_catalog.landed import landed_raw_layer, landed_raw_root

    raw = landed_raw_layer(spark, SF_SMALL)
    root = landed_raw_root(spark, SF_SMALL)
    wh = Warehouse(scratch_dir(spark, "wh"))
    for c in contracts.FULL_TABLES:
        load_full(raw.table(c.name), c, wh.raw(c.name))
    for c in contracts.WAVE_TABLES:
        load_waves(spark, read_waves(spark, f"{root}/{c.name}", c), c, [1, 2, 3], wh.raw(c.name))
    refresh_fact_order_items(spark, Models(spark, read_raw(spark, wh)), wh)
    # wave 2 of the prior lines is corrected: every line now marked reordered
    c = contracts.table("order_products_prior")
    fixed_wave = read_waves(spark, f"{root}/{c.name}", c).where("order_number = 2").withColumn("reordered", F.lit(1))
    load_wave(spark, fixed_wave, c, 2, wh.raw(c.name))
    m = Models(spark, read_raw(spark, wh))
    refresh_fact_order_items(spark, m, wh)  # > max: nothing happens
    fact = spark.read.parquet(wh.mart("fact_order_items"))
    assert fact.where("order_number = 2 AND source = 'prior' AND reordered = 0").count() > 0
    refresh_fact_order_items(spark, m, wh, waves=[2])
    fact = spark.read.parquet(wh.mart("fact_order_items"))
    assert fact.where("order_number = 2 AND source = 'prior' AND reordered = 0").count() == 0
    assert fact.count() == m.stg_order_products.count()


def test_layers_registered_for_sql(spark):
    from conftest import SF_SMALL

    from cartwright_catalog.scenarios import _catalog_prefix
    p = _catalog_prefix(spark, SF_SMALL)
    n = spark.sql(f"SELECT count(*) FROM {p}marts.fact_order_items").first()[0]
    assert n > 0
    assert spark.sql(f"SELECT count(*) FROM {p}marts.dim_time").first()[0] == 168
    waves = spark.sql(f"SELECT count(DISTINCT order_number) FROM {p}raw.orders").first()[0]
    assert waves > 1
    assert _catalog_prefix(spark, SF_SMALL) == p  # registering again is a no-op


def test_gate_stops_a_wave_run_on_orphan_products(spark):
    """Q6 in a run: a line whose product is missing from the product table
    fails the relationships test and the run raises."""
    from conftest import SF_SMALL

    from cartwright import contracts
    from cartwright.plans.pipelines import Warehouse, run_wave
    from cartwright.session import scratch_dir
    from cartwright.sinks.loads import load_full
    from cartwright_catalog.landed import landed_raw_layer, landed_raw_root

    raw = landed_raw_layer(spark, SF_SMALL)
    root = landed_raw_root(spark, SF_SMALL)
    wh = Warehouse(scratch_dir(spark, "wh"))
    for c in contracts.FULL_TABLES:
        src = raw.table(c.name)
        if c.name == "products":  # drop the product of one loaded line
            pid = raw.order_products_prior.where("order_number = 1").first().product_id
            src = src.where(F.col("product_id") != pid)
        load_full(src, c, wh.raw(c.name))
    with pytest.raises(quality.DataQualityError) as e:
        run_wave(spark, wh, root, [1])
    assert any(name.startswith("relationships_fact_order_items_product_key") for name, _ in e.value.failures)


def test_added_column_is_a_schema_change(spark, scratch):
    target = f"{scratch}/fact"
    delete_insert(spark, spark.createDataFrame([(1, 10, "a", 1)], SCHEMA), target, ["order_id", "product_id"],
                  "order_number", COLS)
    wider = spark.createDataFrame([(2, 10, "b", 1, 7)], SCHEMA + ", extra int")
    with pytest.raises(SchemaChangeError):
        delete_insert(spark, wider, target, ["order_id", "product_id"], "order_number", COLS + ["extra"])


def test_relationship_tests_fold_per_child(spark):
    child = spark.createDataFrame([("a", 1), ("x", 2), ("x", 9), (None, 1), ("a", None)], "s string, n int")
    ps = spark.createDataFrame([("a",)], "s string")
    pn = spark.createDataFrame([(1,), (2,)], "n int")
    tests = [quality.DataTest("relationships", "c", ("s",), "ps", "s"),
             quality.DataTest("relationships", "c", ("n",), "pn", "n")]
    got = {r.test_name: r.n_failed for r in quality.evaluate(tests, {"c": child, "ps": ps, "pn": pn}).collect()}
    assert got == {"relationships_c_s__ps": 2, "relationships_c_n__pn": 1}
    clean = spark.createDataFrame([("a", 1)], "s string, n int")
    got = {r.test_name: r.n_failed for r in quality.evaluate(tests, {"c": clean, "ps": ps, "pn": pn}).collect()}
    assert got == {"relationships_c_s__ps": 0, "relationships_c_n__pn": 0}


def test_unique_tests_fold_per_model(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 2), (None, 3), (None, 3)], "k string, n int")
    tests = [quality.DataTest("unique", "m", ("k",)), quality.DataTest("unique", "m", ("n",))]
    got = {r.test_name: r.n_failed for r in quality.evaluate(tests, {"m": df}).collect()}
    assert got == {"unique_m_k": 1, "unique_m_n": 2}


def test_columns_of_finish_are_not_shuffled(spark, scratch):
    """Hash keys are added behind the last shuffle, into a new target and an old one."""
    from cartwright.session import write_pending

    def widen(rows):
        return rows.withColumn("key", F.md5(F.col("id").cast("string")))

    seen = []
    rows = spark.range(40).withColumn("p", (F.col("id") % 2).cast("int"))
    write_pending(rows, f"{scratch}/wide", "p", "id", lambda r: seen.append(r.columns) or widen(r)).publish()
    assert seen == [["id", "p"]]
    back = spark.read.parquet(f"{scratch}/wide")
    assert back.where(F.col("key") == F.md5(F.col("id").cast("string"))).count() == 40
    for low, high in ((30, 50), (60, 70)):
        batch = spark.range(low, high).withColumn("p", F.lit(low).cast("int"))
        delete_insert(spark, batch, f"{scratch}/wide", ["id"], "p", ["id", "p", "key"], finish=widen)
    back = spark.read.parquet(f"{scratch}/wide")
    assert sorted(tuple(r) for r in back.select("id", "p").collect()) == sorted(
        [(i, i % 2) for i in range(30)] + [(i, 30) for i in range(30, 50)] + [(i, 60) for i in range(60, 70)])
    assert back.where(F.col("key") == F.md5(F.col("id").cast("string"))).count() == 60
