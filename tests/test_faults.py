"""Wave replacement, late orders, the gate and the layers on small hand-made tables."""
import pytest
from pyspark.sql import functions as F

from cartwright import contracts
from cartwright.operators import quality
from cartwright.operators.incremental import delete_insert
from cartwright.plans.pipelines import Warehouse, mart_tables, register_layers, run_gate, run_setup, run_wave
from cartwright.sinks.loads import load_wave, read_loaded_wave_table, write_waves
from cartwright.sources.csv import write_contract_csv

COLS = ["order_id", "product_id", "order_number"]
SCHEMA = "order_id long, product_id int, order_number int"
KEY = ["order_id", "product_id"]
PRIOR, TRAIN, ORD = (contracts.table(n) for n in ("order_products_prior", "order_products_train", "orders"))


def _apply(spark, rows, target, **how):
    return delete_insert(spark, spark.createDataFrame(rows, SCHEMA), target, KEY, "order_number", COLS, **how)


def _rows(spark, target):
    return sorted(map(tuple, spark.read.parquet(target).select(*COLS).collect()), key=str)


def test_replaced_partitions_hold_the_batch_alone(spark, scratch):
    """rows that the corrected wave no longer has are gone; so are emptied
    waves, and old places of rows that moved in."""
    t = f"{scratch}/fact"
    _apply(spark, [(1, 5, 1), (2, 10, 2), (2, 12, 2), (3, 7, 3), (4, 1, 4)], t)
    assert _apply(spark, [(2, 10, 2)], t, replace=[2]) == 1
    assert _rows(spark, t) == [(1, 5, 1), (2, 10, 2), (3, 7, 3), (4, 1, 4)]
    assert _apply(spark, [], t, replace=[3, 9]) == 1
    assert _rows(spark, t) == [(1, 5, 1), (2, 10, 2), (4, 1, 4)]
    assert _apply(spark, [(2, 10, 2), (1, 5, 2)], t, replace=[2]) == 2
    assert _rows(spark, t) == [(1, 5, 2), (2, 10, 2), (4, 1, 4)]
    with pytest.raises(ValueError, match="outside"):
        _apply(spark, [(8, 8, 8)], t, replace=[2])
    assert _apply(spark, [], t) == 0


def test_null_keys_are_added_never_matched(spark, scratch):
    t = f"{scratch}/fact"
    _apply(spark, [(None, 1, 1), (5, None, 1)], t)
    _apply(spark, [(None, 1, 2)], t)
    assert _rows(spark, t) == sorted([(None, 1, 1), (5, None, 1), (None, 1, 2)], key=str)


def _landing(spark, scratch, lines=((1, 5, 1), (2, 5, 2))):
    """Two orders of one user; prior lines as (order, product, wave), no train lines."""
    root = f"{scratch}/landing"
    orders = [(1, 9, "prior", 1, 0, 6, None), (2, 9, "train", 2, 1, 21, None)]
    write_waves(spark.createDataFrame(orders, ORD.schema()), f"{root}/orders")
    write_waves(spark.createDataFrame([(o, p, 1, 0, w) for o, p, w in lines], PRIOR.schema()), f"{root}/{PRIOR.name}")
    spark.createDataFrame([], TRAIN.schema()).drop("order_number").write.mode("overwrite").parquet(
        f"{root}/{TRAIN.name}/order_number=1")
    for name, row in (("aisles", (1, "pulses")), ("departments", (2, "dry")), ("products", (5, "lentils", 1, 2))):
        c = contracts.table(name)
        write_contract_csv(spark.createDataFrame([row], c.schema()), f"{root}/{name}", c)
    return root


def test_layers_with_an_empty_wave_table(spark, scratch):
    """No train lines in early waves; the layers still register,
    with views over staging and a load time on the raw tables."""
    wh, landing = Warehouse(f"{scratch}/wh"), _landing(spark, scratch)
    run_setup(spark, wh, landing, database=f"cw_t{abs(hash(scratch)) % 10**8}_setup")
    run_wave(spark, wh, landing, [1, 2])
    p = f"cw_t{abs(hash(scratch)) % 10**8}_"
    made = register_layers(spark, wh, prefix=p)
    assert spark.sql(f"SELECT count(*) FROM {p}raw.{TRAIN.name}").first()[0] == 0
    assert spark.sql(f"SELECT sum(reordered) FROM {p}staging.stg_order_products").first()[0] == 0
    assert spark.sql(f"SELECT total_orders FROM {p}intermediate.int_user_metrics").first()[0] == 2
    assert [n for n, kind in made.items() if kind == "view" and "staging" in n].__len__() == 6
    assert spark.sql(f"SELECT _loaded_at IS NOT NULL FROM {p}raw.aisles").first()[0]
    assert register_layers(spark, wh, prefix=p) == made


def test_gate_fails_on_a_model_that_is_not_there(spark, scratch):
    """a missing dimension is no passed test; only what is named is left out."""
    wh, landing = Warehouse(f"{scratch}/wh"), _landing(spark, scratch)
    run_setup(spark, wh, landing)
    assert len(run_wave(spark, wh, landing, [1, 2])) == 17  # without the feed's four
    with pytest.raises(KeyError, match="dim_food_product"):
        run_gate(spark, wh)
    with pytest.raises(KeyError, match="dim_product"):
        quality.evaluate(quality.MART_TESTS, {k: v for k, v in mart_tables(spark, wh).items() if k == "fact_order_items"})


def test_a_failed_mart_leaves_the_old_one(spark, scratch):
    """A bad record in a later wave, met while the marts are written."""
    wh, landing = Warehouse(f"{scratch}/wh"), _landing(spark, scratch)
    run_setup(spark, wh, landing)
    run_wave(spark, wh, landing, [1])
    before = {n: sorted(map(str, t.collect())) for n, t in mart_tables(spark, wh).items()}
    from cartwright.session import write_and_swap
    broken = spark.read.parquet(wh.mart("dim_user")).withColumn("user_id", F.raise_error(F.lit("bad record")).cast("long"))
    with pytest.raises(Exception, match="bad record"):
        write_and_swap(broken, wh.mart("dim_user"))
    assert {n: sorted(map(str, t.collect())) for n, t in mart_tables(spark, wh).items()} == before


def test_lines_wait_for_their_orders(spark, scratch):
    """lines whose order lands later, even after a replayed or an empty run."""
    from cartwright.streaming.wave_refresh import refresh_on_new_lines, stream_order_products
    raw, target, ckpt = f"{scratch}/raw", f"{scratch}/fact", f"{scratch}/ckpt/fact"
    orders = {"n": 0}
    every = spark.createDataFrame([(i, 1, 0, 5) for i in range(1, 7)],
                                  "order_id long, user_id long, order_day_of_week int, order_hour_of_day int")

    def run(landed):
        orders["n"] = landed
        refresh_on_new_lines(spark, stream_order_products(spark, raw, 1), lambda: every.where(F.col("order_id") <= orders["n"]),
                             target, ckpt)
        return sorted(r.order_id for r in spark.read.parquet(target).collect())

    load_wave(spark, spark.createDataFrame([(i, 8, 1, 0, 1) for i in (1, 2, 5)], PRIOR.schema()), PRIOR, 1, f"{raw}/{PRIOR.name}")
    load_wave(spark, spark.createDataFrame([(4, 8, 1, 0, 2)], TRAIN.schema()), TRAIN, 2, f"{raw}/{TRAIN.name}")
    assert run(1) == [1]
    assert run(1) == [1]
    assert run(2) == [1, 2]
    load_wave(spark, spark.createDataFrame([(i, 8, 1, 0, 3) for i in (3, 6)], PRIOR.schema()), PRIOR, 3, f"{raw}/{PRIOR.name}")
    assert run(4) == [1, 2, 3, 4]
    assert run(6) == [1, 2, 3, 4, 5, 6]


def test_rounding_refuses_numbers_that_are_not_whole(spark):
    """F8: the exact rounding is for whole numbers; others abort instead of being cut."""
    from cartwright.functions.scalars import round_avg
    df = spark.createDataFrame([(1.0,), (2.0,), (None,)], "x double")
    assert df.agg(round_avg("x", 2).alias("r")).first().r == 1.5
    with pytest.raises(Exception, match="whole"):
        df.unionByName(spark.createDataFrame([(0.25,)], "x double")).agg(round_avg("x", 2)).collect()


def test_no_local_folder_on_a_cluster():
    """F11 and scratch: a cluster without a shared folder is an error."""
    from types import SimpleNamespace

    from cartwright.session import SESSION_DEFAULTS, checkpoint_root
    assert SESSION_DEFAULTS["spark.sql.ansi.enabled"] == "true"

    def session(conf, folder, master):
        context = SimpleNamespace(getCheckpointDir=lambda: folder, master=master, applicationId="a", setCheckpointDir=print)
        return SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: conf), sparkContext=context)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(session(None, None, "spark://host:7077"))
    assert checkpoint_root(session(None, "hdfs://n/x/", "yarn")) == "hdfs://n/x"
    assert checkpoint_root(session("hdfs://n/y", "hdfs://n/x", "yarn")) == "hdfs://n/y"


def test_loaded_tables_carry_their_load_time(spark, scratch):
    load_wave(spark, spark.createDataFrame([(1, 8, 1, 0, 1)], PRIOR.schema()), PRIOR, 1, f"{scratch}/t")
    assert read_loaded_wave_table(spark, f"{scratch}/t", PRIOR).first()["_loaded_at"] is not None
