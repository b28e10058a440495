"""B5/B6/B7/B13 golden cases: full refresh, replace-one-wave, append-once."""
import json
import os

import pytest
from pyspark.sql import functions as F

from cartwright import contracts
from cartwright.sinks.loads import (
    ingest, load_full, load_wave, load_waves, read_loaded_wave_table, wave_file_label, write_waves,
)
from cartwright.streaming.json_ingest import ingest_json_arrays

ORD = contracts.table("orders")


def _orders(spark, rows):
    return spark.createDataFrame(rows, ORD.schema())


def _o(oid, wave):
    return (oid, 1, "prior", wave, 0, 0, None)


def test_full_load_replaces_previous_content(spark, scratch):
    c = contracts.table("aisles")
    load_full(spark.createDataFrame([(9, "old")], c.schema()), c, f"{scratch}/aisles")
    load_full(spark.createDataFrame([(1, "spices"), (2, "pickles")], c.schema()), c, f"{scratch}/aisles")
    got = sorted(tuple(r) for r in spark.read.parquet(f"{scratch}/aisles").select("aisle_id", "aisle").collect())
    assert got == [(1, "spices"), (2, "pickles")]
    assert "_loaded_at" in spark.read.parquet(f"{scratch}/aisles").columns


def test_wave_load_replaces_only_that_wave(spark, scratch):
    target = f"{scratch}/orders"
    load_waves(spark, _orders(spark, [_o(1, 1), _o(2, 2), _o(3, 3), _o(4, 3)]), ORD, [1, 2, 3], target)
    load_wave(spark, _orders(spark, [_o(30, 3)]), ORD, 3, target)
    load_wave(spark, _orders(spark, [_o(30, 3)]), ORD, 3, target)  # idempotent rerun
    got = sorted((r.order_id, r.order_number) for r in read_loaded_wave_table(spark, target, ORD).collect())
    assert got == [(1, 1), (2, 2), (30, 3)]


def test_wave_without_source_is_emptied(spark, scratch):
    target = f"{scratch}/orders"
    load_waves(spark, _orders(spark, [_o(1, 1), _o(3, 3)]), ORD, [1, 3], target)
    load_wave(spark, None, ORD, 3, target)
    got = sorted((r.order_id, r.order_number) for r in read_loaded_wave_table(spark, target, ORD).collect())
    assert got == [(1, 1)]


def test_ingest_needs_a_mode_and_full_needs_sources(spark, scratch):
    with pytest.raises(ValueError):
        ingest(spark, scratch, scratch)
    with pytest.raises(FileNotFoundError):
        ingest(spark, scratch, scratch, full=True, reference_sources={})


def test_ingest_wave_reads_landed_partition(spark, scratch):
    landing, target = f"{scratch}/landing", f"{scratch}/raw"
    write_waves(_orders(spark, [_o(1, 1), _o(2, 2)]), f"{landing}/orders")
    for t in ("order_products_prior", "order_products_train"):
        c = contracts.table(t)
        write_waves(spark.createDataFrame([(1, 5, 1, 0, 1)], c.schema()), f"{landing}/{t}")
    done = ingest(spark, landing, target, wave=2)
    assert "orders@orders_002" in done
    got = [(r.order_id, r.order_number) for r in read_loaded_wave_table(spark, f"{target}/orders", ORD).collect()]
    assert got == [(2, 2)]
    prior = read_loaded_wave_table(spark, f"{target}/order_products_prior", contracts.table("order_products_prior"))
    assert prior.count() == 0


def test_wave_labels():
    assert wave_file_label("orders", 7) == "orders_007"
    labels = sorted(wave_file_label("orders", n) for n in (2, 1, 10))
    assert labels == ["orders_001", "orders_002", "orders_010"]
    assert wave_file_label("orders", 1234) == "orders_1234"


def _land(path, name, rows):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{name}", "w") as fh:
        fh.write(json.dumps(rows))


def test_json_array_file_loads_once(spark, scratch):
    landing, target, ckpt = f"{scratch}/landing/dt=2024-01-01", f"{scratch}/raw", f"{scratch}/ckpt"
    _land(landing, "products_000001.json", [{"code": "a", "last_modified_t": 5}, {"code": "b", "last_modified_t": 7}])
    ingest_json_arrays(spark, f"{scratch}/landing", target, ckpt)
    df = spark.read.parquet(target)
    assert sorted(r.last_modified_t for r in df.collect()) == [5, 7]
    assert "dt" not in df.columns
    ingest_json_arrays(spark, f"{scratch}/landing", target, ckpt)  # rerun adds nothing
    assert spark.read.parquet(target).count() == 2
    _land(landing, "products_000002.json", {"code": "c", "last_modified_t": 9})  # single object file
    ingest_json_arrays(spark, f"{scratch}/landing", target, ckpt)
    got = spark.read.parquet(target).select(F.variant_get("payload", "$.code", "string").alias("c"))
    assert sorted(r.c for r in got.collect()) == ["a", "b", "c"]


def test_create_raw_table_if_not_exists(spark, scratch):
    from cartwright.sinks.loads import create_raw_table
    c = contracts.table("aisles")
    db = "cw_raw_test"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{scratch}/{db}.db'")
    create_raw_table(spark, db, c, f"{scratch}/aisles")
    create_raw_table(spark, db, c, f"{scratch}/aisles")  # second call is a no-op
    cols = [f.name for f in spark.table(f"{db}.aisles").schema.fields]
    assert cols == ["aisle_id", "aisle", "_loaded_at"]
    spark.sql(f"INSERT INTO {db}.aisles (aisle_id, aisle) VALUES (1, 'pickles')")
    row = spark.table(f"{db}.aisles").first()
    assert row.aisle == "pickles" and row._loaded_at is not None
    w = contracts.table("orders")
    create_raw_table(spark, db, w, f"{scratch}/orders")
    parts = [r.col_name for r in spark.sql(f"DESCRIBE {db}.orders").collect()]
    assert "# Partition Information" in parts


def test_wave_label_column(spark):
    from cartwright.functions.scalars import wave_label
    df = spark.createDataFrame([(7,), (1,), (10,), (1234,)], "w int")
    assert [r.l for r in df.select(wave_label("w").alias("l")).collect()] == ["007", "001", "010", "1234"]


def test_a_missing_landing_is_an_error_and_empties_nothing(spark, scratch):
    """a mistyped path must not pass for empty waves."""
    from cartwright.plans.pipelines import Warehouse, run_wave
    from cartwright.sinks.loads import read_wave
    with pytest.raises(FileNotFoundError):
        read_wave(spark, f"{scratch}/nothing", ORD, 3)
    wh = Warehouse(f"{scratch}/wh")
    load_waves(spark, _orders(spark, [_o(1, 3)]), ORD, [3], wh.raw("orders"))
    with pytest.raises(FileNotFoundError):
        ingest(spark, f"{scratch}/nothing", f"{wh.root}/raw", wave=3)
    with pytest.raises(FileNotFoundError):
        run_wave(spark, wh, f"{scratch}/nothing", [3])
    assert read_loaded_wave_table(spark, wh.raw("orders"), ORD).count() == 1


def _bad(spark, wave=3):
    """Orders of which one cannot be written."""
    from pyspark.sql import functions as F
    rows = _orders(spark, [_o(i, wave) for i in range(50)])
    return rows.withColumn("user_id", F.when(F.col("order_id") == 49, F.raise_error(F.lit("bad record")).cast("long"))
                           .otherwise(F.col("user_id")))


def test_failed_loads_leave_the_table(spark, scratch):
    """nothing old is touched before the new content is complete."""
    target = f"{scratch}/orders"
    load_waves(spark, _orders(spark, [_o(1, 1), _o(3, 3)]), ORD, [1, 3], target)
    for load in (lambda: load_wave(spark, _bad(spark), ORD, 3, target),
                 lambda: load_waves(spark, _bad(spark), ORD, [1, 3], target)):
        with pytest.raises(Exception, match="bad record"):
            load()
        got = sorted((r.order_id, r.order_number) for r in read_loaded_wave_table(spark, target, ORD).collect())
        assert got == [(1, 1), (3, 3)]
    c = contracts.table("aisles")
    load_full(spark.createDataFrame([(9, "kept")], c.schema()), c, f"{scratch}/aisles")
    bad = spark.range(100).select(F.col("id").cast("int").alias("aisle_id"), F.when(
        F.col("id") == 99, F.raise_error(F.lit("bad record"))).otherwise(F.lit("x")).alias("aisle"))
    with pytest.raises(Exception, match="bad record"):
        load_full(bad, c, f"{scratch}/aisles")
    assert [r.aisle for r in spark.read.parquet(f"{scratch}/aisles").collect()] == ["kept"]
    assert not [n for n in os.listdir(scratch) if n.startswith((".new", ".old"))]


def test_csv_waves_load_by_contract(spark, scratch):
    """Files as the source lands them: one per wave, some waves without lines."""
    from cartwright.sources.csv import csv_waves, read_csv_waves, write_csv_waves
    landing = f"{scratch}/landing"
    os.makedirs(f"{landing}/orders")
    head = "order_id,user_id,eval_set,order_number,order_dow,order_hour_of_day,days_since_prior_order\n"
    for wave, rows in ((1, "11,5,prior,1,0,7,\n12,6,train,1,3,23,\n"), (2, "13,5,train,2,4,9,8.0\n")):
        with open(f"{landing}/orders/orders_{wave:03d}.csv", "w") as fh:
            fh.write(head + rows)
    for t in contracts.LINE_TABLES:
        os.makedirs(f"{landing}/{t}")
    with open(f"{landing}/order_products_prior/order_products_prior_001.csv", "w") as fh:
        fh.write("order_id,product_id,add_to_cart_order,reordered,order_number\n11,70,1,0,1\n")
    assert sorted(csv_waves(spark, f"{landing}/orders", ORD)) == [1, 2]
    assert read_csv_waves(spark, f"{landing}/orders", ORD, [2, 9]).count() == 1
    target = f"{scratch}/raw"
    ingest(spark, landing, target, wave=1)
    ingest(spark, landing, target, wave=2)
    got = sorted((r.order_id, r.order_number) for r in read_loaded_wave_table(spark, f"{target}/orders", ORD).collect())
    assert got == [(11, 1), (12, 1), (13, 2)]
    prior = contracts.table("order_products_prior")
    assert read_loaded_wave_table(spark, f"{target}/order_products_prior", prior).count() == 1
    back = f"{scratch}/back"
    write_csv_waves(read_csv_waves(spark, f"{landing}/orders", ORD), back, ORD)
    write_csv_waves(read_csv_waves(spark, f"{landing}/orders", ORD, [2]), back, ORD)  # replaces wave 2 only
    assert sorted(os.listdir(back)) == ["orders_001.csv", "orders_002.csv"]
    assert sorted(read_csv_waves(spark, back, ORD).collect()) == sorted(read_csv_waves(spark, f"{landing}/orders", ORD).collect())


def test_setup_mode_creates_all_raw_tables(spark, scratch):
    db = "cw_setup_test"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{scratch}/{db}.db'")
    assert len(ingest(spark, scratch, f"{scratch}/raw", setup=db)) == len(contracts.TABLES)
    assert {t.name for t in spark.catalog.listTables(db)} >= {c.name for c in contracts.TABLES}
    ingest(spark, scratch, f"{scratch}/raw", setup=db)  # again: a no-op


def test_feed_landing_layout(spark, scratch):
    from cartwright.sinks.feed_landing import land_json_arrays
    from cartwright.sources.json_arrays import read_json_arrays
    n = 1_234
    feed = spark.range(n).select(
        F.to_variant_object(F.struct(F.concat(F.lit("p"), F.col("id").cast("string")).alias("code"),
                                     (F.col("id") + 86_400 * (F.col("id") % 2)).alias("last_modified_t")))
        .alias("payload"),
        (F.col("id") + 86_400 * (F.col("id") % 2)).alias("last_modified_t"), F.col("id").alias("pos"))
    land_json_arrays(feed, f"{scratch}/landing", F.timestamp_seconds("last_modified_t"), "pos", rows_per_array=100)
    days = sorted(p for p in os.listdir(f"{scratch}/landing") if p.startswith("dt="))
    assert days == ["dt=1970-01-01", "dt=1970-01-02"]
    lines = spark.read.text(f"{scratch}/landing").select(F.size(F.from_json("value", "array<string>")).alias("n"))
    assert lines.agg(F.max("n")).first()[0] <= 100
    back = read_json_arrays(spark, f"{scratch}/landing")
    assert back.count() == n
    assert back.select(F.variant_get("payload", "$.code", "string")).distinct().count() == n


def test_feed_landing_shuffles_once_and_groups_nothing(spark, scratch, monkeypatch):
    """A (day, chunk) aggregate held every text once more before and behind its shuffle."""
    from pyspark.sql import DataFrameWriter

    from cartwright.sinks.feed_landing import land_json_arrays
    seen = []
    real = DataFrameWriter.text
    monkeypatch.setattr(DataFrameWriter, "text", lambda w, *a, **k: seen.append(w._df) or real(w, *a, **k))
    feed = spark.range(50).select(F.to_variant_object(F.struct(F.col("id").alias("code"))).alias("payload"), F.col("id").alias("pos"))
    feed = feed.withColumn("payload", F.when(F.col("pos") != 3, F.col("payload")))  # without a payload: not landed
    land_json_arrays(feed, f"{scratch}/once", F.timestamp_seconds(F.lit(0)), "pos", rows_per_array=20)
    plan = seen[0]._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Exchange") == 1 and "Aggregate" not in plan
    lines = [r["value"] for r in spark.read.text(f"{scratch}/once").collect()]
    positions = [[x["feed_seq"] for x in json.loads(v)] for v in lines]
    assert all(p == sorted(p) and len(p) <= 20 for p in positions)
    assert sorted(sum(positions, [])) == [i for i in range(50) if i != 3]


def test_whole_file_json_array(spark, scratch):
    from cartwright.sources.json_arrays import read_json_arrays
    os.makedirs(f"{scratch}/pretty", exist_ok=True)
    with open(f"{scratch}/pretty/p.json", "w") as fh:
        json.dump([{"code": "a", "last_modified_t": 1}, {"code": "b", "last_modified_t": "2"}], fh, indent=2)
    got = read_json_arrays(spark, f"{scratch}/pretty", whole_file=True)
    assert sorted(r.last_modified_t for r in got.collect()) == [1, 2]


def test_landing_selection_rules():
    from cartwright.sinks.loads import landing_selection
    assert landing_selection() == (True, True)            # nothing asked: everything
    assert landing_selection(full=True) == (True, False)  # only reference tables
    assert landing_selection(wave=3) == (False, True)     # only that wave
    assert landing_selection(full=True, wave=3) == (True, False)  # full wins


def test_land_one_wave(spark, scratch):
    from types import SimpleNamespace

    from cartwright.sinks.loads import land_sources
    lines = contracts.table("order_products_prior")
    raw = SimpleNamespace(table=lambda n: {
        "orders": _orders(spark, [_o(1, 1), _o(2, 2)]),
        "order_products_prior": spark.createDataFrame([(1, 5, 1, 0, 1), (2, 5, 1, 1, 2)], lines.schema()),
        "order_products_train": spark.createDataFrame([], lines.schema())}[n])
    done = land_sources(spark, raw, scratch, wave=2)
    assert done == ["orders_002", "order_products_prior_002", "order_products_train_002"]
    got = read_loaded_wave_table(spark, f"{scratch}/orders", ORD).collect()
    assert [(r.order_id, r.order_number) for r in got] == [(2, 2)]


def test_ingest_full_reads_landed_csv(spark, scratch):
    from cartwright.sources.csv import write_contract_csv
    landing, target = f"{scratch}/landing", f"{scratch}/raw"
    rows = {"aisles": [(1, "pickles")], "departments": [(2, "frozen")], "products": [(3, 'a "b", c', 1, 2)]}
    for name, data in rows.items():
        c = contracts.table(name)
        write_contract_csv(spark.createDataFrame(data, c.schema()), f"{landing}/{name}", c)
    assert ingest(spark, landing, target, full=True) == ["aisles", "departments", "products"]
    got = spark.read.parquet(f"{target}/products").select("product_name").first()[0]
    assert got == 'a "b", c'
    with pytest.raises(FileNotFoundError):
        ingest(spark, f"{scratch}/empty", target, full=True)
