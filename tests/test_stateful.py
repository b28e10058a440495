"""The join of two streams: what lies in its state, and the fact it makes."""

from __future__ import annotations

import json
from decimal import Decimal
from pathlib import Path

import pytest

from cartwright import contracts
from cartwright.plans.marts import FACT_ORDER_ITEMS_COLUMNS, fact_order_items
from cartwright.plans.staging import stg_order_products, stg_orders
from cartwright.session import make_folder
from cartwright.sinks.loads import read_waves, write_waves
from cartwright.streaming import stateful_fact

ORDERS = [(1, 7, "prior", 1, 2, 3, None), (2, 7, "train", 2, 4, 5, Decimal(6)), (3, 8, "test", 1, 0, 0, None), (4, 9, "prior", 1, 6, 23, None)]
PRIOR = [(1, 10, 1, 0, 1), (1, 11, 2, None, 1), (1, 12, None, 1, 1), (4, 10, 1, 0, 1), (None, 10, 1, 0, 1), (99, 10, 1, 0, 1), (3, 10, 1, 0, 1)]
TRAIN = [(2, i, i, 1, 2) for i in range(1, 8)] + [(2, 7, 7, 1, 2)]  # one line twice


def _land(spark, folder, name, rows):
    c = contracts.table(name)
    write_waves(spark.createDataFrame(rows, c.schema()), f"{folder}/{name}", mode="append")


def _folder(spark, scratch):
    for c in contracts.WAVE_TABLES:
        make_folder(spark, f"{scratch}/in/{c.name}")
    return f"{scratch}/in", f"{scratch}/fact", f"{scratch}/checkpoint"


def _rows(df):
    return sorted(map(repr, df.select(*FACT_ORDER_ITEMS_COLUMNS).collect()))


def _expected(spark, folder):
    orders, prior, train = (read_waves(spark, f"{folder}/{n}", contracts.table(n)) for n in ("orders", *contracts.LINE_TABLES))
    return _rows(fact_order_items(stg_order_products(prior, train), stg_orders(orders)))


@pytest.mark.parametrize("pack_rows", [1, 3, 1 << 20])
def test_fact_of_lines_before_and_after_their_orders(spark, scratch, monkeypatch, pack_rows):
    monkeypatch.setattr(stateful_fact, "PACK_ROWS", pack_rows)
    folder, fact, checkpoint = _folder(spark, scratch)
    _land(spark, folder, "order_products_prior", PRIOR)
    _land(spark, folder, "orders", ORDERS[:2])
    stateful_fact.refresh_stateful(spark, folder, fact, checkpoint)
    _land(spark, folder, "orders", ORDERS[2:])
    _land(spark, folder, "order_products_train", TRAIN)
    stateful_fact.refresh_stateful(spark, folder, fact, checkpoint)
    got = _rows(spark.read.parquet(fact))
    assert got == _expected(spark, folder) and len(got) == 12


def test_lines_of_an_order_are_one_row_of_a_state_on_disk(spark, scratch):
    before = {k: spark.conf.get(k, None) for k in stateful_fact.STATE_SETTINGS}
    folder, fact, checkpoint = _folder(spark, scratch)
    _land(spark, folder, "order_products_train", TRAIN)
    _land(spark, folder, "order_products_prior", PRIOR)
    stateful_fact.refresh_stateful(spark, folder, fact, checkpoint)
    state = spark.read.format("statestore").option("joinSide", "left").load(checkpoint)
    held = sorted((r["value"]["order_id"], sorted(r["value"]["product_id"])) for r in state.collect())
    assert held == [(1, [10, 11, 12]), (2, [1, 2, 3, 4, 5, 6, 7, 7]), (3, [10]), (4, [10]), (99, [10])]
    local = checkpoint.removeprefix("file:")
    conf = json.loads(Path(local, "offsets", "0").read_text().split("\n")[1])["conf"]
    assert conf["spark.sql.streaming.stateStore.providerClass"].endswith("RocksDBStateStoreProvider")
    assert {k: spark.conf.get(k, None) for k in stateful_fact.STATE_SETTINGS} == before
