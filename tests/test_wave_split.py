"""B2 + J6 golden cases: split orders and lines into waves by order_number."""
import pytest
from pyspark.sql import Row

from cartwright import contracts
from cartwright.sinks.loads import read_waves, split_waves

from decimal import Decimal

ORDERS = [
    (31, 4, "prior", 1, 5, 6, None),
    (47, 4, "train", 2, 0, 19, Decimal(13)),
    (52, 3, "prior", 1, 1, 12, None),
]
PRIOR = [(31, 8, 1, 0), (31, 9, 2, 0), (52, 8, 1, 0)]
TRAIN = [(47, 8, 1, 1)]
LINE_COLS = "order_id long, product_id int, add_to_cart_order int, reordered int"


def _inputs(spark):
    orders = spark.createDataFrame(ORDERS, contracts.table("orders").schema())
    lines = {"order_products_prior": spark.createDataFrame(PRIOR, LINE_COLS),
             "order_products_train": spark.createDataFrame(TRAIN, LINE_COLS)}
    return orders, lines


def _wave(spark, landing, table, wave):
    c = contracts.table(table)
    return sorted(tuple(r) for r in read_waves(spark, f"{landing}/{table}", c).where(f"order_number = {wave}")
                  .collect())


def test_split_orders_and_lines(spark, scratch):
    orders, lines = _inputs(spark)
    split_waves(orders, lines, scratch)
    o = contracts.table("orders")
    by_wave = {r.order_id: r.order_number for r in read_waves(spark, f"{scratch}/orders", o).collect()}
    assert by_wave == {31: 1, 47: 2, 52: 1}
    assert [r[0] for r in _wave(spark, scratch, "orders", 1)] == [31, 52]
    assert [r[0] for r in _wave(spark, scratch, "orders", 2)] == [47]
    assert _wave(spark, scratch, "order_products_prior", 1) == [(31, 8, 1, 0, 1), (31, 9, 2, 0, 1),
                                                               (52, 8, 1, 0, 1)]
    # all prior lines belong to first orders: no wave-2 partition at all
    assert _wave(spark, scratch, "order_products_prior", 2) == []
    import os
    assert not os.path.exists(f"{scratch}/order_products_prior/order_number=2")


def test_split_is_deterministic_on_rerun(spark, scratch):
    orders, lines = _inputs(spark)
    split_waves(orders, lines, scratch)
    first = _wave(spark, scratch, "order_products_train", 2)
    split_waves(orders, lines, scratch)
    second = _wave(spark, scratch, "order_products_train", 2)
    assert first == second == [(47, 8, 1, 1, 2)]


def test_line_without_order_aborts(spark, scratch):
    orders, lines = _inputs(spark)
    lines["order_products_train"] = spark.createDataFrame([(66, 1, 1, 0)], LINE_COLS)
    with pytest.raises(Exception, match="no order_number"):
        split_waves(orders, lines, scratch)


def test_duplicate_order_id_in_lookup_is_rejected(spark, scratch):
    from cartwright.operators.joins import strict_lookup
    left = spark.createDataFrame([Row(order_id=1)])
    right = spark.createDataFrame([Row(order_id=1, order_number=1), Row(order_id=1, order_number=2)])
    with pytest.raises(ValueError):
        strict_lookup(left, right, "order_id", "order_number")
