"""Killed swaps, the key index, tests before publishing, maintained models, ledgers."""
import pytest
from pyspark.sql import functions as F

from cartwright import contracts, session
from cartwright.operators import quality
from cartwright.operators.incremental import delete_insert
from cartwright.operators.key_index import key_index
from cartwright.plans.maintained import MANIFEST, LatestProducts, UserTotals
from cartwright.plans.models import Models
from cartwright.raw import RawLayer
from cartwright.session import list_names, move, path_exists, recover, remove, write_and_swap, write_pending, write_pending_partitions
from cartwright.sinks.load_ledger import ingest_with_history, read_history
from cartwright.sinks.loads import load_wave, load_waves, partitions_of
from cartwright.sources.pull_ledger import PullLedger, merged


def _ids(spark, path):
    return sorted(r[0] for r in spark.read.parquet(path).select("id").collect())


# --- swaps -----------------------------------------------------------------------

@pytest.mark.parametrize("stop_at", range(6))
def test_a_swap_that_stops_anywhere_is_old_or_new(spark, scratch, monkeypatch, stop_at):
    """The process stops before its n-th change of the file system."""
    target = f"{scratch}/t{stop_at}/table"
    write_and_swap(spark.range(3), target)
    calls = iter(range(100))

    def stopping(real):
        def run(*a):
            if next(calls) >= stop_at:
                raise KeyboardInterrupt
            return real(*a)
        return run

    fresh = write_pending(spark.range(10, 14), target)
    with monkeypatch.context() as m:
        m.setattr(session, "move", stopping(session.move))
        m.setattr(session, "remove", stopping(session.remove))
        try:
            fresh.publish()
        except KeyboardInterrupt:
            pass
    recover(spark, target.rsplit("/", 1)[0])
    assert _ids(spark, target) == ([0, 1, 2] if stop_at == 0 else [10, 11, 12, 13])
    assert [n for n in list_names(spark, f"{scratch}/t{stop_at}") if n.startswith((".ready", ".old"))] == []


@pytest.mark.parametrize("stop_at", range(9))
def test_partitions_change_together_wherever_the_process_stops(spark, scratch, monkeypatch, stop_at):
    target = f"{scratch}/p{stop_at}/table"
    rows = spark.range(9).withColumn("p", (F.col("id") % 3).cast("int"))
    write_pending_partitions(rows, target, "p", []).publish()
    calls = iter(range(100))

    def stopping(real):
        def run(*a):
            if next(calls) >= stop_at:
                raise KeyboardInterrupt
            return real(*a)
        return run

    fresh = write_pending_partitions(spark.createDataFrame([(100, 0), (101, 1), (103, 3)], "id long, p int"), target, "p", [0, 1, 2])
    with monkeypatch.context() as m:
        m.setattr(session, "move", stopping(session.move))
        m.setattr(session, "remove", stopping(session.remove))
        try:
            fresh.publish()
        except KeyboardInterrupt:
            pass
    recover(spark, target)
    assert _ids(spark, target) == (list(range(9)) if stop_at == 0 else [100, 101, 103])
    assert sorted(partitions_of(spark, target, "p")) == (["0", "1", "2"] if stop_at == 0 else ["0", "1", "3"])


def test_a_failed_write_leaves_nothing_behind(spark, scratch):
    target = f"{scratch}/f/table"
    write_and_swap(spark.range(3), target)
    with pytest.raises(Exception, match="bad record"):
        write_and_swap(spark.range(3).withColumn("id", F.raise_error(F.lit("bad record")).cast("long")), target)
    assert _ids(spark, target) == [0, 1, 2] and list_names(spark, f"{scratch}/f") == ["table"]


def test_a_first_write_that_stops_is_finished(spark, scratch):
    target = f"{scratch}/first/table"
    fresh = write_pending(spark.range(2), target)
    move(spark, fresh.path, f"{scratch}/first/.ready-table")
    recover(spark, target)
    assert _ids(spark, target) == [0, 1]


def test_waves_of_a_single_load_after_a_stop(spark, scratch):
    c = contracts.table("order_products_prior")
    lines = spark.createDataFrame([(1, 5, 1, 0, 1), (2, 5, 1, 0, 2)], c.schema())
    target = f"{scratch}/lines"
    load_waves(spark, lines, c, [1, 2], target)
    fresh = write_pending(lines.limit(0).withColumn("_loaded_at", F.current_timestamp()).drop("order_number"), f"{target}/order_number=1")
    move(spark, fresh.path, f"{target}/.ready-order_number=1")
    move(spark, f"{target}/order_number=1", f"{target}/.old-order_number=1")
    load_wave(spark, lines.where("order_number = 2").withColumn("product_id", F.lit(9)), c, 2, target)
    assert partitions_of(spark, target, "order_number")["2"].endswith("order_number=2")
    assert [tuple(r) for r in spark.read.parquet(target).select("order_id", "product_id").collect()] == [(2, 9)]


# --- key index and tests per partition -----------------------------------------------

FACT = "order_id long, product_id int, flag int, key string, wave int"
COLS = ["order_id", "product_id", "flag", "key", "wave"]


def _fact(spark, rows):
    return spark.createDataFrame(rows, FACT)


def _scans(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("FileScan parquet")


def test_key_index_follows_the_table(spark, scratch):
    target = f"{scratch}/fact"
    delete_insert(spark, _fact(spark, [(1, 1, 0, "a", 1), (2, 1, 0, "a", 2), (None, 1, 0, "a", 2)]), target, COLS[:2], "wave", COLS)
    index = key_index(target, "wave", "order_id", _fact(spark, []).schema["order_id"].dataType)
    read = lambda: sorted(tuple(r) for r in index.read(spark).collect())
    assert read() == [(1, 1), (2, 2)] and index.refresh(spark)[1] == []
    delete_insert(spark, _fact(spark, [(1, 1, 1, "b", 3), (4, 1, 1, "b", 3)]), target, COLS[:2], "wave", COLS)
    assert read() == [(1, 3), (2, 2), (4, 3)]
    remove(spark, index.path)
    assert read() == [(1, 3), (2, 2), (4, 3)] and index.refresh(spark)[1] == []
    load = spark.read.parquet(target).where("wave = 2").withColumn("order_id", F.lit(7).cast("long"))
    write_pending_partitions(load.select(*COLS), target, "wave", [2]).publish()  # behind the index's back
    assert index.refresh(spark)[1] == [2] and read() == [(1, 3), (4, 3), (7, 2)]


def test_batches_of_new_keys_do_not_open_the_table(spark, scratch, monkeypatch):
    from cartwright.operators import incremental

    target = f"{scratch}/fact"
    delete_insert(spark, _fact(spark, [(i, 1, 0, "a", 1) for i in range(20)]), target, COLS[:2], "wave", COLS)
    seen = []
    monkeypatch.setattr(incremental, "write_pending_partitions",
                        lambda df, *a, **k: seen.append(_scans(df)) or write_pending_partitions(df, *a, **k))
    delete_insert(spark, _fact(spark, [(100 + i, 1, 0, "a", 2) for i in range(20)]), target, COLS[:2], "wave", COLS)
    assert seen == [1]  # the written batch
    assert spark.read.parquet(target).count() == 40


TESTS = (quality.DataTest("not_null", "fact", ("key",)), quality.DataTest("accepted_values", "fact", ("flag",), values=(0, 1)),
         quality.DataTest("relationships", "fact", ("key",), "dim", "k"), quality.DataTest("unique", "fact", ("order_id",)),
         quality.DataTest("unique_combination", "fact", ("order_id", "product_id")))


def test_incremental_tests_equal_full_ones(spark, scratch, monkeypatch):
    target = f"{scratch}/fact"
    dim = spark.createDataFrame([("a",), ("b",)], "k string")
    steps = [
        ([(1, 1, 0, "a", 1), (1, 2, 0, "b", 1), (2, 1, 1, "a", 2)], [1, 2]),
        ([(3, 1, 5, "x", 3), (3, 1, 7, None, 3), (None, None, 0, "a", 3), (None, None, 0, "a", 3)], [3]),
        ([(1, 1, 0, "a", 4), (2, 9, 0, "a", 4), (None, None, 0, "a", 4)], [4]),  # keys of other partitions
        ([(2, 1, 1, "b", 2)], [2]), ([], [3]),
    ]
    built = []
    real = quality.Derived._build
    monkeypatch.setattr(quality.Derived, "_build", lambda self, s, sigs: built.append((self.state, sorted(sigs))) or real(self, s, sigs))
    for rows, waves in steps:
        write_pending_partitions(_fact(spark, rows), target, "wave", waves).publish()
        whole = {"fact": spark.read.parquet(target), "dim": dim}
        want = sorted(map(tuple, quality.evaluate(TESTS, whole).collect()))
        built.clear()
        assert sorted(map(tuple, quality.evaluate_incremental(spark, TESTS, {"dim": dim}, target, "wave").collect())) == want
        changed = [w for w in waves if str(w) in partitions_of(spark, target, "wave")]
        assert [s for s in built if s[0] == "tests"] == ([("tests", changed)] if changed else [])
    # a staged partition is tested as if it were there
    staged = _fact(spark, [(9, 9, 9, "zz", 1)])
    will_be = spark.read.parquet(target).where("wave <> 1").unionByName(staged)
    want = sorted(map(tuple, quality.evaluate(TESTS, {"fact": will_be, "dim": dim}).collect()))
    got = quality.evaluate_incremental(spark, TESTS, {"dim": dim}, target, "wave", staged, {1})
    assert sorted(map(tuple, got.collect())) == want
    # another list of values is another state
    other = (quality.DataTest("accepted_values", "fact", ("flag",), values=(0,)),)
    want = [tuple(r) for r in quality.evaluate(other, {"fact": spark.read.parquet(target)}).collect()]
    assert [tuple(r) for r in quality.evaluate_incremental(spark, other, {}, target, "wave").collect()] == want


def test_kept_values_are_packed_and_stay_apart(spark, scratch):
    """Hash keys are kept in half of their digits; no two texts become one."""
    target, md5 = f"{scratch}/fact", "0123456789abcdef" * 2
    keys = [md5, md5.upper(), md5[1:], "00", "0", "\x00", "", "a", "ä", "61", None]
    write_pending_partitions(_fact(spark, [(i, 1, 0, k, 1 + i % 2) for i, k in enumerate(keys)]), target, "wave", [1, 2]).publish()
    for known in ([md5, "61"], [md5.upper(), "a", "\x00"], [k for k in keys if k is not None]):
        dim = spark.createDataFrame([(k,) for k in known], "k string")
        want = sorted(map(tuple, quality.evaluate(TESTS, {"fact": spark.read.parquet(target), "dim": dim}).collect()))
        assert sorted(map(tuple, quality.evaluate_incremental(spark, TESTS, {"dim": dim}, target, "wave").collect())) == want
    kept = spark.read.parquet(f"{scratch}/.tests-fact").where(F.length("_v") == 17)
    assert kept.where(F.lower(F.hex("_v")) == "00" + md5).count() == 1


def test_failures_of_unchanged_partitions_are_kept_for_the_same_parents(spark, scratch, monkeypatch):
    target, built = f"{scratch}/fact", []
    real = quality.Derived._build
    monkeypatch.setattr(quality.Derived, "_build", lambda self, s, sigs: built.append((self.state, sorted(sigs))) or real(self, s, sigs))
    write_pending_partitions(_fact(spark, [(w, 1, 0, "ab"[w % 2], w) for w in (1, 2, 3)]), target, "wave", [1, 2, 3]).publish()
    for keys, again in ((["a", None], [1, 2, 3]), ([None, "a"], []), (["b"], [1, 2, 3]), (["a", "b"], [1, 2, 3])):
        dim = spark.createDataFrame([(k,) for k in keys], "k string")
        built.clear()
        got = sorted(map(tuple, quality.evaluate_incremental(spark, TESTS, {"dim": dim}, target, "wave").collect()))
        assert got == sorted(map(tuple, quality.evaluate(TESTS, {"fact": spark.read.parquet(target), "dim": dim}).collect()))
        assert [w for state, w in built if state == "failed"] == ([again] if again else [])
    write_pending_partitions(_fact(spark, [(2, 1, 0, "z", 2)]), target, "wave", [2]).publish()
    built.clear()
    assert {r.kind: r.n_failed for r in quality.evaluate_incremental(spark, TESTS, {"dim": dim}, target, "wave").collect()}["relationships"] == 1
    assert ("failed", [2]) in built


def test_table_is_opened_only_where_keys_are_shared(spark, scratch):
    target = f"{scratch}/fact"
    write_pending_partitions(_fact(spark, [(w, 1, 0, "a", w) for w in (1, 2, 3, 4)]), target, "wave", [1, 2, 3, 4]).publish()
    index = key_index(target, "wave", "order_id", _fact(spark, []).schema["order_id"].dataType)
    assert quality._sharing(index.read(spark), "order_id", "wave") == []
    pair = [t for t in TESTS if t.kind == "unique_combination"]
    assert quality.evaluate_incremental(spark, pair, {}, target, "wave").collect()[0].n_failed == 0
    more = [(2, 1, 0, "a", 2), (4, 1, 0, "a", 2), (2, 1, 0, "a", 2)]
    write_pending_partitions(_fact(spark, more), target, "wave", [2], balance=False).publish()
    assert sorted(quality._sharing(index.read(spark), "order_id", "wave")) == [2, 4]
    assert quality.evaluate_incremental(spark, pair, {}, target, "wave").collect()[0].n_failed == 2


def test_rows_of_partition_files_are_written_without_a_shuffle(spark, scratch, monkeypatch):
    target, plans = f"{scratch}/fact", []
    write_pending_partitions(_fact(spark, [(w, p, 0, "a", w) for w in (1, 2) for p in (2, 1)]), target, "wave", [1, 2]).publish()
    real = type(spark.range(0)).sortWithinPartitions
    monkeypatch.setattr(type(spark.range(0)), "sortWithinPartitions",
                        lambda df, *a, **k: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or real(df, *a, **k))
    rows = spark.read.parquet(target).withColumn("v", F.lit(1))
    write_pending_partitions(rows, f"{scratch}/copy", "wave", [1, 2], "order_id", balance=False).publish()
    assert len(plans) == 1 and "Rebalance" not in plans[0] and "Repartition" not in plans[0]
    assert spark.read.parquet(f"{scratch}/copy").select(*rows.columns).exceptAll(rows).isEmpty()
    assert spark.read.parquet(f"{scratch}/copy").count() == 4


def test_values_compare_in_their_own_type(spark):
    child = spark.createDataFrame([(1, 0.0, "x", -0.0), (2, 1.0, None, 0.0), (None, None, "y", 1.5)], "k int, d double, s string, z double")
    parent = spark.createDataFrame([(1.0, 1), (2.0, 3)], "k double, n long")
    tests = [quality.DataTest("accepted_values", "c", ("d",), values=(0, 1)), quality.DataTest("accepted_values", "c", ("s",), values=("x",)),
             quality.DataTest("relationships", "c", ("k",), "p", "k"), quality.DataTest("relationships", "c", ("d",), "p", "n"),
             quality.DataTest("unique", "c", ("z",)), quality.DataTest("accepted_values", "c", ("k",), values=(1, 2.5)),
             quality.DataTest("unique", "c", ("k",)), quality.DataTest("not_null", "c", ("s",))]
    got = [r["n_failed"] for r in quality.evaluate(tests, {"c": child, "p": parent}).collect()]
    names = [r["test_name"] for r in quality.evaluate(tests, {"c": child, "p": parent}).collect()]
    want = {t.name: n for t, n in zip(tests, (0, 1, 0, 1, 1, 1, 0, 1))}
    assert dict(zip(names, got)) == want


def test_watched_rows(spark, scratch):
    watch = quality.Watch("fact", TESTS)
    write_and_swap(watch(_fact(spark, [(1, 1, 0, None, 1), (2, 1, None, "a", 1)])), f"{scratch}/watched")
    assert watch.passed() == [TESTS[1]]
    assert quality.Watch("other", TESTS).passed() == []


# --- maintained models ---------------------------------------------------------------

def _raw(spark, root, orders, lines):
    o, p, t = (contracts.table(n) for n in ("orders", "order_products_prior", "order_products_train"))
    tables = {o: orders, p: [x for x in lines if x[0] % 2], t: [x for x in lines if not x[0] % 2]}
    waves = sorted({r[3] for r in orders} | {r[4] for r in lines} | set(range(1, 6)))
    for c, rows in tables.items():
        load_waves(spark, spark.createDataFrame(rows, c.schema()), c, waves, f"{root}/{c.name}")


def _rebuilt(spark, orders, lines):
    df = lambda n, rows: spark.createDataFrame(rows, contracts.table(n).schema())
    none = {c.name: df(c.name, []) for c in contracts.FULL_TABLES}
    raw = RawLayer(df("orders", orders), df("order_products_prior", [x for x in lines if x[0] % 2]),
                   df("order_products_train", [x for x in lines if not x[0] % 2]), off_products_raw=None, **none)
    return sorted(map(tuple, Models(spark, raw).int_user_metrics.collect()))


def test_user_totals_follow_new_corrected_and_emptied_waves(spark, scratch):
    from decimal import Decimal

    root = f"{scratch}/raw"
    totals = UserTotals(spark, root, f"{scratch}/totals")
    orders = [(10 * u + n, u, "test" if u == 4 and n == 2 else "prior", n, 1, 2, None if n == 1 else Decimal(3 * n + u))
              for u in range(1, 6) for n in range(1, 1 + u)]
    lines = [(o[0], k, k, k % 2, o[3]) for o in orders for k in range(o[0] % 4)]
    steps = [
        ([o for o in orders if o[3] <= 2], [x for x in lines if x[4] <= 2]), (orders, lines), (orders, lines),
        (orders, [x for x in lines if x[4] != 2]), ([o for o in orders if o[3] != 3], [x for x in lines if x[4] not in (2, 3)]),
        (orders, [(*x[:4], 5 if x[4] == 1 and x[1] else x[4]) for x in lines]),  # lines in another wave than their order
        (orders, [(*x[:4], 4 if x[4] == 1 else x[4]) for x in lines]), (orders, lines),
    ]
    for i, (o, x) in enumerate(steps):
        _raw(spark, root, o, x)
        touched = totals.refresh()
        assert sorted(map(tuple, totals.metrics().collect())) == _rebuilt(spark, o, x)
        if i == 3:  # wave 2 has users 2 to 5 only
            users = spark.read.parquet(f"{scratch}/totals").where(f"bucket <> {MANIFEST} AND user_id > 1").select("bucket").distinct()
            assert set(touched) <= {r[0] for r in users.collect()}
    assert totals.refresh() == []
    remove(spark, totals.partials.path)  # the old rows are lost
    _raw(spark, root, orders, lines[:5])
    totals.refresh()
    assert sorted(map(tuple, totals.metrics().collect())) == _rebuilt(spark, orders, lines[:5])


def _versions(spark, rows):
    df = spark.createDataFrame(rows, "code string, name string, t long, seq long")
    obj = F.to_variant_object(F.struct("code", F.col("name").alias("product_name"), F.col("t").alias("last_modified_t")))
    return df.select(obj.alias("payload"), F.col("t").alias("last_modified_t"), F.col("seq").alias("feed_seq"),
                     F.lit(None).cast("timestamp").alias("_loaded_at"))


def test_latest_products_merge_ties_and_late_versions(spark, scratch):
    feed = f"{scratch}/feed"
    latest = LatestProducts(spark, feed, f"{scratch}/latest")
    loads = [[("a", "a1", 5, 1), ("b", "b1", 5, 2), ("", "blank", 9, 3)], [("a", "old", 4, 9), ("b", "tie", 5, 8)],
             [("c", "c1", 1, 1), ("a", "a1", 5, 1)], [("c", "null time", None, None)]]
    for i, rows in enumerate(loads):
        _versions(spark, rows).coalesce(1).write.mode("append").parquet(feed)
        touched = latest.refresh()
        assert i == 0 or len(touched) <= 2
        whole = Models(spark, RawLayer(*[None] * 6, spark.read.schema(contracts.FEED_RAW_SCHEMA).parquet(feed))).stg_off_products
        cols = ["product_code", "product_name", "last_modified_t"]
        assert sorted(map(tuple, latest.products().select(*cols).collect())) == sorted(map(tuple, whole.select(*cols).collect()))
    assert latest.refresh() == []


def test_payload_reads_scan_named_fields(spark, scratch):
    """Shredded VARIANT: the scan of rows with a feed position has no whole payload."""
    from cartwright.plans.staging import parse_off_products

    _versions(spark, [("a", "a1", 5, 1), ("b", "b1", 6, 2)]).write.parquet(f"{scratch}/shredded")
    raw = spark.read.schema(contracts.FEED_RAW_SCHEMA).parquet(f"{scratch}/shredded")
    plan = parse_off_products(raw).select("product_code", "product_name")._jdf.queryExecution().executedPlan().toString()
    schemas = [line for line in plan.split("ReadSchema: ")[1:]]
    assert schemas and all("payload:struct<0:string" in x for x in schemas) and "payload:variant" not in plan
    names = sorted(r["product_name"] for r in parse_off_products(raw).collect())
    assert names == ["a1", "b1"]


# --- ledgers ---------------------------------------------------------------------------

def test_intervals():
    a, b, c, d = (1, 0), (2, 5), (2, 9), (7, 1)
    assert merged([(c, d), (a, b)]) == [(a, b), (c, d)]
    assert merged([(a, c), (b, d)]) == [(a, d)] == merged([(a, d), (b, c)])


def _landed(spark, landing):
    from cartwright.sources.json_arrays import read_json_arrays

    return sorted(r["feed_seq"] for r in read_json_arrays(spark, landing).select("feed_seq").collect())


def test_pulls_fill_gaps_and_look_at_the_last_second_again(spark, scratch):
    landing = f"{scratch}/landing"
    ledger = PullLedger(spark, f"{scratch}/pulls", landing)
    contract = contracts.FeedContract(page_size=3, max_pages=1)
    when = F.timestamp_seconds(F.lit(0))
    rows = [("p", f"v{i}", 10 + i // 2, i) for i in range(10)]
    assert ledger.pull(_versions(spark, rows), when, contract) == 3
    assert _landed(spark, landing) == [7, 8, 9]
    rows += [("p", "newer", 20, 10), ("p", "late in the second", 14, -1)]
    assert ledger.pull(_versions(spark, rows), when, contract) == 3
    assert _landed(spark, landing) == [-1, 6, 7, 8, 9, 10] and len(ledger.intervals()) == 1
    rows += [("p", "late again", 20, 3), ("p", "no time", None, 77)]
    while ledger.pull(_versions(spark, rows), when, contract):
        pass
    assert _landed(spark, landing) == [-1, 0, 1, 2, 3, 3, 4, 5, 6, 7, 8, 9, 10]
    assert ledger.pull(_versions(spark, rows + [("p", "x", 21, 30)]), when, capped=False) == 1
    assert ledger.pull(_versions(spark, rows), when, capped=False) == 0


def _positions(spark, pairs):
    return spark.createDataFrame(pairs, "t long, s long").select(F.struct("t", "s").alias("_p"))


@pytest.mark.parametrize("cap", [1, 7, 50, 99, 100, 150, 400, 401, 500])
def test_newest_rows_by_counts_are_those_of_a_sort(spark, cap):
    from cartwright.sources.pull_ledger import newest_rows

    pairs = [(i * 10**12, i) for i in range(-50, 50)] + [(10**13, s * 10**9) for s in range(300)] + [(7, 7)]
    got = sorted((tuple(r["_p"]) for r in newest_rows(_positions(spark, pairs), cap).collect()), reverse=True)
    assert got == sorted(pairs, reverse=True)[:cap]


def test_newest_rows_of_one_position_are_cut(spark):
    from cartwright.sources.pull_ledger import newest_rows

    got = [tuple(r["_p"]) for r in newest_rows(_positions(spark, [(5, 1)] * 9 + [(6, 0), (4, 2)]), 5).collect()]
    assert sorted(got) == [(5, 1)] * 4 + [(6, 0)]


def test_a_capped_pull_brings_no_sorted_rows_to_one_task(spark):
    from cartwright.sources.pull_ledger import newest_rows

    plan = newest_rows(_positions(spark, [(i, i) for i in range(100)]), 40)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrdered" not in plan and "Sort" not in plan and "Limit" not in plan


def test_load_history(spark, scratch):
    landing, target, history = f"{scratch}/l/in", f"{scratch}/l/out", f"{scratch}/l/history"
    assert ingest_with_history(spark, landing, target, history) == []
    write = lambda rows, name: spark.createDataFrame([(r,) for r in rows], "value string").coalesce(1).write.mode("overwrite").text(
        f"{landing}/dt={name}")
    write(['[{"code":"a","last_modified_t":1},{"code":"b","last_modified_t":2}]', '{"code":"c","last_modified_t":3}'], "one")
    assert len(ingest_with_history(spark, landing, target, history)) == 1
    assert ingest_with_history(spark, landing, target, history) == []
    write(['{"code":"d","last_modified_t":4}'], "two")
    assert len(ingest_with_history(spark, landing, target, history)) == 1
    spark.range(1).write.parquet(f"{target}/load_id=9")  # stopped
    assert ingest_with_history(spark, landing, target, history) == [] and not path_exists(spark, f"{target}/load_id=9")
    codes = spark.read.schema(contracts.FEED_RAW_SCHEMA).parquet(target).select(F.variant_get("payload", "$.code", "string")).collect()
    assert sorted(r[0] for r in codes) == ["a", "b", "c", "d"]
    assert sorted(r["n_lines"] for r in read_history(spark, history).collect()) == [1, 2]
