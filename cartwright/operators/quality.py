"""Declarative data tests and the quality gate (Q1-Q6).

A test is a query whose failing rows are counted; any failure stops the run.
NULLs are ignored by ``unique``, ``relationships`` and ``accepted_values``.

Plan shape: all single-column tests of one model share one scan and one shuffle.
Its tested columns are tagged and counted per (column, value), with partial
aggregation that absorbs a hot value. Each test compares in the type SQL would: a
column's own, that of column and accepted values, or that of child and parent key; a
column that is tested in two types is counted in both. The counts answer ``not_null`` (rows of the
NULL), ``unique`` (values counted more than once), ``accepted_values`` (values outside
the list) and, after one join with the tagged keys of the parents, ``relationships``
(rows of values without a parent). Counts of partitions add up, so a partitioned model
can also be tested from counts kept per partition (:func:`evaluate_incremental`). A column that is only tested for NULLs is
counted in a plain aggregate instead. ``unique_combination`` is an aggregate of its own.
The gate runs everything as one job and brings back one row per test, never data rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DataType, DoubleType, FloatType, IntegerType, LongType, StringType, StructType

from cartwright import fixed
from cartwright.operators.key_index import key_index
from cartwright.operators.partition_state import Derived
from cartwright.sinks.loads import partitions_of

RESULT_COLUMNS = ["test_name", "kind", "model", "column_name", "n_failed"]


@dataclass(frozen=True)
class DataTest:
    kind: str  # not_null | unique | relationships | accepted_values | unique_combination
    model: str
    columns: tuple[str, ...]
    to_model: str | None = None
    to_column: str | None = None
    values: tuple = field(default_factory=tuple)

    @property
    def name(self) -> str:
        base = f"{self.kind}_{self.model}_{'__'.join(self.columns)}"
        return f"{base}__{self.to_model}" if self.kind == "relationships" else base

    @property
    def column_name(self) -> str:
        return ",".join(self.columns)


def _nn(model, col):
    return DataTest("not_null", model, (col,))


def _uq(model, col):
    return DataTest("unique", model, (col,))


def _rel(model, col, to_model, to_col=None):
    return DataTest("relationships", model, (col,), to_model, to_col or col)


# --- fixed values: the 21 tests declared for the marts ------------------------
MART_TESTS: tuple[DataTest, ...] = (
    _nn("fact_order_items", "product_key"), _rel("fact_order_items", "product_key", "dim_product"),
    _nn("fact_order_items", "user_key"), _rel("fact_order_items", "user_key", "dim_user"),
    _nn("fact_order_items", "time_key"), _rel("fact_order_items", "time_key", "dim_time"),
    DataTest("accepted_values", "fact_order_items", ("reordered",), values=tuple(fixed.REORDERED_VALUES)),
    DataTest("unique_combination", "fact_order_items", ("order_id", "product_id")),
    _uq("fact_orders", "order_id"), _nn("fact_orders", "order_id"),
    _rel("fact_orders", "user_key", "dim_user"),
    _uq("dim_product", "product_key"), _nn("dim_product", "product_key"),
    _uq("dim_user", "user_key"), _nn("dim_user", "user_key"),
    _uq("dim_time", "time_key"), _nn("dim_time", "time_key"),
    _uq("dim_food_product", "food_product_key"), _nn("dim_food_product", "food_product_key"),
    _uq("dim_food_product", "product_code"), _nn("dim_food_product", "product_code"),
)
# --- end of fixed values ------------------------------------------------------


def _result(test: DataTest, n_failed) -> list:
    return [F.lit(test.name).alias("test_name"), F.lit(test.kind).alias("kind"), F.lit(test.model).alias("model"),
            F.lit(test.column_name).alias("column_name"), n_failed.cast("long").alias("n_failed")]


def _unpivot(wide: DataFrame, tests: list[DataTest]) -> DataFrame:
    """One-row ``wide`` (columns t0..tn) -> one result row per test, in one plan."""
    rows = [F.struct(*_result(t, F.col(f"t{i}"))) for i, t in enumerate(tests)]
    return wide.select(F.inline(F.array(*rows)))


def _nulls(tests: list[DataTest], df: DataFrame) -> DataFrame:
    """``not_null`` tests of one model on columns without another test."""
    return _unpivot(df.agg(*[F.count_if(F.col(t.columns[0]).isNull()).alias(f"t{i}") for i, t in enumerate(tests)]), tests)


def _combination(test: DataTest, df: DataFrame) -> DataFrame:
    """Number of value combinations that occur more than once."""
    dupes = df.groupBy(*test.columns).count().where(F.col("count") > 1)
    return dupes.agg(F.count(F.lit(1)).alias("n")).select(*_result(test, F.col("n")))


def _common(spark: SparkSession, kinds: list[DataType]) -> DataType:
    """The type in which SQL compares values of these types."""
    if len({k.simpleString() for k in kinds}) == 1:
        return kinds[0]
    return spark.range(0).select(F.coalesce(*[F.lit(None).cast(k) for k in kinds])).schema[0].dataType


def _compared_as(test: DataTest, tables: dict[str, DataFrame]) -> DataType:
    df = tables[test.model]
    own = df.schema[test.columns[0]].dataType
    if test.kind == "relationships":
        return _common(df.sparkSession, [own, tables[test.to_model].schema[test.to_column].dataType])
    if test.kind == "accepted_values" and not isinstance(own, StringType):
        kinds = df.sparkSession.range(0).select(*[F.lit(v).alias(f"v{i}") for i, v in enumerate(test.values)]).schema
        return _common(df.sparkSession, [own, *[f.dataType for f in kinds]])
    return own


def _text(c: Column, kind: DataType) -> Column:
    """A value as text, one text per value of the type."""
    c = c.cast(kind)
    if isinstance(kind, (FloatType, DoubleType)):
        c = c + F.lit(0.0).cast(kind)  # one zero
    return F.hex(c) if isinstance(kind, BinaryType) else c.cast("string")


def _slots(tests: list[DataTest], tables: dict[str, DataFrame]) -> list[tuple[str, DataType]]:
    """The (column, compared type) pairs that ``tests`` of one model need, in order."""
    slots = {(t.columns[0], (k := _compared_as(t, tables)).simpleString()): k for t in tests}
    return [(c, slots[c, n]) for c, n in sorted(slots)]


def _slot(test: DataTest, slots: list[tuple[str, DataType]], tables: dict[str, DataFrame]) -> int:
    kind = _compared_as(test, tables).simpleString()
    return next(i for i, (c, k) in enumerate(slots) if c == test.columns[0] and k.simpleString() == kind)


def _value(slots: list[tuple[str, DataType]]):
    """How values are counted: as they are if all are of one type, else as text."""
    plain = len({k.simpleString() for _, k in slots}) == 1 and not isinstance(slots[0][1], (FloatType, DoubleType))
    return (lambda c, k: c.cast(k)) if plain else _text


def _tagged(df: DataFrame, slots: list[tuple[str, DataType]], value, *keep: str) -> DataFrame:
    rows = [F.struct(F.lit(i).alias("_c"), value(F.col(c), k).alias("_v")) for i, (c, k) in enumerate(slots)]
    return df.select(*keep, F.inline(F.array(*rows)))


def _parent_keys(tests: list[DataTest], slots: list[tuple[str, DataType]], value, tables: dict[str, DataFrame]) -> DataFrame | None:
    """The keys of the parents, by slot and place (``_p``) of the test among ``relationships``."""
    parents_of = [(t, _slot(t, slots, tables)) for t in tests if t.kind == "relationships"]
    keys = [tables[t.to_model].select(F.lit(at).alias("_c"), value(F.col(t.to_column), slots[at][1]).alias("_v"), F.lit(i).alias("_p"))
            for i, (t, at) in enumerate(parents_of)]
    return reduce(DataFrame.unionByName, keys).where(F.col("_v").isNotNull()) if keys else None


def _failed(tests: list[DataTest], counts: DataFrame, slots: list[tuple[str, DataType]], value,
            tables: dict[str, DataFrame], *by: str) -> DataFrame:
    """Numbers of failures t0..tn from rows counted by (slot, value), by the columns ``by``."""
    at = {t: _slot(t, slots, tables) for t in tests}
    parents_of = [t for t in tests if t.kind == "relationships"]
    if (keys := _parent_keys(tests, slots, value, tables)) is not None:
        known = keys.groupBy("_c", "_v").agg(F.collect_set("_p").alias("_parents"))
        counts = counts.join(known, ["_c", "_v"], "left")
    aggs = []
    for i, t in enumerate(tests):
        here = F.col("_c") == at[t]
        given = here & F.col("_v").isNotNull()
        if t.kind == "not_null":
            n = F.sum(F.when(here & F.col("_v").isNull(), F.col("_n")))
        elif t.kind == "unique":
            n = F.count_if(given & (F.col("_n") > 1))
        elif t.kind == "accepted_values":
            kind = slots[at[t]][1]
            values = [F.lit(str(v) if isinstance(kind, StringType) else v) for v in t.values]
            n = F.count_if(given & ~F.col("_v").isin(*[value(v, kind) for v in values]))
        else:
            has = F.coalesce(F.array_contains("_parents", parents_of.index(t)), F.lit(False))
            n = F.sum(F.when(given & ~has, F.col("_n")))
        aggs.append(F.coalesce(n, F.lit(0)).alias(f"t{i}"))
    return counts.groupBy(*by).agg(*aggs)


def _from_counts(tests: list[DataTest], counts: DataFrame, slots: list[tuple[str, DataType]], value,
                 tables: dict[str, DataFrame]) -> DataFrame:
    """Test results from rows counted by (slot, value)."""
    return _unpivot(_failed(tests, counts, slots, value, tables), tests)


def _by_value(tests: list[DataTest], df: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """Single-column tests of one model from its counts per (column, value)."""
    slots = _slots(tests, tables)
    value = _value(slots)
    counts = _tagged(df, slots, value).groupBy("_c", "_v").agg(F.count(F.lit(1)).alias("_n"))
    return _from_counts(tests, counts, slots, value, tables)


def evaluate(tests: list[DataTest] | tuple[DataTest, ...], tables: dict[str, DataFrame]) -> DataFrame:
    """One DataFrame with a row per test: RESULT_COLUMNS. A test whose model or
    parent model is not among ``tables`` is an error."""
    missing = sorted({m for t in tests for m in (t.model, t.to_model) if m is not None and m not in tables})
    if missing:
        raise KeyError(f"models to test are missing: {', '.join(missing)}")
    parts: list[DataFrame] = []
    for model in dict.fromkeys(t.model for t in tests):
        own = [t for t in tests if t.model == model]
        for t in own:
            if t.kind not in ("not_null", "unique", "relationships", "accepted_values", "unique_combination"):
                raise ValueError(f"unknown test kind {t.kind}")
        parts += [_combination(t, tables[model]) for t in own if t.kind == "unique_combination"]
        single = [t for t in own if t.kind != "unique_combination"]
        grouped = {t.columns[0] for t in single if t.kind != "not_null"}
        if nulls := [t for t in single if t.columns[0] not in grouped]:
            parts.append(_nulls(nulls, tables[model]))
        if valued := [t for t in single if t.columns[0] in grouped]:
            parts.append(_by_value(valued, tables[model], tables))
    return reduce(DataFrame.unionByName, parts)


# --- partitioned models, from what is kept per partition ---------------------------

_STATE = StructType().add("_c", IntegerType()).add("_v", BinaryType()).add("_n", LongType())
_HEX = "^(?:[0-9a-f]{2})+$"


def _packed(c: Column, kind: DataType) -> Column:
    """:func:`_text` in bytes, one sequence per value: hash keys take half of their digits."""
    text = _text(c, kind)
    return F.when(text.rlike(_HEX), F.concat(F.lit(b"\x00"), F.unhex(text))).otherwise(F.concat(F.lit(b"\x01"), F.encode(text, "UTF-8")))


def _state(target: str, column: str, tests: list[DataTest], slots: list[tuple[str, DataType]],
           pairs: list[DataTest]) -> Derived:
    """Per partition: rows by (slot, value); and for each ``unique_combination`` test the
    repeated combinations by leading value (slot -1 for the first such test, ...)."""
    def build(rows: DataFrame) -> DataFrame:
        parts = [_tagged(rows, slots, _packed, column).groupBy(column, "_c", "_v").agg(F.count(F.lit(1)).alias("_n"))] if slots else []
        for i, t in enumerate(pairs):
            lead = F.col(t.columns[0])
            again = rows.where(lead.isNotNull()).groupBy(column, *t.columns).agg(F.count(F.lit(1)).alias("_m")).where("_m > 1")
            parts.append(again.select(column, F.lit(-1 - i).alias("_c"), _packed(lead, StringType()).alias("_v"))
                         .groupBy(column, "_c", "_v").agg(F.count(F.lit(1)).alias("_n")))
        return reduce(DataFrame.unionByName, parts)

    version = repr([(t.name, t.values) for t in tests]) + repr([(c, k.simpleString()) for c, k in slots])
    return Derived(target, column, "tests", build, _STATE, ("_c", "_v"), version)


_FAILED = StructType().add("_c", IntegerType()).add("_n", LongType())


def _failures(spark: SparkSession, state: Derived, tests: list[DataTest], slots: list[tuple[str, DataType]],
              tables: dict[str, DataFrame]) -> Derived:
    """Per partition, the rows that fail each of ``tests`` (``_c``: its place), from the counted
    values. It is made anew for other parent keys: they are told apart by their number and
    two sums of hashes, 128 bits that do not depend on the order."""
    def build(counts: DataFrame) -> DataFrame:
        n = _failed(tests, counts.where("_c >= 0"), slots, _packed, tables, state.column)
        rows = [F.struct(F.lit(i).alias("_c"), F.col(f"t{i}").cast("long").alias("_n")) for i in range(len(tests))]
        return n.select(state.column, F.inline(F.array(*rows)))

    parents = []
    if (keys := _parent_keys(tests, slots, _packed, tables)) is not None:
        sums = [F.sum(F.xxhash64(F.lit(seed), "_v").cast("decimal(38,0)")).alias(f"h{seed}") for seed in (0, 1)]
        parents = sorted(map(str, keys.groupBy("_p").agg(F.count("_v").alias("n"), *sums).collect()))  # one row a test
    return Derived(state.path, state.column, "failed", build, _FAILED, ("_c",), repr([(t.name, t.to_column) for t in tests]) + repr(parents))


def evaluate_incremental(spark: SparkSession, tests: list[DataTest] | tuple[DataTest, ...], tables: dict[str, DataFrame],
                         target: str, column: str, staged: DataFrame | None = None,
                         affected: set[int] | tuple = ()) -> DataFrame:
    """The same result rows as :func:`evaluate` for ``tests`` of one model, the table at
    ``target`` partitioned by ``column``, reading only partitions that changed since the
    last time. With ``staged``, the table as it will be when the partitions ``affected``
    hold these rows.

    Failures of ``not_null`` and ``relationships`` are kept per partition, for the parents as
    they are now, and added up; for the other tests, the value counts of the partitions are
    added up. A combination can only be repeated across partitions if its leading value is in
    several of them; the key index names those, and their rows are counted once more.
    """
    tests = list(tests)
    table = _as_it_will_be(spark, target, column, staged, affected)
    tables = tables | {tests[0].model: table}
    pairs = [t for t in tests if t.kind == "unique_combination"]
    single = [t for t in tests if t.kind != "unique_combination"]
    slots = _slots(single, tables) if single else []
    state = _state(target, column, tests, slots, pairs)
    kept = state.read(spark, staged, affected)
    parts = []
    if rowwise := [t for t in single if t.kind in ("not_null", "relationships")]:
        failed = _failures(spark, state, rowwise, slots, tables).read(spark, state.build(staged) if staged is not None else None, affected)
        sums = [F.coalesce(F.sum(F.when(F.col("_c") == i, F.col("_n"))), F.lit(0)).alias(f"t{i}") for i in range(len(rowwise))]
        parts.append(_unpivot(failed.agg(*sums), rowwise))
    if valued := [t for t in single if t not in rowwise]:
        at = sorted({_slot(t, slots, tables) for t in valued})
        counts = kept.where(F.col("_c").isin(at)).groupBy("_c", "_v").agg(F.sum("_n").alias("_n"))
        parts.append(_from_counts(valued, counts, slots, _packed, tables))
    for i, t in enumerate(pairs):
        lead = t.columns[0]
        index = key_index(target, column, lead, table.schema[lead].dataType).read(spark, staged, affected)
        within, again = kept.where(F.col("_c") == -1 - i), table.where(F.col(lead).isNull())
        if at := _sharing(index, lead, column):
            shared = _shared(index.where(F.col(column).isin(at)), lead, column).select(lead)
            within = within.join(shared.select(_packed(F.col(lead), StringType()).alias("_v")), "_v", "left_anti")
            again = table.where(F.col(column).isin(at)).join(shared, lead, "left_semi").unionByName(again)
        across = again.groupBy(*t.columns).count().where("count > 1").agg(F.count(F.lit(1)).alias("n"))
        total = within.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n")).unionAll(across)
        parts.append(total.agg(F.sum("n").alias("n")).select(*_result(t, F.col("n"))))
    return reduce(DataFrame.unionByName, parts)


def _shared(index: DataFrame, lead: str, column: str) -> DataFrame:
    """The leading values that are in several partitions."""
    return index.groupBy(lead).agg(F.min(column).alias("lo"), F.max(column).alias("hi")).where("lo < hi")


def _sharing(index: DataFrame, lead: str, column: str) -> list:
    """The partitions that have a leading value in common with another one."""
    shared = _shared(index, lead, column)
    if not shared.select("lo", "hi").distinct().collect():  # as a rule
        return []
    return [r[0] for r in index.join(shared, lead, "left_semi").select(column).distinct().collect()]  # one value a partition


def _as_it_will_be(spark: SparkSession, target: str, column: str, staged: DataFrame | None, affected) -> DataFrame:
    if staged is not None and not partitions_of(spark, target, column):
        return staged
    table = spark.read.parquet(target)
    if staged is None:
        return table
    return table.where(~F.col(column).isin(sorted(affected))).unionByName(staged.select(*table.columns))


# --- tests while writing -------------------------------------------------------------

class Watch:
    """Counts the rows that fail the ``not_null`` and ``accepted_values`` tests of a model
    while it is written; these tests then need no scan of their own."""

    def __init__(self, model: str, tests: list[DataTest] | tuple[DataTest, ...]) -> None:
        self.tests = [t for t in tests if t.model == model and t.kind in ("not_null", "accepted_values")]
        self.observation = Observation()

    def __call__(self, df: DataFrame) -> DataFrame:
        aggs = []
        for i, t in enumerate(self.tests):
            c = F.col(t.columns[0])
            kind = df.schema[t.columns[0]].dataType
            values = [str(v) for v in t.values] if isinstance(kind, StringType) else list(t.values)
            bad = c.isNull() if t.kind == "not_null" else c.isNotNull() & ~c.isin(*values)
            aggs.append(F.count_if(bad).alias(f"t{i}"))
        return df.observe(self.observation, *aggs) if aggs else df

    def passed(self) -> list[DataTest]:
        """The tests that no written row fails (a task that ran twice may count a row
        twice, so only zero is taken from here)."""
        found = self.observation.get if self.tests else {}
        return [t for i, t in enumerate(self.tests) if found[f"t{i}"] == 0]


class DataQualityError(RuntimeError):
    def __init__(self, failures: list[tuple[str, int]]):
        self.failures = failures
        super().__init__("data tests failed: " + ", ".join(f"{n} ({k} rows)" for n, k in failures))


def gate(results: DataFrame) -> list[tuple[str, int]]:
    """Q6: run all tests as one job; raise if any test has failures.

    Collects one small row per test (bounded by the number of tests)."""
    rows = results.select("test_name", "n_failed").collect()
    failures = sorted((r.test_name, r.n_failed) for r in rows if r.n_failed)
    if failures:
        raise DataQualityError(failures)
    return sorted((r.test_name, r.n_failed) for r in rows)
