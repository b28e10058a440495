"""Models that follow their sources instead of being built anew (M8, M10; W1, M6, M12).

*User metrics.* Each wave of orders has one row per user with counts and sums of that
wave (:func:`user_partials`, kept per partition). All metrics of a user are ratios of sums
over its orders, an order being in one wave, so totals are brought up to date by taking
away the old rows of a changed wave and adding the new ones.

*Latest product versions.* The newest version of every product, in the total order of the
staging model; new rows of the feed table are merged in.

Both tables are partitioned by a hash ``bucket`` of their key, and only buckets with a key
that changed are rewritten. The bucket ``MANIFEST`` lists what the table holds (waves with
their signatures, files of the feed table); it is swapped in together with the others, so
that a run that stops midway is either not there or complete. A table that is lost, or
whose old rows are, is built from everything.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from cartwright import contracts, fixed
from cartwright.functions.scalars import exact_round_ratio
from cartwright.operators.partition_state import Derived
from cartwright.plans.staging import OFF_PRODUCT_COLUMNS, latest_version, parse_off_products, stg_orders
from cartwright.session import list_names, path_exists, recover, write_pending_partitions

MANIFEST = -1
BUCKETS = 64

_SUMS = ("orders", "days", "gaps", "baskets", "items", "again")
_TOTALS = StructType().add("user_id", LongType())
for _c in _SUMS:
    _TOTALS = _TOTALS.add(_c, LongType())


def _bucket(key: str):
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


# --- user metrics (E4-E8, M8, M10) ------------------------------------------------------

def _per_order(lines: DataFrame) -> DataFrame:
    return lines.groupBy("order_number", "order_id").agg(F.count(F.lit(1)).alias("n"), F.sum("reordered").alias("r"))


def _line_tables(raw_root: str) -> tuple[tuple[str, StructType], ...]:
    return tuple((f"{raw_root}/{name}", contracts.table(name).schema()) for name in contracts.LINE_TABLES)


def user_partials(raw_root: str) -> Derived:
    """Sums per (wave, user) over the wave's completed orders and the lines that lie in
    the same wave."""
    def build(orders: DataFrame, prior: DataFrame, train: DataFrame) -> DataFrame:
        lines = _per_order(prior.unionByName(train)).withColumnRenamed("order_number", "w").withColumnRenamed("order_id", "o")
        kept = stg_orders(orders)
        joined = kept.join(lines, (F.col("o") == kept["order_id"]) & (F.col("w") == kept["order_number"]), "left")
        days = F.sum("days_since_prior_order")
        return joined.groupBy("order_number", "user_id").agg(
            F.count(F.lit(1)).alias("orders"), F.coalesce(days, F.lit(0)).cast("long").alias("days"),
            F.count("days_since_prior_order").alias("gaps"), F.count("n").alias("baskets"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("items"), F.coalesce(F.sum("r"), F.lit(0)).alias("again"))

    return Derived(f"{raw_root}/orders", "order_number", "users", build, _TOTALS, ("user_id",), "1",
                   also=_line_tables(raw_root))


def _strays(raw_root: str, name: str) -> Derived:
    """Lines per order that lie in another wave than their order (none, if the split did
    its work)."""
    def build(lines: DataFrame, orders: DataFrame) -> DataFrame:
        return _per_order(lines).join(orders.select("order_id", "order_number"), ["order_id", "order_number"], "left_anti")

    schema = StructType().add("order_id", LongType()).add("n", LongType()).add("r", LongType())
    return Derived(f"{raw_root}/{name}", "order_number", "strays", build, schema, ("order_id",), "1",
                   also=((f"{raw_root}/orders", contracts.table("orders").schema()),))


class UserTotals:
    """Totals per user at ``path``, following the raw tables below ``raw_root``."""

    def __init__(self, spark: SparkSession, raw_root: str, path: str) -> None:
        self.spark, self.raw_root, self.path = spark, raw_root, path
        self.partials = user_partials(raw_root)
        self.schema = StructType(list(_TOTALS.fields)).add("wave", "string").add("sig", "string").add("bucket", "integer")

    def _table(self) -> DataFrame:
        recover(self.spark, self.path)
        if not path_exists(self.spark, self.path):
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(self.path)

    def refresh(self) -> list[int]:
        """Bring the totals up to date; the buckets that were rewritten."""
        spark = self.spark
        want, _ = self.partials.make(spark)
        table = self._table()
        held = {r["wave"]: r["sig"] for r in table.where(F.col("bucket") == MANIFEST).select("wave", "sig").collect()}  # waves
        if not self.partials.has(spark, held):
            held, table = {}, table.limit(0)  # old rows are lost: from everything
        changed = [v for v in {**want, **held} if want.get(v) != held.get(v)]
        if not changed and path_exists(spark, self.path):
            return []
        new = self.partials.rows(spark, {v: want[v] for v in changed if v in want})
        old = self.partials.rows(spark, {v: held[v] for v in changed if v in held})
        less = old.select("user_id", *[(-F.col(c)).alias(c) for c in _SUMS])
        delta = new.select("user_id", *_SUMS).unionByName(less).groupBy("user_id").agg(*[F.sum(c).alias(c) for c in _SUMS])
        moved = F.lit(False)
        for c in _SUMS:
            moved = moved | (F.col(c) != 0)
        delta = delta.where(moved).withColumn("bucket", _bucket("user_id"))
        whole = not held
        touched = list(range(BUCKETS)) if whole else sorted(r[0] for r in delta.select("bucket").distinct().collect())
        before = table.where(F.col("bucket").isin(touched)).select("user_id", *_SUMS, "bucket")
        after = before.unionByName(delta).groupBy("user_id", "bucket").agg(*[F.sum(c).alias(c) for c in _SUMS]).where("orders > 0")
        none = F.lit(None).cast("string")
        after = after.select("user_id", *_SUMS, none.alias("wave"), none.alias("sig"), "bucket")
        listed = spark.createDataFrame([(None,) * (1 + len(_SUMS)) + (v, sig, MANIFEST) for v, sig in want.items()], self.schema)
        write_pending_partitions(after.unionByName(listed), self.path, "bucket", [*touched, MANIFEST], "user_id").publish()
        self.partials.drop_stale(spark, want)
        return touched

    def metrics(self) -> DataFrame:
        """int_user_metrics from the totals, lines that lie in another wave included."""
        spark = self.spark
        totals = self._table().where(F.col("bucket") != MANIFEST).select("user_id", *_SUMS)
        strays = [_strays(self.raw_root, name).read(spark) for name in contracts.LINE_TABLES]
        strays = strays[0].unionByName(strays[1]).groupBy("order_id").agg(F.sum("n").alias("items"), F.sum("r").alias("again"))
        if not strays.isEmpty():
            totals = totals.unionByName(self._of_strays(strays)).groupBy("user_id").agg(*[F.sum(c).alias(c) for c in _SUMS])
        bought = F.when(F.col("baskets") > 0, F.col("items"))
        return totals.select(
            "user_id", F.col("orders").alias("total_orders"),
            exact_round_ratio(F.col("days"), F.col("gaps"), 2).alias("avg_days_between_orders"),
            bought.alias("total_items_purchased"),
            exact_round_ratio(F.col("items"), F.col("baskets"), 2).alias("avg_basket_size"),
            exact_round_ratio(F.col("again"), F.col("items"), 4).alias("reorder_ratio"))

    def _of_strays(self, strays: DataFrame) -> DataFrame:
        """What stray lines add to their users: items, and a basket where the order has no
        line in its own wave."""
        spark = self.spark
        orders = stg_orders(spark.read.schema(contracts.table("orders").schema()).parquet(f"{self.raw_root}/orders"))
        theirs = strays.join(orders.select("order_id", "order_number", "user_id"), "order_id")
        own = None
        for path, schema in _line_tables(self.raw_root):
            lines = spark.read.schema(schema).parquet(path).select("order_id", "order_number")
            own = lines if own is None else own.unionByName(lines)
        own = own.join(strays.select("order_id"), "order_id", "left_semi").distinct().withColumn("has", F.lit(1))
        zero = [F.lit(0).cast("long").alias(c) for c in ("orders", "days", "gaps")]
        basket = F.coalesce(F.lit(1) - F.col("has"), F.lit(1)).cast("long").alias("baskets")
        return theirs.join(own, ["order_id", "order_number"], "left").select("user_id", *zero, basket, "items", "again").select(
            "user_id", *_SUMS)


# --- latest product versions (W1, M6, M12) ----------------------------------------------------

_TIES = (fixed.FEED_SEQUENCE_FIELD, "_loaded_at", "_payload_text")


class LatestProducts:
    """The newest version of every product at ``path``, following the append-only feed
    table at ``feed``."""

    def __init__(self, spark: SparkSession, feed: str, path: str) -> None:
        self.spark, self.feed, self.path = spark, feed, path
        parsed = parse_off_products(spark.createDataFrame([], contracts.FEED_RAW_SCHEMA))
        self.schema = StructType(list(parsed.schema.fields)).add("file", "string").add("bucket", "integer")

    def _table(self) -> DataFrame:
        recover(self.spark, self.path)
        if not path_exists(self.spark, self.path):
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(self.path)

    def refresh(self) -> list[int]:
        """Merge rows of new files in; the buckets that were rewritten."""
        spark, table = self.spark, self._table()
        merged = {r["file"] for r in table.where(F.col("bucket") == MANIFEST).select("file").collect()}  # as a listing holds
        files = [n for n in list_names(spark, self.feed) if not n.startswith(("_", "."))]
        if merged - set(files):
            merged, table = set(), table.limit(0)  # the feed table was replaced: from everything
        new = [f"{self.feed}/{n}" for n in files if n not in merged]
        if not new:
            return []
        rows = parse_off_products(spark.read.schema(contracts.FEED_RAW_SCHEMA).parquet(*new))
        fresh = latest_version(rows, "product_code", "last_modified_t", list(_TIES)).withColumn("bucket", _bucket("product_code"))
        touched = list(range(BUCKETS)) if not merged else sorted(r[0] for r in fresh.select("bucket").distinct().collect())
        before = table.where(F.col("bucket").isin(touched)).drop("file")
        after = latest_version(before.unionByName(fresh), "product_code", "last_modified_t", list(_TIES))
        after = after.withColumn("file", F.lit(None).cast("string")).select(*self.schema.fieldNames())
        nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in self.schema.fields[:-2]]
        listed = spark.createDataFrame([(n,) for n in files], "file string").select(
            *nothing, "file", F.lit(MANIFEST).alias("bucket"))
        write_pending_partitions(after.unionByName(listed), self.path, "bucket", [*touched, MANIFEST]).publish()
        return touched

    def products(self) -> DataFrame:
        """stg_off_products."""
        return self._table().where(F.col("bucket") != MANIFEST).select(*OFF_PRODUCT_COLUMNS)
