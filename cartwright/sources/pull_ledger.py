"""Pulls of a newest-first feed that can be capped, stopped and resumed.

A high-water mark knows only the newest row that was loaded: what a capped pull leaves
below is never pulled again, and a row of the same second that comes late neither. The
ledger keeps the intervals of feed positions (time, sequence) that were pulled instead. A
pull takes the newest rows outside them, at most ``page_size * max_pages`` if capped; the
gap it leaves stays open for the next one. Rows of the newest second are looked at once
more, but for those that were landed.

A pull lands in a hidden folder first. Swapping in the ledger's table commits it, then the
files are moved into the landing. A pull that stops before the commit is dropped by the
next one, a later one is finished, so that no row is landed twice or lost.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwright import fixed
from cartwright.contracts import FeedContract
from cartwright.session import list_names, move, path_exists, recover, remove, write_and_swap
from cartwright.sinks.feed_landing import land_json_arrays
from cartwright.sources.feed import WM, above_watermark

_SCHEMA = "kind string, low_t long, low_s long, high_t long, high_s long, pull string"
_HIDDEN = ".pull-"
RANGES = 4096

Position = tuple[int, int]


def merged(intervals: list[tuple[Position, Position]]) -> list[tuple[Position, Position]]:
    """Intervals that overlap or touch as one, in rising order."""
    out: list[tuple[Position, Position]] = []
    for low, high in sorted(intervals):
        if out and low <= out[-1][1]:
            out[-1] = out[-1][0], max(high, out[-1][1])
        else:
            out.append((low, high))
    return out


def newest_rows(rows: DataFrame, cap: int) -> DataFrame:
    """The ``cap`` rows of the highest position ``_p``, wherever they lie: a sort and limit
    would bring them all to one task. The lowest position taken is found by counting rows
    in ranges of the time, then of the sequence, each time within the range it fell into."""
    above, level, left = F.lit(False), F.lit(True), cap
    for name in ("_p.t", "_p.s"):
        part = F.col(name)
        low, high, n = rows.where(level).agg(F.min(part), F.max(part), F.count(F.lit(1))).first()
        if n <= left:
            return rows.where(above | level)
        while low < high:
            width = (high - low) // RANGES + 1
            at = F.expr(f"(CAST({name} AS DECIMAL(20, 0)) - ({low}BD)) div {width}BD")
            counts = rows.where(level & part.between(low, high)).groupBy(at.alias("at")).count().collect()  # RANGES at most
            for range_, k in sorted(map(tuple, counts), reverse=True):
                if k >= left:
                    break
                left -= k
            low, high = low + range_ * width, min(high, low + (range_ + 1) * width - 1)
        above, level = above | (level & (part > low)), level & (part == low)
    return rows.where(above).unionByName(rows.where(level).limit(left))  # of rows of one position any


@dataclass
class PullLedger:
    """The pulls of one feed into ``landing``; the ledger is a small table at ``path``."""

    spark: SparkSession
    path: str
    landing: str
    order_col: str = fixed.FEED_SEQUENCE_FIELD

    def _table(self) -> DataFrame:
        recover(self.spark, self.path)
        if not path_exists(self.spark, self.path):
            return self.spark.createDataFrame([], _SCHEMA)
        return self.spark.read.schema(_SCHEMA).parquet(self.path)

    def intervals(self) -> list[tuple[Position, Position]]:
        """What was pulled: as many rows as there are gaps, and one."""
        rows = self._table().where("kind = 'pulled'").collect()
        return sorted(((r["low_t"], r["low_s"]), (r["high_t"], r["high_s"])) for r in rows)

    def finish(self) -> None:
        """Complete the last committed pull, drop one that was not committed."""
        committed = {r["pull"] for r in self._table().select("pull").distinct().collect()}  # the last pull's name
        for name in list_names(self.spark, self.landing):
            if not name.startswith(_HIDDEN):
                continue
            folder = f"{self.landing}/{name}"
            if name.removeprefix(_HIDDEN) in committed:
                for day in list_names(self.spark, folder):
                    for file in list_names(self.spark, f"{folder}/{day}") if "=" in day else []:
                        move(self.spark, f"{folder}/{day}/{file}", f"{self.landing}/{day}/{file}")
            remove(self.spark, folder)

    def _position(self) -> Column:
        return F.struct(F.col(WM).alias("t"), F.coalesce(F.col(self.order_col), F.lit(0)).cast("long").alias("s"))

    def pull(self, feed: DataFrame, pulled_at, contract: FeedContract | None = None, capped: bool = True) -> int:
        """One pull; the number of rows landed."""
        self.finish()
        contract = contract or FeedContract()
        pulled, name = self.intervals(), uuid.uuid4().hex[:12]
        newest = pulled[-1][1][0] if pulled else 0
        rows = above_watermark(feed, 0, contract.watermark_field).withColumn("_p", self._position())
        known = F.lit(False)
        for (low_t, low_s), (high_t, high_s) in pulled:
            at = F.col("_p")
            known = known | ((at >= _literal(low_t, low_s)) & (at <= _literal(high_t, high_s)) & (F.col(WM) != newest))
        seen = self._table().where("kind = 'seen'").select(F.struct(F.col("low_t").alias("t"), F.col("low_s").alias("s")).alias("_p"))
        fresh = rows.where(~known).join(seen, "_p", "left_anti")
        if capped:
            fresh = newest_rows(fresh, contract.cap)
        staged = f"{self.landing}/{_HIDDEN}{name}"
        land_json_arrays(fresh.drop("_p", WM), staged, pulled_at, self.order_col)
        n = self._commit(staged, name, rows, pulled, contract.cap if capped else None)
        self.finish()
        return n

    def _commit(self, staged: str, name: str, rows: DataFrame, pulled: list, cap: int | None) -> int:
        """Enter what lies in ``staged``: its positions are read back from there."""
        from cartwright.sources.json_arrays import read_json_arrays

        if not any("=" in d for d in list_names(self.spark, staged)):
            return 0
        landed = read_json_arrays(self.spark, staged)
        landed = landed.select(F.struct(F.coalesce("last_modified_t", F.lit(0)).alias("t"),
                                        F.coalesce(F.col(fixed.FEED_SEQUENCE_FIELD), F.lit(0)).alias("s")).alias("_p"))
        low, high, n = landed.agg(F.min("_p"), F.max("_p"), F.count(F.lit(1))).first()
        top = max([tuple(high)] + [h for _, h in pulled])
        # newest first: everything above the lowest row is pulled now, and all of it if the cap was not reached
        now = merged([*pulled, (tuple(low) if cap is not None and n >= cap else (0, -(1 << 62)), top)])
        entries = [("pulled", *a, *b, name) for a, b in now]
        before = self._table().where(F.expr("kind = 'seen'") & (F.col("low_t") == top[0])).select("low_t", "low_s")
        late = landed.where(F.col("_p.t") == top[0]).select(F.col("_p.t").alias("low_t"), F.col("_p.s").alias("low_s"))
        seen = before.unionByName(late).distinct().select(
            F.lit("seen").alias("kind"), "low_t", "low_s", F.lit(None).cast("long").alias("high_t"),
            F.lit(None).cast("long").alias("high_s"), F.lit(name).alias("pull"))
        write_and_swap(self.spark.createDataFrame(entries, _SCHEMA).unionByName(seen), self.path)
        return n


def _literal(t: int, s: int) -> Column:
    return F.struct(F.lit(t).cast("long").alias("t"), F.lit(s).cast("long").alias("s"))
