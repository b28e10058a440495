"""Small tables derived from the partitions of a Parquet table, kept in step with them.

The state of ``<folder>/<name>`` lies in ``<folder>/.<state>-<name>``, for each partition
in ``<column>=<value>/sig=<signature>``. The signature is a digest of the names of the
files it was made from (and of a ``version`` of what is derived). Files are never changed
in place, so a state that is lost, behind or half written is told from a good one by
listing: :meth:`Derived.refresh` makes what is missing, from the partitions concerned
only, and drops what is left over. Nothing else has to be kept in step, and a process may
stop anywhere.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructType

from cartwright.session import list_names, make_folder, move, remove
from cartwright.sinks.loads import partitions_of

_SIG = "sig"


@dataclass(frozen=True)
class Derived:
    """``build`` maps rows of some partitions of ``target`` to state rows, with the
    partition ``column``; ``schema`` are the state's columns without it. Tables in
    ``also`` are partitioned alike; ``build`` gets their rows of the same partitions
    too, and a change in one of them makes a state anew."""

    target: str
    column: str
    state: str
    build: Callable[..., DataFrame]
    schema: StructType
    sort_by: tuple[str, ...] = ()
    version: str = ""
    options: dict = field(default_factory=dict)
    also: tuple[tuple[str, StructType], ...] = ()

    @property
    def path(self) -> str:
        parent, name = self.target.rstrip("/").rsplit("/", 1)
        return f"{parent}/.{self.state}-{name}"

    def signatures(self, spark: SparkSession) -> dict[str, str]:
        """Partition value -> digest of its file names."""
        files = {v: [self.version, *list_names(spark, folder)]
                 for v, folder in partitions_of(spark, self.target, self.column).items()}
        for table, _ in self.also:
            for v, folder in partitions_of(spark, table, self.column).items():
                if v in files:
                    files[v] += ["", table.rsplit("/", 1)[1], *list_names(spark, folder)]
        return {v: hashlib.md5("\n".join(names).encode()).hexdigest() for v, names in files.items()}

    def _there(self, spark: SparkSession) -> dict[str, list[str]]:
        """Partition value -> signatures of its states."""
        names = [n for n in list_names(spark, self.path) if n.startswith(f"{self.column}=")]
        return {n.split("=", 1)[1]: [s.removeprefix(f"{_SIG}=") for s in list_names(spark, f"{self.path}/{n}")] for n in names}

    def make(self, spark: SparkSession) -> tuple[dict[str, str], list[int]]:
        """Make the states that are missing, and keep all others; the signatures of the
        table's partitions, and the partitions that had to be read."""
        want, have = self.signatures(spark), self._there(spark)
        missing = sorted(int(v) for v, sig in want.items() if sig not in have.get(v, ()))
        if missing:
            self._build(spark, {v: want[str(v)] for v in missing})
        return want, missing

    def drop_stale(self, spark: SparkSession, want: dict[str, str]) -> None:
        for value, sigs in self._there(spark).items():
            if value not in want:
                remove(spark, f"{self.path}/{self.column}={value}")
            for sig in sigs:
                if value in want and sig != want[value]:
                    remove(spark, f"{self.path}/{self.column}={value}/{_SIG}={sig}")

    def refresh(self, spark: SparkSession) -> tuple[dict[str, str], list[int]]:
        """Bring the state up to date: make what is missing, drop what is left over."""
        want, missing = self.make(spark)
        self.drop_stale(spark, want)
        return want, missing

    def _build(self, spark: SparkSession, signatures: dict[int, str]) -> None:
        here = F.col(self.column).isin(list(signatures))
        others = []
        for table, schema in self.also:
            known = partitions_of(spark, table, self.column)
            others.append(spark.read.schema(schema).parquet(table).where(here) if known else spark.createDataFrame([], schema))
        rows = self.build(spark.read.parquet(self.target).where(here), *others)
        names = F.create_map(*[F.lit(x) for pair in signatures.items() for x in pair])
        fresh = f"{self.path}/.tmp-{uuid.uuid4().hex[:12]}"
        try:
            (rows.withColumn(_SIG, F.element_at(names, F.col(self.column).cast("int")))
             .hint("rebalance", self.column).sortWithinPartitions(self.column, *self.sort_by)
             .write.options(**self.options).partitionBy(self.column, _SIG).parquet(fresh))
            for value, sig in signatures.items():
                part = f"{self.column}={value}/{_SIG}={sig}"
                if list_names(spark, f"{fresh}/{part}"):
                    move(spark, f"{fresh}/{part}", f"{self.path}/{part}")
                else:  # a partition without state rows
                    make_folder(spark, f"{self.path}/{part}")
        finally:
            remove(spark, fresh)

    def has(self, spark: SparkSession, signatures: dict[str, str]) -> bool:
        have = self._there(spark)
        return all(sig in have.get(v, ()) for v, sig in signatures.items())

    def rows(self, spark: SparkSession, signatures: dict[str, str]) -> DataFrame:
        """The states of the given (partition value, signature) pairs."""
        schema = StructType(list(self.schema.fields)).add(self.column, IntegerType()).add(_SIG, StringType())
        if not signatures or not list_names(spark, self.path):
            return spark.createDataFrame([], schema).drop(_SIG)
        of_one = F.col(self.column).isin([int(v) for v in signatures]) & F.col(_SIG).isin(sorted(set(signatures.values())))
        return spark.read.schema(schema).parquet(self.path).where(of_one).drop(_SIG)

    def read(self, spark: SparkSession, staged: DataFrame | None = None, affected: set[int] | tuple = ()) -> DataFrame:
        """The state of all partitions, brought up to date first. With ``staged``, the
        state as it will be when the partitions ``affected`` hold these rows instead."""
        signatures, _ = self.refresh(spark)
        columns = [*self.schema.fieldNames(), self.column]
        now = self.rows(spark, {v: sig for v, sig in signatures.items() if int(v) not in affected}).select(*columns)
        return now if staged is None else now.unionByName(self.build(staged).select(*columns))
