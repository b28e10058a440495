"""Session construction, shared scratch storage and folder operations.

On a cluster ``spark.checkpoint.dir`` (or the SparkContext's checkpoint folder)
names a shared folder (HDFS, S3A, ...). Every job that must cut lineage or stage
intermediate tables writes below that folder, never to a machine-local temp
directory. Only a local master without either gets a local one; any other
master fails.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

RowWise = Callable[[DataFrame], DataFrame]

# Settings every session of ours needs: UTC (timestamps are compared across
# engines), AQE with skew-join splitting and partition coalescing.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
    "spark.sql.ansi.enabled": "true",  # B14: a value that does not fit its type aborts
    # VARIANT payloads are written with their common fields as columns of their own, so
    # that a path read scans the fields it names and no others
    "spark.sql.variant.writeShredding.enabled": "true",
    "spark.sql.variant.inferShreddingSchema": "true",
    "spark.sql.variant.allowReadingShredded": "true",
    "spark.sql.variant.pushVariantIntoScan": "true",
}


# Sizing of shuffles elsewhere, where the session still has Spark's own. A sort or join
# holds rows as they are, five to ten times what lz4 leaves of them in a shuffle, so
# 16 MB a task stay in memory where 64 MB spill; and a shuffle is cut finely enough
# before AQE joins its parts (AQE never cuts a part of a window or an aggregate).
SIZING = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "256",
}

# Hash keys are hexadecimal digits, which zstd halves and Spark's snappy leaves as they are.
# Written so by either profile, where the session still has Spark's own.
FILES = {"spark.sql.parquet.compression.codec": "zstd"}

# Sizing for a large cluster (100 TB class inputs). Shuffle partitions start
# high and AQE coalesces them to ~128 MB each, so a stage's tasks fit in
# executor memory without spilling at full scale; scan splits are 256 MB.
# Applied by ``configure(spark, profile="cluster")`` only where the session
# still has Spark's defaults, so explicit cluster settings win.
CLUSTER_SETTINGS = {
    "spark.sql.shuffle.partitions": "8192",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
}
_SPARK_DEFAULTS = {
    "spark.sql.shuffle.partitions": "200",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64MB",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1MB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5.0",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256MB",
    "spark.sql.files.maxPartitionBytes": "128MB",
    "spark.sql.autoBroadcastJoinThreshold": "10MB",
    "spark.sql.parquet.compression.codec": "snappy",
}


def build_session(master: str | None = None, app: str = "cartwright", shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Local/test session. On a cluster, use the session the platform gives you
    and call :func:`configure` on it instead."""
    b = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        b = b.master(master)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in {**SESSION_DEFAULTS, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession, profile: str = "local") -> SparkSession:
    """Apply the session settings the models rely on to an existing session.

    ``profile="cluster"`` also sizes shuffles and scans for large inputs
    (CLUSTER_SETTINGS), otherwise SIZING holds; both replace only values still at Spark's
    defaults.
    """
    for k, v in SESSION_DEFAULTS.items():
        if k == "spark.sql.sources.partitionOverwriteMode":
            continue  # per-write option; leave the cluster default alone
        spark.conf.set(k, v)
    for k, v in SIZING.items():
        if profile == "cluster" and spark.conf.get(k, None) == v:
            spark.conf.unset(k)
    for k, v in {**(CLUSTER_SETTINGS if profile == "cluster" else SIZING), **FILES}.items():
        current = spark.conf.get(k, None)
        if current is None or current.replace(" ", "").lower() == _SPARK_DEFAULTS.get(k, "").lower():
            if "initialPartitionNum" not in k or int(spark.conf.get("spark.sql.shuffle.partitions")) < int(v):
                spark.conf.set(k, v)
    checkpoint_root(spark)
    return spark


_FALLBACK_ROOTS: dict[str, str] = {}


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder: ``spark.checkpoint.dir``, else the SparkContext's
    checkpoint folder, else (on a local master only) one of our own per
    application."""
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        app = context.applicationId
        if app not in _FALLBACK_ROOTS:
            _FALLBACK_ROOTS[app] = tempfile.mkdtemp(prefix="cartwright-ckpt-")
        root = _FALLBACK_ROOTS[app]
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh, never-reused folder below the shared checkpoint root."""
    path = f"{checkpoint_root(spark)}/cartwright/{purpose}-{uuid.uuid4().hex[:12]}"
    make_folder(spark, path)
    return path


# --- folders, through the Hadoop file system of their URI scheme ----------------

def _folder(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm  # noqa: SLF001 - standard PySpark access to Hadoop FS
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p  # noqa: SLF001


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _folder(spark, path)
    return bool(fs.exists(p))


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below ``path``, in one listing; none if it does not exist."""
    fs, p = _folder(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def make_folder(spark: SparkSession, path: str) -> None:
    fs, p = _folder(spark, path)
    fs.mkdirs(p)


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _folder(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file or folder; the target's parent is made, the target must not exist."""
    fs, p = _folder(spark, source)
    _, to = _folder(spark, target)
    fs.mkdirs(to.getParent())
    if fs.exists(to) or not fs.rename(p, to):
        raise OSError(f"cannot move {source} to {target}")


# --- replacing tables ----------------------------------------------------------
#
# New content is computed into a hidden ``.tmp-<mark>-<name>`` beside its table. Renaming
# that folder to ``.ready-<name>`` is the commit: from then on the swap is finished by
# whoever comes first, this process or the next reader or writer (``recover``). The names
# alone tell how far a swap came, so a process may stop at any point:
#
#     .ready and table            -> table to .old, .ready to table, .old goes
#     .ready and .old, no table   -> .ready to table, .old goes
#     .ready alone                -> .ready to table
#     .old and table              -> .old goes
#
# Partitions of one table are replaced together: ``.ready-partitions`` holds a folder for
# each, an empty one for a partition that is to go. Each table has one writer at a time.

_READY, _OLD, _PARTITIONS = ".ready-", ".old-", ".ready-partitions"


def _beside(target: str, prefix: str) -> str:
    parent, name = target.rstrip("/").rsplit("/", 1)
    return f"{parent}/{prefix}{name}"


@dataclass(frozen=True)
class Pending:
    """Complete new content of a table, or of some of its partitions, that nothing
    reads yet: :meth:`publish` swaps it in, :meth:`discard` drops it."""

    spark: SparkSession
    target: str
    path: str
    partitions: bool = False

    def publish(self) -> None:
        if self.partitions:
            recover(self.spark, self.target)
            move(self.spark, self.path, f"{self.target}/{_PARTITIONS}")
            recover(self.spark, self.target)
        else:
            _settle(self.spark, self.target)
            move(self.spark, self.path, _beside(self.target, _READY))
            _settle(self.spark, self.target)

    def discard(self) -> None:
        remove(self.spark, self.path)


def _put(spark: SparkSession, new: str, target: str, old: str) -> None:
    """``new`` to the place of ``target``, which goes to ``old``. Where a reader finishes
    the same swap at the same time, its work stands."""
    try:
        if path_exists(spark, target):
            remove(spark, old)  # of an earlier swap, whose new content is in place
            move(spark, target, old)
        move(spark, new, target)
    except OSError:
        if not path_exists(spark, target) and path_exists(spark, old):
            move(spark, old, target)
        if path_exists(spark, new):
            raise


def _settle(spark: SparkSession, target: str) -> None:
    """Finish what a swap of ``target`` left undone."""
    ready, old = _beside(target, _READY), _beside(target, _OLD)
    if path_exists(spark, ready):
        _put(spark, ready, target, old)
    if path_exists(spark, old):
        if path_exists(spark, target):
            remove(spark, old)
        else:
            move(spark, old, target)


def recover(spark: SparkSession, folder: str) -> None:
    """Finish interrupted swaps of ``folder`` itself, of what lies directly in it, and of
    its partitions. Two listings where there is nothing to do."""
    own = folder.rstrip("/").rsplit("/", 1)[1]
    around = list_names(spark, folder.rstrip("/").rsplit("/", 1)[0])
    if f"{_READY}{own}" in around or f"{_OLD}{own}" in around:
        _settle(spark, folder)
    names = list_names(spark, folder)
    for name in {n.removeprefix(_READY).removeprefix(_OLD) for n in names if n.startswith((_READY, _OLD)) and n != _PARTITIONS}:
        _settle(spark, f"{folder}/{name}")
    if _PARTITIONS in names:
        ready = f"{folder}/{_PARTITIONS}"
        for name in list_names(spark, ready):
            if "=" not in name:
                continue
            if list_names(spark, f"{ready}/{name}"):
                _put(spark, f"{ready}/{name}", f"{folder}/{name}", f"{folder}/{_OLD}{name}")
                remove(spark, f"{folder}/{_OLD}{name}")
            else:
                remove(spark, f"{folder}/{name}")
        remove(spark, ready)


def _write(df: DataFrame, path: str, partition_by: str | None, sort_by: str | None, finish: RowWise | None,
           balance: bool = True) -> None:
    if partition_by:
        df = df.hint("rebalance", partition_by) if balance else df
        df = df.sortWithinPartitions(partition_by, *([sort_by] if sort_by else []))
    w = (finish(df) if finish else df).write
    (w.partitionBy(partition_by) if partition_by else w).parquet(path)


def _written(pending: Pending, write) -> Pending:
    try:
        write()
    except BaseException:
        pending.discard()
        raise
    return pending


def write_pending(df: DataFrame, target: str, partition_by: str | None = None, sort_by: str | None = None,
                  finish: RowWise | None = None) -> Pending:
    """Compute the new content of the Parquet folder ``target`` (``df`` may read it);
    with ``partition_by`` balanced by that column, each file sorted by ``sort_by``.
    ``finish`` adds columns row by row as the files are written, so that wide derived
    columns are neither shuffled nor sorted."""
    fresh = Pending(df.sparkSession, target, _beside(target, f".tmp-{uuid.uuid4().hex[:12]}-"))
    return _written(fresh, lambda: _write(df, fresh.path, partition_by, sort_by, finish))


def write_pending_partitions(df: DataFrame, target: str, partition_by: str, replaced: list, sort_by: str | None = None,
                             finish: RowWise | None = None, balance: bool = True) -> Pending:
    """Compute new content of the partitions ``replaced``, those that ``df`` has rows
    for and others, which will be gone. Rows that are read from files of such partitions
    need no shuffle (``balance=False``): a task has few partitions then, and writes a file each."""
    spark = df.sparkSession
    fresh = Pending(spark, target, f"{target}/.tmp-{uuid.uuid4().hex[:12]}", partitions=True)

    def write() -> None:
        _write(df, fresh.path, partition_by, sort_by, finish, balance)
        names = set(list_names(spark, fresh.path))
        for value in replaced:
            if f"{partition_by}={value}" not in names:
                make_folder(spark, f"{fresh.path}/{partition_by}={value}")

    return _written(fresh, write)


def write_and_swap(df: DataFrame, target: str, partition_by: str | None = None, sort_by: str | None = None,
                   finish: RowWise | None = None) -> None:
    """Replace the Parquet folder ``target`` by ``df``. A job that fails leaves the old
    content; a process that stops on the way leaves the old or the new one to the next
    reader or writer (see above)."""
    write_pending(df, target, partition_by, sort_by, finish).publish()
