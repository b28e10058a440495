"""B7 with a load history that can be read: files by path, length and checksum.

A landed file is loaded when the history does not hold it with this checksum: new files
are, files that were rewritten at the same path are loaded again (their rows are
appended), files that were only touched or copied onto themselves are not. The checksum
adds up hashes of the lines, so a file of any size is read by many tasks.

A load writes its rows to ``<target>/load_id=N`` and then its entries to the history; rows
without entries, of a load that stopped in between, are dropped by the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwright.session import list_names, make_folder, move, path_exists, remove
from cartwright.sources.json_arrays import explode_json_arrays, with_feed_columns

HISTORY = "path string, length long, checksum string, n_lines long, loaded_at timestamp"


def read_history(spark: SparkSession, history: str) -> DataFrame:
    """One row per loaded file and load."""
    schema = f"{HISTORY}, load_id int"
    return spark.read.schema(schema).parquet(history) if path_exists(spark, history) else spark.createDataFrame([], schema)


def landed_files(spark: SparkSession, landing: str) -> DataFrame:
    """path, length, checksum and n_lines of every landed file."""
    lines = spark.read.text(landing).select("value", F.col("_metadata.file_path").alias("path"),
                                            F.col("_metadata.file_size").alias("length"))
    h = F.xxhash64("value")
    sums = lines.groupBy("path", "length").agg(F.count(F.lit(1)).alias("n_lines"), F.sum(h.cast("decimal(20,0)")).alias("s"),
                                               F.bit_xor(h).alias("x"))
    return sums.select("path", "length", F.md5(F.concat_ws(":", "n_lines", "s", "x")).alias("checksum"), "n_lines")


def ingest_with_history(spark: SparkSession, landing: str, target: str, history: str) -> list[str]:
    """Load what the history does not hold; the paths loaded."""
    make_folder(spark, target)
    done = _loads(spark, history)
    for load in _loads(spark, target) - done:  # stopped before its entries were written
        remove(spark, f"{target}/load_id={load}")
    if not list_names(spark, landing):
        return []
    number = max(done, default=0) + 1
    known = read_history(spark, history).select("path", "checksum")
    todo = landed_files(spark, landing).join(known, ["path", "checksum"], "left_anti")
    staged = f"{target}/.tmp-{number}"
    remove(spark, staged)
    todo.withColumn("loaded_at", F.current_timestamp()).write.parquet(f"{staged}/entries")
    entries = spark.read.parquet(f"{staged}/entries")
    paths = sorted(r["path"] for r in entries.select("path").collect())  # as the reader's own listing holds
    if paths:
        lines = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("_source_file"))
        rows = with_feed_columns(explode_json_arrays(lines)).withColumn("_loaded_at", F.current_timestamp())
        rows.select("payload", "last_modified_t", "feed_seq", "_loaded_at", "_source_file", "_source_pos").write.parquet(
            f"{staged}/rows")
        move(spark, f"{staged}/rows", f"{target}/load_id={number}")
        move(spark, f"{staged}/entries", f"{history}/load_id={number}")
    remove(spark, staged)
    return paths


def _loads(spark: SparkSession, folder: str) -> set[int]:
    return {int(n.split("=")[1]) for n in list_names(spark, folder) if n.startswith("load_id=")}
