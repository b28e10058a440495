"""Exactly-once-per-file ingest of landed feed files.

A Structured Streaming file source remembers every file it has committed in
its checkpoint, so a rerun over the same landing folder adds nothing, and a
new file adds only its own rows: the load-history semantics of an append-only
COPY, without FORCE. ``availableNow`` processes what is there and stops, so
the job runs as a scheduled batch.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from cartwright import contracts
from cartwright.session import list_names
from cartwright.sources.json_arrays import explode_json_arrays, with_feed_columns


def ingest_json_arrays(spark: SparkSession, landing: str, target: str, checkpoint: str,
                       whole_file: bool = False, max_files_per_trigger: int | None = None) -> int:
    """Append every not-yet-seen landed file to the raw feed table at ``target``.

    Returns the number of rows appended.
    """
    reader = spark.readStream.format("text").option("wholetext", str(whole_file).lower())
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    lines = reader.load(landing).select("value", F.col("_metadata.file_path").alias("_source_file"))
    rows = with_feed_columns(explode_json_arrays(lines)).withColumn("_loaded_at", F.current_timestamp())
    rows = rows.select("payload", "last_modified_t", "feed_seq", "_loaded_at", "_source_file", "_source_pos")
    before = set(list_names(spark, target))
    q = (rows.writeStream.format("parquet").option("checkpointLocation", checkpoint)
         .outputMode("append").trigger(availableNow=True).start(target))
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    new = [f"{target}/{n}" for n in list_names(spark, target) if n.endswith(".parquet") and n not in before]
    # from the footers of the new files
    return spark.read.schema(contracts.FEED_RAW_SCHEMA).parquet(*new).count() if new else 0
