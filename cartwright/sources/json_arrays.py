"""A4/A5: JSON-array files to one VARIANT row per array element.

Each line of a landed file holds one JSON array (or a single object, which is
wrapped into a one-element array first); ``whole_file=True`` reads files that
spread one array over many lines. ``dt=`` folders are discovered as a
partition column and can prune, but are not part of the loaded row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwright import fixed
from cartwright.functions.variant import variant_path


def explode_json_arrays(lines: DataFrame, text_col: str = "value") -> DataFrame:
    """(text, ...) -> (payload VARIANT, _source_pos, ...) per array element;
    ``_source_pos`` is the position in its array (lineage, not a total order)."""
    text = F.col(text_col)
    # the first character that is not blank tells an array from one object
    as_array = F.parse_json(F.when(text.rlike(r"^\s*\["), text).otherwise(F.concat(F.lit("["), text, F.lit("]"))))
    extra = [c for c in lines.columns if c != text_col]
    return lines.select(*extra, F.posexplode(as_array.cast("array<variant>")).alias("_source_pos", "payload"))


def with_feed_columns(rows: DataFrame) -> DataFrame:
    """Add the columns pulled out at load time: the watermark
    (``$1:last_modified_t::number``) and the source-side sequence, if landed."""
    t = variant_path("payload", "last_modified_t", type_="bigint").alias("last_modified_t")
    seq = variant_path("payload", fixed.FEED_SEQUENCE_FIELD, type_="bigint").alias(fixed.FEED_SEQUENCE_FIELD)
    return rows.select("payload", t, seq, *[c for c in rows.columns if c != "payload"])


def read_json_arrays(spark: SparkSession, path: str, whole_file: bool = False) -> DataFrame:
    """All landed files below ``path``: payload, watermark value, lineage."""
    lines = spark.read.text(path, wholetext=whole_file)
    lines = lines.select("value", F.col("_metadata.file_path").alias("_source_file"))
    return with_feed_columns(explode_json_arrays(lines))
