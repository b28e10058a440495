"""Land feed pulls as JSON-array files under ``dt=YYYY-MM-DD`` (UTC).

Each output line is one JSON array of at most ``rows_per_array`` product
objects (one extractor "file" worth). Rows are shuffled once, by day (AQE splits
a heavy day over tasks); each task sorts its rows by day and position and joins
runs of one day to arrays as they pass, so it holds no group of rows.

Each object carries its position in the feed (``fixed.FEED_SEQUENCE_FIELD``),
so that two versions of a product with the same modification second keep their
order whatever file and line they land in. An empty pull writes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwright import fixed
from cartwright.functions.scalars import utc_date_label


def land_json_arrays(feed: DataFrame, landing: str, pulled_at, order_col: str, rows_per_array: int = 500,
                     mode: str = "append") -> None:
    """``feed`` has a ``payload`` VARIANT column; ``pulled_at`` is a timestamp
    column or literal giving the dt partition; rows are cut into arrays in the order of
    ``order_col``."""
    dated = feed.withColumn("dt", utc_date_label(pulled_at))
    text, seq = F.to_json("payload"), F.col(order_col).cast("string")
    numbered = F.concat(F.lit(f'{{"{fixed.FEED_SEQUENCE_FIELD}":'), F.coalesce(seq, F.lit("null")),
                        F.when(text == "{}", F.lit("}")).otherwise(F.concat(F.lit(","), F.substr(text, F.lit(2)))))
    rows = dated.select("dt", F.col(order_col).alias("k"), numbered.alias("j"))
    # few files a day; a heavy day is split
    ordered = rows.hint("rebalance", "dt").sortWithinPartitions("dt", "k").select("dt", "j")
    arrays = ordered.mapInArrow(_joined(rows_per_array), "dt string, value string")
    arrays.write.mode(mode).partitionBy("dt").text(landing)


def _joined(rows_per_array: int):
    """Runs of JSON objects of one day -> JSON arrays, batch by batch."""
    def arrays(batches):
        import pyarrow as pa

        for batch in batches:
            if not batch.num_rows:
                continue
            days, items = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            cuts = [0]
            for i in range(1, len(days)):
                if days[i] != days[i - 1] or i - cuts[-1] == rows_per_array:
                    cuts.append(i)
            values = [f"[{','.join(x for x in items[a:b] if x is not None)}]" for a, b in zip(cuts, [*cuts[1:], len(days)])]
            yield pa.RecordBatch.from_arrays([pa.array([days[a] for a in cuts], pa.string()), pa.array(values, pa.string())],
                                             ["dt", "value"])

    return arrays
