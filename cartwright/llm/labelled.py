"""Bounded samples of labelled documents, for fitting classifiers."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize


#: Most bytes of features that a sample brings to the driver.
MAX_BYTES = 200 << 20


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """Whether a row is kept away from fitting; rows without doc_id are not."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % modulus == remainder, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, label_col: str, held: Column, max_rows: int,
           extract: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], schema: str,
           inputs: list[Column], max_bytes: int = MAX_BYTES) -> pd.DataFrame:
    """At most ``max_rows`` labelled rows as features, with their label ``y``.

    Rows are chosen by hash of doc_id (a uniform sample that reruns repeat) among
    labelled rows that are not ``held`` out. Labels other than 0 and 1 are left
    out; of contradicting labels of a document the larger counts. Only features
    reach the driver, never texts: at most ``max_rows`` rows, and of these as many as
    come first by a hash of the features and together hold ``max_bytes``.
    """
    order = F.xxhash64("label_id")
    chosen = (labels.select(F.col("doc_id").alias("label_id"), F.col(label_col).cast("int").alias("y"))
              .filter(F.col("label_id").isNotNull() & F.col("y").isin(0, 1)).filter(~held)
              .groupBy("label_id").agg(F.max("y").alias("y")).orderBy(order, "label_id").limit(max_rows))
    rows = docs.select(F.col("doc_id").alias("id"), *inputs)
    # max_rows pairs of numbers: a proven bound
    rows = rows.join(F.broadcast(chosen), rows["id"] == chosen["label_id"]).drop("id", "label_id")
    found = materialize(rows.mapInPandas(extract, schema).withColumn("_o", F.xxhash64("features")), "labelled")
    binary = [f.name for f in found.schema if f.dataType.simpleString() in ("binary", "string")]
    size = sum((F.octet_length(c) for c in binary), F.lit(0))
    first = found.select("_o", size.alias("n")).orderBy("_o", "n").limit(max_rows).toPandas()
    fits = int((first["n"].cumsum() <= max_bytes).sum())
    return found.orderBy("_o", size).limit(fits).drop("_o").toPandas()


class Hasher:
    """Token -> bucket by CRC-32, remembered for tokens seen lately."""

    def __init__(self, bits: int, keep: int = 300_000) -> None:
        self.mask, self.keep, self.known = (1 << bits) - 1, keep, {}

    def __call__(self, tokens) -> list[int]:
        known = self.known
        if len(known) > self.keep:
            known.clear()
        out = []
        for t in tokens:
            i = known.get(t)
            if i is None:
                i = known[t] = crc32(t.encode("utf-8", "surrogatepass")) & self.mask
            out.append(i)
        return out


def unpack(features: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """Binary int32 arrays -> all indices, and where each row's begin."""
    parts = [np.frombuffer(f, np.int32) for f in features]
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    return np.concatenate(parts) if parts else np.empty(0, np.int32), np.cumsum(sizes) - sizes


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))
