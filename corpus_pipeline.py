"""Corpus pipeline: documents in, packed training sequences out.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it
as Parquet below ``spark.checkpoint.dir`` and hands the reread table to the next
stage. All stages but the last return the columns of their input.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwright.llm import exact_dedup, mixing, packing, quality, simhash
from cartwright.llm.common import materialize, table

QUALITY_THRESHOLD = 0.3


def reject_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: documents that score below the threshold go."""
    model = quality.train(docs, table(spark, sf_dir, "labels"), modulus=5, remainder=0)
    score = "score"
    while score in docs.columns:
        score += "_"
    return quality.score(docs, model, score_col=score).filter(F.col(score) >= QUALITY_THRESHOLD).select(docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: one document of each group of equal texts stays."""
    return exact_dedup.exact_dedup(docs).kept()


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: one document of each component of near copies stays."""
    return simhash.one_of_each(docs, shingle=4, max_bits=4)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: each document as often as the mix takes it."""
    return mixing.repeated(mixing.mix_sources(docs, carry=True))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: sequences of at most 2048 tokens."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"),
                        ranks=public_tokenizers.path("byte_bpe_50k.tiktoken"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", reject_low_quality),
    ("exact dedup", drop_copies),
    ("simhash near-dedup", drop_near_copies),
    ("mixing sources", mix),
    ("best-fit packing", pack),
]

#: SQL has neither the classifier nor the tokenizer; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs


QUERIES = {"pipeline": run}
ORACLE: dict[str, str] = {}
