"""The corpus pipeline: documents through quality rules, line and near-duplicate removal,
redaction of personal data, and packing into training sequences.

Each stage reads what its predecessor kept, as stored Parquet. All but the last return the
columns of ``documents``; ``n_chars`` follows a text that a stage has changed.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.llm import lines, outliers, packing, pii, simhash
from ebbtide.llm.common import ship_code, stored, table


def _with_text(docs: DataFrame, changed: DataFrame) -> DataFrame:
    """``changed`` with the columns of ``docs``; ``n_chars`` is the length of its text."""
    if "n_chars" in docs.columns:
        changed = changed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return changed.select(*docs.columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that the quality rules reject."""
    ship_code(spark)
    return outliers.kept_documents(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without lines that an earlier line equals or nearly equals."""
    return _with_text(docs, lines.cleaned(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by fingerprints of 3-word shingles that differ in at most 2 bits."""
    ship_code(spark)
    return simhash.without_near_duplicates(docs, words=3)


def redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts replaced by its kind."""
    ship_code(spark)
    return _with_text(docs, pii.redacted(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every token piece with its sequence of at most 1024 tokens and its place there."""
    ship_code(spark)
    return packing.packed_documents(
        docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=2, capacity=1024
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("redaction", redaction), ("pack", pack),
]

#: Outlier estimates, connected components and tokenizers are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
