"""The registered queries of the corpus operators, and SQL for those that it can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.llm import (
    bpe,
    chat,
    fragments,
    lines,
    neighbours,
    outliers,
    packing,
    pii,
    prefix_trie,
    rotated_codes,
    simhash,
    suffixes,
    token_store,
)
from ebbtide.llm.common import table

QUERIES = {}
ORACLE_SQL: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


@query
def op1_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written as token shards and fetched through the index."""
    docs = table(spark, sf_dir, "documents")
    store = token_store.write(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return token_store.read(store, docs, digests=True)


@query
def op2_chat_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations that are not snapshots of longer ones, rendered."""
    return chat.rendered(table(spark, sf_dir, "conversations"))


ORACLE_SQL["op2_chat_snapshots"] = chat.SQL


@query
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without lines that an earlier line equals or nearly equals."""
    out = lines.cleaned(table(spark, sf_dir, "documents"), counts=True)
    return out.select("doc_id", "n_lines", "n_removed", "text")


ORACLE_SQL["op3_line_dedup"] = lines.SQL


@query
def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without bytes that a repeated string of 100 bytes covers."""
    return suffixes.deduplicated(table(spark, sf_dir, "documents"), width=100, digests=True)


@query
def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded by the multilingual ranks and decoded again."""
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return bpe.encode(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN, digests=True)


@query
def op6_semi_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    return pii.found(table(spark, sf_dir, "documents"))


@query
def op7_robust_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, plain rules and the outlier verdict for every document."""
    return outliers.judged(table(spark, sf_dir, "documents"))


@query
def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 1024 tokens."""
    return packing.packed_documents(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=2, capacity=1024
    )


@query
def op9_simhash_golay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op10_kmeans_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five nearest neighbours of every fiftieth vector."""
    return neighbours.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


@query
def op11_rotated_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and near-duplicate component of every vector among those of its label."""
    return rotated_codes.near_duplicates(table(spark, sf_dir, "embeddings"), least=0.98)


ORACLE_SQL["op11_rotated_codes"] = rotated_codes.SQL


@query
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every prefix of the rebuilt conversations, with what its subtree holds."""
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


ORACLE_SQL["op12_prefix_trie"] = prefix_trie.SQL


@query
def op13_fragments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token alignment of two tokenizers for every document."""
    return fragments.aligned(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
