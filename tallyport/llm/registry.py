"""Registered queries of the training-data operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyport.llm import (
    bitplane_clusters, bpe_stream, license_scan, line_chunks, minhash_dedup, prefix_trie, qgram_filter, quality_gam,
    rule_ledger, token_store, tool_calls, trie_counts, warc,
)
from tallyport.llm.common import read


def public_file(name: str) -> str:
    """Place of a public tokenizer's file on the driver."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(read(spark, sf_dir, "documents"), shingle=3, percent=85)


def op2_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.digest(read(spark, sf_dir, "documents"), public_file("word_bpe_49k.json"))


def op3_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_gam.digest(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op4_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tool_calls.digest(read(spark, sf_dir, "conversations"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.digest(read(spark, sf_dir, "pages"))


def op6_qgram_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item, with the item and the edits."""
    return qgram_filter.matches(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op7_bpe_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_stream.digest(read(spark, sf_dir, "documents"), public_file("word_bpe_49k.json"))


def op8_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_chunks.digest(read(spark, sf_dir, "documents"))


def op9_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_ledger.digest(read(spark, sf_dir, "documents"))


def op10_trie_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie_counts.token_counts(read(spark, sf_dir, "documents"), public_file("piece_bpe_32k.model"))


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.digest(read(spark, sf_dir, "documents"))


def op12_bitplane_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitplane_clusters.digest(read(spark, sf_dir, "embeddings"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.digest(read(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_minhash_dedup": op1_minhash_dedup,
    "op2_token_store": op2_token_store,
    "op3_quality_gam": op3_quality_gam,
    "op4_tool_calls": op4_tool_calls,
    "op5_warc": op5_warc,
    "op6_qgram_filter": op6_qgram_filter,
    "op7_bpe_stream": op7_bpe_stream,
    "op8_line_chunks": op8_line_chunks,
    "op9_rule_ledger": op9_rule_ledger,
    "op10_trie_counts": op10_trie_counts,
    "op11_license_scan": op11_license_scan,
    "op12_bitplane_clusters": op12_bitplane_clusters,
    "op13_prefix_trie": op13_prefix_trie,
}
ORACLE: dict[str, str] = {
    "op9_rule_ledger": rule_ledger.ORACLE,
    "op12_bitplane_clusters": bitplane_clusters.ORACLE,
    "op13_prefix_trie": prefix_trie.ORACLE,
}
