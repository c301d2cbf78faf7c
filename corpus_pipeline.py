"""The corpus pipeline: quality, line dedup, near-duplicate removal, decontamination, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet
and read again as the next stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyport.llm import bpe_stream, line_chunks, minhash_dedup, qgram_filter, quality_gam
from tallyport.llm.common import read, stored
from tallyport.llm.registry import public_file


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. Learns from the labels of documents still here."""
    return quality_gam.keep_good(docs, read(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated runs of lines are cut out; a document of which nothing is left goes."""
    left = line_chunks.dedup_lines(docs)
    lost = left.columns[-2]
    return left.filter(~((F.col(lost) > 0) & (F.trim(F.regexp_replace("text", "[\t-\r]", " ")) == ""))).select(
        *(F.length("text").cast("long").alias("n_chars") if c == "n_chars" else F.col(c) for c in docs.columns)
    )


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays (five words, 0.8)."""
    return minhash_dedup.keep_one(docs, shingle=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return qgram_filter.decontaminate(docs, read(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Counts and digests of each document's ids and of their decoded text."""
    return bpe_stream.digest(docs, public_file("word_bpe_49k.json"))


STAGES = [
    ("quality", quality),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("tokens", tokens),
]

# A trained model, MinHash components and BPE have no SQL form; tests hold the stages
# against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on `documents`; the result is that of the last."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
