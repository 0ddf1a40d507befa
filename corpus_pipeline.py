"""From documents to training windows: quality, near duplicates, repeated passages, benchmarks, packing.

Each stage is (name, function), the function takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and read again as the next one's docs. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastra.llm import decontaminate, minhash, packing, passages, quality
from cadastra.llm.common import read, tokenizer_file, written


def _recounted(docs: DataFrame) -> DataFrame:
    """``n_chars`` of the texts as they are now."""
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def by_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the perplexity of their language's trusted texts doesn't reject."""
    model = quality.fit(docs, read(spark, sf_dir, "labels").where("quality = 1"))
    return quality.score(docs, model).where("kept").select(docs.columns)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, similarity 0.8."""
    return minhash.drop_near_duplicates(docs, n=5, percent=80)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of fifty words and more stay in one document only."""
    return _recounted(passages.remove_repeats(docs, n=5, words=50, percent=80))


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words in any ten-word window of a benchmark item go."""
    return _recounted(decontaminate.remove_spans(docs, read(spark, sf_dir, "benchmark"), n=10))


def into_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids with their places in windows of 1024."""
    return packing.pack(docs, tokenizer=tokenizer_file(), capacity=1024, end_id=0)


STAGES = [
    ("quality classifier", by_quality),
    ("near-duplicate documents", without_near_duplicates),
    ("repeated passages", without_repeats),
    ("benchmark decontamination", without_benchmarks),
    ("packing", into_windows),
]

#: Perplexities, MinHash, alignment and tokens have no form in SQL; tests/llm holds each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs)
    return docs
