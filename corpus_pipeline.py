"""Training documents from raw ones: quality, near duplicates, benchmark passages, personal data, tokens.

Each stage works on all that its predecessor kept, which is written as Parquet to the shared folder and read again, so
that a stage never depends on executors that ran an earlier one.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm import bpe, decontaminate, near, pii, quality
from touchline.session import stage

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return quality.drop_bad(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates (five-word shingles, 0.8) stays."""
    return near.drop_near_duplicates(docs, size=5, percent=80)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts becomes the name of its kind; n_chars follows."""
    return pii.redact(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each document, and digests of them and of the decoded text."""
    return bpe.digests(docs, TOKENIZER)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("near-duplicates", near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("personal data", personal_data),
    ("BPE encoding", bpe_encoding),
]

#: No stage but the benchmark's can be told in SQL; tests hold each against brute force instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, over the documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), "documents")
    return STAGES[-1][1](spark, docs, sf_dir)
