"""From raw documents to tokens: five stages, each written as Parquet and read by the next.

Every stage but the last returns the columns of documents. A stage that fails or loses an
executor is run again from the files of the one before.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from icegrid.llm import bpe, decontaminate, language, minhash, pii
from icegrid.llm.queries import VOCABULARY
from icegrid.llm.text import tune_texts
from icegrid.session import scratch_dir

SIMILARITY = 0.8


def _staged(stage):
    """The stage with the session's settings for texts."""

    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        return stage(tune_texts(spark), docs, sf_dir)

    return run_stage


@_staged
def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts in a known language; those without letters or without evidence go."""
    model = language.fit(docs.where(~language.held_out(F.col("doc_id"))))
    return language.keep_identified(docs, model)


@_staged
def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return minhash.without_near_duplicates(docs, SIMILARITY)


@_staged
def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.decontaminate(docs, benchmark)


@_staged
def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind."""
    return pii.redact_documents(docs, pii.fit(docs))


@_staged
def tokenized(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with token_ids, n_tokens and whether these decode to the text.

    Columns of those names that documents may have are replaced.
    """
    tokens = bpe.read_ranks(VOCABULARY)
    kept = [c for c in docs.columns if c not in ("token_ids", "n_tokens", "round_trip")]
    text = F.col("text")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), text.alias("text"))
    both = bpe.encode_and_back(text, tokens, public_tokenizers.PATTERN, spark)
    rows = rows.withColumn("b", both)
    same = F.col("b.back") == F.coalesce(text, F.lit("")).cast("binary")
    return rows.select("row.*", F.col("b.ids").alias("token_ids"),
                       F.size("b.ids").cast("long").alias("n_tokens"), same.alias("round_trip"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", identified),
    ("near_duplicates", deduplicated),
    ("decontamination", decontaminated),
    ("personal_data", redacted),
    ("tokens", tokenized),
]

# Language models, trees and merges are not expressed in SQL; tests/llm holds the brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = scratch_dir(spark, "pipeline")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
