"""The training-text pipeline: stages over `documents`, each on what the one before kept.

Each stage takes (spark, docs, sf_dir). All but the last give the columns of `docs`; the last gives the packed pieces."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm import near_dups, packing, phrases, secrets, toxicity
from llm.columns import staged

#: Documents whose five-word shingles are alike to this percent or more are near duplicates here; op3_near_dups links from 85.
NEAR_PERCENT = 80


def _counted(docs: DataFrame) -> DataFrame:
    """n_chars of the text as it is now, in the type it had."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.coalesce(F.length("text"), F.col("n_chars")).cast(docs.schema["n_chars"].dataType))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more go; the classifier learns from the labelled ones that are in `docs`."""
    return toxicity.without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest doc_id stays."""
    return near_dups.one_of_each(docs, NEAR_PERCENT)


def drop_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words and more that an earlier document has go from the text. A text may become empty; its row stays."""
    return _counted(phrases.without_recurring(docs))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the text become marks that name their kind."""
    return _counted(secrets.redact_secrets(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens and their places in sequences."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near duplicates", drop_near_duplicates),
    ("substring dedup", drop_passages),
    ("secret scans", mask_secrets),
    ("packing", pack),
]
#: Scores and token ids cannot be said in SQL; the tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; what each keeps is written to the shared folder and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        docs = docs if name == STAGES[-1][0] else staged(docs)
    return docs
