"""One query for each operator, over its whole table, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from llm import bpe, exact_dups, hard_negatives, langid, licenses, near_dups, neighbours, oracles, packing, periodic_runs, phrases, repeats, secrets, toxicity


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_digests(_documents(spark, sf_dir))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op3_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.grouped(_documents(spark, sf_dir))


def op4_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dups.removal_digests(_documents(spark, sf_dir))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_held_out(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predict_held_out(_documents(spark, sf_dir))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.quality_counts(_documents(spark, sf_dir)).drop("repeat_share", "longest_repeat")


def op8_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.removal_digests(_documents(spark, sf_dir))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digests(_documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op10_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "vec_id % 50 = 0")


def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.run_digests(_documents(spark, sf_dir))


def op12_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(_documents(spark, sf_dir))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine_embeddings(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secrets": op1_secrets,
    "op2_packing": op2_packing,
    "op3_near_dups": op3_near_dups,
    "op4_substrings": op4_substrings,
    "op5_toxicity": op5_toxicity,
    "op6_quality": op6_quality,
    "op7_language": op7_language,
    "op8_phrases": op8_phrases,
    "op9_bpe": op9_bpe,
    "op10_neighbours": op10_neighbours,
    "op11_runs": op11_runs,
    "op12_licenses": op12_licenses,
    "op13_hard_negatives": op13_hard_negatives,
}
ORACLES: dict[str, str] = {
    "op1_secrets": oracles.OP1,
    "op3_near_dups": oracles.OP3,
    "op4_substrings": oracles.OP4,
    "op6_quality": oracles.OP6,
    "op8_phrases": oracles.OP8,
    "op11_runs": oracles.OP11,
    "op12_licenses": oracles.OP12,
    "op13_hard_negatives": oracles.OP13,
}
