"""The registered queries of the subpackage and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import decontaminate, divergence, exact_dedup, hard_negatives, language_id, line_quality, lm_score, near_dedup, packing, resharding, secret_scan, sql, token_counts, toxicity


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_scan(_docs(spark, sf_dir))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_docs(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(_docs(spark, sf_dir))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.language_id(_docs(spark, sf_dir))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(_docs(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.lm_score(_docs(spark, sf_dir))


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_dedup(_docs(spark, sf_dir))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_docs(spark, sf_dir))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_docs(spark, sf_dir))


def op10_resharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resharding.reshard(_docs(spark, sf_dir))


def op11_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_quality.line_quality(_docs(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(_docs(spark, sf_dir))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.hard_negatives(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


QUERIES = {f.__name__: f for f in (op1_secret_scan, op2_toxicity, op3_exact_dedup, op4_language_id, op5_decontaminate, op6_lm_score, op7_near_dedup, op8_token_counts, op9_packing, op10_resharding, op11_line_quality, op12_divergence, op13_hard_negatives)}
ORACLE_SQL = {"op1_secret_scan": sql.SECRET_SCAN, "op3_exact_dedup": sql.EXACT_DEDUP, "op12_divergence": sql.DIVERGENCE, "op13_hard_negatives": sql.HARD_NEGATIVES}
