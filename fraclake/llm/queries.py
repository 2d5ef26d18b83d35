"""The registered queries of this subpackage, and their DuckDB twins where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from fraclake.llm import (decision_lists, decontamination, exact_copies, hard_negatives, importance, language, line_frequency, near_duplicates,
                          packing, token_counts, toxicity, training_order, whitening)

VOCABULARY = "byte_bpe_50k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_decision_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decision_lists.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def op6_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training_order.report(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def op7_string_kernel_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.languages(table(spark, sf_dir, "documents"))


def op8_nearest_toxic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_site_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_frequency.report(table(spark, sf_dir, "documents"))


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.link(table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mined(table(spark, sf_dir, "embeddings"))


def op12_jacobi_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


def op13_radix_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_copies.report(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_importance_resampling, op2_decision_lists, op3_token_counts, op4_benchmark_decontamination, op5_sum_of_squares_packing,
    op6_training_order, op7_string_kernel_language, op8_nearest_toxic, op9_site_line_frequency, op10_minhash_near_dedup,
    op11_hard_negatives, op12_jacobi_whitening, op13_radix_exact_dedup)}
ORACLES: dict[str, str] = {"op4_benchmark_decontamination": decontamination.SQL, "op9_site_line_frequency": line_frequency.SQL,
                           "op10_minhash_near_dedup": near_duplicates.SQL, "op11_hard_negatives": hard_negatives.SQL,
                           "op13_radix_exact_dedup": exact_copies.SQL}
