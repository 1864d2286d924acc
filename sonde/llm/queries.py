"""One query for each operator, over whole tables with production parameters, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sonde.llm import exact_dedup, language_model, lexical, line_dedup, mixing, packing, quality, resampling, secrets, simhash, suffix, token_counts, topk
from sonde.llm.common import table


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


def op2_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.exact_topk(table(spark, sf_dir, "embeddings"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_scan(table(spark, sf_dir, "documents"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.quality_scores(docs, model).select("doc_id", quality.held_out().alias("held_out"), "score", "predicted")


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.suffix_dedup(table(spark, sf_dir, "documents"))


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op8_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = line_dedup.line_dedup(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", F.col("__lines").alias("n_lines"), F.col("__removed").alias("n_removed"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), with_ids=False)


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.scores(table(spark, sf_dir, "documents"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(lexical.build(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"), "item_id")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (
        op1_token_counts, op2_exact_topk, op3_secret_scan, op4_exact_dedup, op5_quality_classifier, op6_suffix_dedup, op7_source_mixing,
        op8_simhash_dedup, op9_line_dedup, op10_best_fit_packing, op11_importance_resampling,
        op12_lm_scoring, op13_lexical_search,
    )
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    return {
        "op2_exact_topk": topk.ORACLE_SQL, "op4_exact_dedup": exact_dedup.ORACLE_SQL, "op7_source_mixing": mixing.ORACLE_SQL, "op9_line_dedup": line_dedup.ORACLE_SQL,
        "op11_importance_resampling": resampling.ORACLE_SQL, "op13_lexical_search": lexical.ORACLE_SQL,
    }
