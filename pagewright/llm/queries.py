"""The queries opN_<name> and their SQL; each takes its rows from its operator, over the whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pagewright.llm.common import documents
from pagewright.llm.oracles import SQL as SQL


def op1_token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from pagewright.llm.op01_token_planes import token_planes

    return token_planes(documents(spark, sf_dir, "doc_id", "text"), str(public_tokenizers.path("word_bpe_49k.json")), end_id=1)


def op2_scaled_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pagewright.llm.op02_scaled_sketch import fingerprints

    return fingerprints(documents(spark, sf_dir, "doc_id", "text"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pagewright.llm.op03_toxicity import score

    return score(documents(spark, sf_dir, "doc_id", "text"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op4_isolation_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pagewright.llm.op04_isolation_forest import judge

    return judge(documents(spark, sf_dir, "doc_id", "text"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op5_line_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pagewright.llm.op05_line_winnowing import digest

    return digest(documents(spark, sf_dir, "doc_id", "text"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pagewright.llm.op06_suffix_dedup import deduplicate

    return deduplicate(documents(spark, sf_dir, "doc_id", "text"))


def op7_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pagewright.llm.op07_best_fit import best_fit

    return best_fit(documents(spark, sf_dir, "doc_id", "text"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pagewright.llm.op08_mixing import mix

    return mix(documents(spark, sf_dir, "doc_id", "text", "source")).select("doc_id", "size", "source_size", "target", "taken")


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pagewright.llm.op09_jaccard_join import jaccard_components

    return jaccard_components(documents(spark, sf_dir, "doc_id", "text"))


def op10_log_bilinear(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pagewright.llm.op10_log_bilinear import log_bilinear_scores

    return log_bilinear_scores(documents(spark, sf_dir, "doc_id", "text"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_token_planes, op2_scaled_sketch, op3_toxicity, op4_isolation_forest, op5_line_winnowing, op6_suffix_dedup, op7_best_fit, op8_mixing, op9_jaccard_join, op10_log_bilinear)}
