"""A training corpus from raw documents, in five stages. Part of the subpackage pagewright.llm.

Each stage takes the documents that its predecessor wrote and returns documents with the same columns; the last one returns the
packing. Between stages the rows are written as Parquet in the shared folder, so that a lost executor never repeats an earlier stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.llm import op03_toxicity, op05_line_winnowing, op07_best_fit, op08_mixing, op09_jaccard_join
from pagewright.llm.common import written


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose restored text scores as toxic go."""
    return op03_toxicity.reject(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def deduplicate_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeats of runs of lines are cut from texts; n_chars follows the text."""
    d = op05_line_winnowing.deduplicate(docs)
    return d.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns) if "n_chars" in docs.columns else d.select(*docs.columns)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents joined by links of Jaccard 0.75 or more, the one with the least id stays."""
    return op09_jaccard_join.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows are repeated or left out so that the sources' words come near their targets."""
    return op08_mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row's pieces with their bins."""
    return op07_best_fit.best_fit(docs)


STAGES = [
    ("toxicity", reject_toxic),
    ("line_dedup", deduplicate_lines),
    ("jaccard_join", one_of_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Learned scores, windows of words and bins can't be told in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
