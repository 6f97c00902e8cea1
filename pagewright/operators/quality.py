"""Page and document quality, Q1-Q12."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagewright.functions import text as X

# Weights (they add up to 0.90), scales and thresholds.
WEIGHTS = {"length": 0.20, "blocks": 0.15, "structure": 0.20, "coherence": 0.25, "special": 0.10}
FULL_LENGTH, FULL_BLOCKS, PROBLEM_BELOW, USUAL_SPACE = 500, 20, 0.50, 0.15
WORD = "[A-Za-zА-Яа-яЁё0-9]+"


def _clamp(c: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), c))


def page_quality(blocks: DataFrame) -> DataFrame:
    """One row for each page; an empty page has zeros and is a problem. Blocks: doc_id, page, seq, content, bbox (may be missing), depth (may be missing)."""
    box = F.col("bbox").isNotNull() if "bbox" in blocks.columns else F.lit(False)
    depth = F.coalesce(F.col("depth"), F.lit(0)) if "depth" in blocks.columns else F.lit(0)
    rows = blocks.select("doc_id", "page", "seq", F.coalesce("content", F.lit("")).alias("t"), box.cast("int").alias("boxed"), depth.cast("double").alias("depth"))
    rows = rows.withColumn("w", F.regexp_extract_all(F.lower("t"), F.lit(WORD), F.lit(0)))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("seq", "t"))), lambda x: x["t"])
    p = rows.groupBy("doc_id", "page").agg(F.array_join(ordered, "").alias("t"), F.count("*").alias("n"), F.avg("boxed").alias("bbox_ratio"), F.avg("depth").alias("depth"), F.flatten(F.collect_list("w")).alias("w"))
    p = p.withColumn("block_count", F.col("n")).withColumn("text_length", F.length(X.strip(F.col("t"))).cast("long"))
    length = F.greatest("text_length", F.lit(1))  # an empty page has no characters to count either
    p = p.withColumn("chars_per_block", F.col("text_length") / F.col("block_count"))
    p = p.withColumn("depth_score", F.when(F.col("depth") > 0, F.least(F.col("depth") / 3, F.lit(1.0))).otherwise(F.lit(0.5)))
    p = p.withColumn("structural_score", 0.5 * F.col("bbox_ratio") + 0.3 * (F.col("block_count") > 0).cast("double") + 0.2 * F.col("depth_score"))
    p = p.withColumn("alnum_ratio", X.count_of(F.col("t"), "[A-Za-zА-Яа-яЁё0-9]") / length).withColumn("whitespace_ratio", X.count_of(F.col("t"), r"(?U)\s") / length)
    p = p.withColumn("unique_words_ratio", F.when(F.size("w") > 0, F.size(F.array_distinct("w")) / F.size("w")).otherwise(F.lit(0.0)))
    p = p.withColumn("text_coherence_score", _clamp(0.5 * F.col("alnum_ratio") + 0.3 * F.col("unique_words_ratio") + 0.2 * (1 - F.abs(F.col("whitespace_ratio") - USUAL_SPACE))))
    p = p.withColumn("has_tables", X.detect_tables(F.col("t"))).withColumn("has_formulas", X.detect_formulas(F.col("t")))
    w = WEIGHTS
    score = w["length"] * F.least(F.col("text_length") / FULL_LENGTH, F.lit(1.0)) + w["blocks"] * F.least(F.col("block_count") / FULL_BLOCKS, F.lit(1.0))
    score = score + w["structure"] * F.col("structural_score") + w["coherence"] * F.col("text_coherence_score") + w["special"] * (F.col("has_tables") | F.col("has_formulas")).cast("double")
    p = p.withColumn("overall", _clamp(score)).withColumn("is_problematic", F.col("overall") < PROBLEM_BELOW)
    return p.drop("t", "w", "n")


def document_quality(pages: DataFrame) -> DataFrame:
    """Q11: the mean of the pages' unrounded scores."""
    return pages.groupBy("doc_id").agg(F.round(F.avg("overall"), 3).alias("confidence"), F.count("*").alias("pages_processed"))


def page_status(pages: DataFrame) -> DataFrame:
    """Q12."""
    return pages.select("doc_id", "page", F.round("overall", 3).alias("confidence"), F.when(F.col("is_problematic"), F.lit("low_confidence")).otherwise(F.lit("ok")).alias("status"))
