"""Block tables made from the driver's tables, in Spark and in SQL alike.

`lines`: documents cut at line breaks; seq counts from 0, a page has 20 lines, the type goes by seq modulo 7.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PAGE_LINES = 20

LINES_SQL = f"""lines AS (
  SELECT doc_id, seq, (seq // {PAGE_LINES} + 1)::INT AS page, content,
    CASE seq % 7 WHEN 0 THEN 'heading' WHEN 3 THEN 'list' WHEN 5 THEN 'formula' ELSE 'paragraph' END AS type
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS content, (generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1)::BIGINT AS seq FROM documents))"""


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    d = docs.select("doc_id", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("seq", "content")).withColumn("seq", F.col("seq").cast("long"))
    m = F.col("seq") % 7
    kind = F.when(m == 0, "heading").when(m == 3, "list").when(m == 5, "formula").otherwise("paragraph")
    return d.select("doc_id", "seq", (F.floor(F.col("seq") / PAGE_LINES) + 1).cast("int").alias("page"), "content", kind.alias("type"))


#: Lines with a place on a page: left 72, a line of 12 points every 14, 6 points a character.
BOXES_SQL = LINES_SQL + f""", boxes AS (
  SELECT *, 72.0::DOUBLE AS x0, (72 + 14 * (seq % {PAGE_LINES}))::DOUBLE AS y0, (72 + 6 * length(content))::DOUBLE AS x1, (84 + 14 * (seq % {PAGE_LINES}))::DOUBLE AS y1 FROM lines)"""


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = lines(spark, sf_dir)
    at = F.col("seq") % PAGE_LINES
    box = F.array(F.lit(72.0), (72 + 14 * at).cast("double"), (72 + 6 * F.length("content")).cast("double"), (84 + 14 * at).cast("double"))
    return d.withColumn("bbox", box)


def with_content(df: DataFrame, content) -> DataFrame:
    return df.withColumn("content", content)


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/pages.parquet").select(F.col("page_id").cast("string").alias("doc_id"), F.lit(1).alias("page"), "html")
