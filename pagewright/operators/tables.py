"""Table structuring, T1-T7: raw rows of texts to columns, rows and cells, all in array functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagewright.functions import text as X
from pagewright.schema import BLOCK

# Fixed values.
HEADER_MATH = "(?iu)[·×≤≥±−\\x{f0d7}\\x{f044}φθα-ω∆∇∑∫√∞π]"
SWAP_FORMULA = "[·×≤≥±−\\x{f0d7}\\x{f044}]"
SWAP_CODE = r"(?U)^[A-Z]\d[\d,()\sA-Z-]+$"


def _range(n: Column) -> Column:
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def _padded(row: Column, n: Column) -> Column:
    return F.concat(row, F.array_repeat(F.lit(""), F.greatest(n - F.size(row), F.lit(0)).cast("int")))


def structured(raw: DataFrame) -> DataFrame:
    """Block rows whose `rows` are texts (with has_header, header_rows) to block rows with structured tables."""
    rows, heads = F.col("rows"), F.coalesce("header_rows", F.array().cast("array<int>"))
    width = F.coalesce(F.array_max(F.transform(rows, F.size)), F.lit(0))  # T1
    df = raw.withColumn("__w", width).withColumn("__heads", F.filter(heads, lambda h: h < F.size(rows)))
    math = lambda c: F.exists(F.col("__heads"), lambda h: F.coalesce(F.get(F.get(rows, h), F.lit(c)), F.lit("")).rlike(HEADER_MATH))
    some = lambda c: F.exists(F.col("__heads"), lambda h: F.trim(F.coalesce(F.get(F.get(rows, h), F.lit(c)), F.lit(""))) != "")
    swap = F.coalesce(F.col("has_header") & (F.col("__w") == 2) & some(0) & some(1) & (math(0) != math(1)), F.lit(False))  # T3
    df = df.withColumn("__swap", swap)
    cell = lambda r, t, c: F.struct(
        (r + 1).cast("int").alias("row_number"), (c + 1).cast("int").alias("column_number"), F.lit(1).alias("row_span"), F.lit(1).alias("column_span"), F.lit(1).alias("page"),
        F.array(*[F.lit(0.0)] * 4).alias("bbox"), F.array(F.struct(X.strip(t).alias("content"))).alias("block"),
    )

    def row(texts: Column, r: Column) -> Column:
        cells = F.transform(_padded(texts, F.col("__w")), lambda t, c: cell(r, t, c))  # T2
        a, b = X.strip(F.get(texts, F.lit(0))), X.strip(F.get(texts, F.lit(1)))
        turn = F.col("__swap") & F.coalesce(a.rlike(SWAP_FORMULA) & b.rlike(SWAP_CODE), F.lit(False))  # T4
        return F.struct((r + 1).cast("int").alias("row_number"), F.when(turn, F.reverse(cells)).otherwise(cells).alias("cells"))

    # T5: header rows from the top; the lowest one names the columns, blanks come from above, nearest first.
    lead = F.coalesce(F.size(F.filter(_range(F.size("__heads")), lambda i: F.get(F.col("__heads"), i) == F.get(F.col("__heads"), F.lit(0)) + i)), F.lit(0))
    df = df.withColumn("__lead", F.when(F.coalesce(F.col("has_header"), F.lit(False)), lead).otherwise(0))
    first = F.get(F.col("__heads"), F.lit(0))
    above = F.reverse(F.slice(rows, first + 1, F.greatest(F.col("__lead") - 1, F.lit(0))))
    lowest = _padded(F.get(rows, first + F.col("__lead") - 1), F.col("__w"))
    folded = F.transform(lowest, lambda t, c: F.when(X.strip(t) != "", t).otherwise(F.coalesce(F.get(F.filter(F.transform(above, lambda r: F.get(r, c)), lambda x: X.strip(x) != ""), F.lit(0)), t)))
    fallback = F.coalesce(F.col("has_header"), F.lit(False)) & (F.col("__lead") == 0)  # T6
    columns = F.when(F.col("__lead") > 0, folded).when(fallback, F.get(rows, F.lit(0))).otherwise(F.array().cast("array<string>"))
    skip = F.when(F.col("__lead") > 0, F.col("__lead")).when(fallback & (F.size(rows) > 1), 1).otherwise(0)
    body = F.slice(F.transform(rows, row), skip + 1, F.greatest(F.size(rows) - skip, F.lit(0)))
    is_table = F.col("type") == "table"
    df = df.withColumn("__columns", F.when(is_table, columns)).withColumn("__body", F.when(is_table, body))
    df = df.withColumn("columns", F.col("__columns")).withColumn("rows", F.col("__body")).withColumn("number_of_rows", F.when(is_table, F.size("__body"))).withColumn("number_of_columns", F.when(is_table, F.col("__w")))  # T7
    return df.select(*[F.col(f.name).cast(f.dataType) for f in T.StructType.fromDDL(BLOCK).fields])
