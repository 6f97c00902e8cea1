"""Mixing sources to target weights (operator 8), DataFrame functions only.

Every source gets a budget of words. Its documents get hash-random keys and are laid out in key order; a running sum of sizes
along that order is cut at the budget, once more round the source for every whole epoch. The running sum has three levels, so that a
source of any share of the rows is summed by many tasks: sums of key ranges (cells) and of CELL_ROWS cells together (blocks), then
running sums over a source's blocks, over a block's cells, and over a cell's rows. The table of sources is broadcast if it has
BROADCAST_SOURCES rows at most, and rows are dealt by source and cell, never by source alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagewright.llm.common import own_name, written

#: Rows of a source in one key range, about; what one task must sort at least.
CELL_ROWS = 4096
#: Sources, a row of some 100 bytes each, that are broadcast; beyond it they are joined.
BROADCAST_SOURCES = 100_000


def n_words(text: Column) -> Column:
    """Runs of bytes other than 0x20 and 0x09-0x0D; null has none."""
    plain = F.translate(F.coalesce(text, F.lit("")), "\t\n\x0b\x0c\r", "     ")
    return F.size(F.array_remove(F.split(plain, " "), "")).cast("long")


def targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """(source, n_rows, source_size, target) for each source of `sizes` (source, n_rows, source_size).

    Sources by code point, null last, take the weights in turn; `share` times the sum of all sizes is dealt by weight. A target
    stops at `most` times its source's size and the excess is dealt again by weight among the others until none is above: sorted by
    size per weight, the sources that stop are the first ones, so that one running sum finds them. There is a row for each source,
    not for each document.
    """
    order = Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    filling = Window.partitionBy(F.lit(0)).orderBy("fill", F.col("source").asc_nulls_last())
    before, rest, every = filling.rowsBetween(Window.unboundedPreceding, -1), filling.rowsBetween(0, Window.unboundedFollowing), Window.partitionBy(F.lit(0))
    t = sizes.withColumn("weight", weight).withColumn("fill", F.col("source_size") / F.col("weight"))
    left = F.lit(share) * F.sum("source_size").over(every) - F.lit(most) * F.coalesce(F.sum("source_size").over(before), F.lit(0))
    t = t.withColumn("rate", left / F.sum("weight").over(rest)).withColumn("stops", F.col("rate") > F.lit(most) * F.col("fill"))
    rate = F.min(F.when(~F.col("stops"), F.struct("fill", F.coalesce("source", F.lit("\U0010ffff")), "rate"))).over(every)["rate"]
    target = F.when(F.col("stops"), F.lit(most) * F.col("source_size")).otherwise(F.least(F.col("weight") * rate, F.lit(most) * F.col("source_size")))
    return t.select("source", "n_rows", "source_size", F.coalesce(target, F.lit(0.0)).cast("double").alias("target"))


def mix(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, most: float = 2.0, seed: int = 42, whole: bool = False, carry: Sequence[str] = (), id_column: str = "doc_id", text_column: str = "text", source_column: str = "source") -> DataFrame:
    """doc_id, source, size, source_size, target, taken for every row.

    `taken` counts the words that the mix takes from the row, repeats included. Each epoch goes once round the source in key order;
    the last one stops at the budget exactly, within a document (whole=False), or takes the document there whole or not, whichever
    is nearer (whole=True). `carry` names more columns to keep. Null sources are a source of their own, null or empty texts have size 0 and nothing is taken, rows with
    equal ids are separate rows. The key is the md5 of seed and id, then comes the size, so that reruns agree (rows that are equal in
    both are interchangeable). An empty table gives an empty result. Other columns are ignored.
    """
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(source_column).cast("string").alias("source"), n_words(F.col(text_column)).alias("size"), F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_column).cast("string"), F.lit("")))).alias("key"), *carry)
    rows = written(rows, "mix-rows")
    plan = targets(rows.groupBy("source").agg(F.count("*").alias("n_rows"), F.sum("size").alias("source_size")), weights, share, most)
    plan = plan.withColumn("cells", F.ceil(F.col("n_rows") / F.lit(CELL_ROWS))).withColumn("budget", F.floor("target"))
    name = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("-"))
    plan = written(plan.withColumn("name", name).drop("source"), "mix-plan")
    few = plan.count() <= BROADCAST_SOURCES
    place = F.conv(F.substring("key", 1, 8), 16, 10).cast("double") / F.lit(2.0**32)
    dealt = rows.withColumn("name", name).join(F.broadcast(plan) if few else plan, "name").withColumn("cell", F.floor(place * F.col("cells")))
    sums = dealt.groupBy("name", "cell").agg(F.sum("size").alias("cell_size")).withColumn("block", F.floor(F.col("cell") / CELL_ROWS))
    sums = written(sums, "mix-cells")
    blocks = sums.groupBy("name", "block").agg(F.sum("cell_size").alias("block_size"))
    blocks = blocks.withColumn("block_start", F.sum("block_size").over(Window.partitionBy("name").orderBy("block")) - F.col("block_size"))
    before = F.sum("cell_size").over(Window.partitionBy("name", "block").orderBy("cell")) - F.col("cell_size")
    sums = sums.withColumn("before", before).join(blocks, ["name", "block"]).select("name", "cell", (F.col("block_start") + F.col("before")).alias("cell_start"))
    inside = Window.partitionBy("name", "cell").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    placed = dealt.withColumn("inside", F.sum("size").over(inside)).join(sums, ["name", "cell"]).withColumn("start", F.col("cell_start") + F.col("inside") - F.col("size"))
    rounds = F.when(F.col("source_size") > 0, F.floor(F.col("budget") / F.col("source_size"))).otherwise(F.lit(0))
    rest = F.col("budget") - rounds * F.col("source_size") - F.col("start")
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest))
    if whole:
        part = F.when(2 * part >= F.col("size"), F.col("size")).otherwise(F.lit(0))
    return placed.select("doc_id", "source", "size", "source_size", "target", (rounds * F.col("size") + part).cast("long").alias("taken"), "start", *carry)


def mixed_documents(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, most: float = 2.0, seed: int = 42) -> DataFrame:
    """The mix itself: every row as often as the mix takes it (whole documents), with the columns of `docs`."""
    row, often, copy = (own_name(docs, x) for x in ("__row", "__often", "__copy"))
    mine = written(docs.withColumn(row, F.monotonically_increasing_id()), "mix-input")
    t = mix(mine, weights, share, most, seed, whole=True, carry=[row])
    t = t.filter("taken > 0").select(row, (F.col("taken") / F.col("size")).cast("int").alias(often))
    return mine.join(t, row).withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(often)))).select(*[F.col(f"`{c}`") for c in docs.columns])
