"""Page files as a stream: every file is one page, so that row rules need no state and page rules are complete within a batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.operators import quality
from pagewright.sources import html

PATTERN = r"([^/]+)/page_(\d+)\.html$"


def read(spark: SparkSession, folder: str, max_files: int = 1000) -> DataFrame:
    """(doc_id, page, html, modified) of new page files below `folder`."""
    s = spark.readStream.format("text").schema("value string").option("wholetext", True).option("recursiveFileLookup", True).option("pathGlobFilter", "page_*.html").option("maxFilesPerTrigger", max_files).load(folder)
    path = F.col("_metadata.file_path")
    return s.select(F.regexp_extract(path, PATTERN, 1).alias("doc_id"), F.regexp_extract(path, PATTERN, 2).cast("int").alias("page"), F.col("value").alias("html"), F.col("_metadata.file_modification_time").alias("modified"))


def newest(pages: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """A page that is exported again within the delay counts once."""
    return pages.withWatermark("modified", delay).dropDuplicatesWithinWatermark(["doc_id", "page"])


def raw_blocks(pages: DataFrame, root: tuple[str, str | None] = ("div", "page")) -> DataFrame:
    return html.raw_blocks(pages.select("doc_id", "page", "html"), root)


def score_each_batch(pages: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, root: tuple[str, str | None] = ("div", "page")):
    """Start a query that gives each batch's page quality to `sink`."""

    def run(batch: DataFrame, epoch: int) -> None:
        blocks = html.typed_blocks(html.raw_blocks(batch.select("doc_id", "page", "html"), root))
        sink(quality.page_quality(blocks), epoch)

    return pages.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
