"""Command line: parse saved page HTML into JSON and HTML, score a result against golden JSON, or convert PDF files by the service."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from pagewright.config import Settings
from pagewright.operators import render
from pagewright.plans.pipeline import compare_documents, parse
from pagewright.sources import files, html


def _options() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(description=__doc__)
    sub = p.add_subparsers(dest="command", required=True)
    for name in ("parse", "compare"):
        c = sub.add_parser(name)
        c.add_argument("--html-dir", required=name == "parse", help="folder of <document>/page_*.html")
        c.add_argument("--out", required=True)
        c.add_argument("--spans", help="PDF spans as Parquet")
        c.add_argument("--images", help="PDF images as Parquet")
        c.add_argument("--layout", help="layout JSON files, <document>.json")
        c.add_argument("--metadata", help="metadata JSON files, <document>.json")
        c.add_argument("--page-aware", action="store_true", help="compare formula images with the boxes of their page alone")
        c.add_argument("--result", help="result JSON to score instead of parsing")
        c.add_argument("--golden", required=name == "compare", help="golden JSON")
        c.add_argument("--threshold", type=float, default=0.6)
    e = sub.add_parser("export")
    e.add_argument("--pdf-dir", required=True)
    e.add_argument("--out", required=True)
    e.add_argument("--max-pages", type=int, default=Settings().max_pages)
    return p


def _parsed(spark: SparkSession, a: argparse.Namespace, settings: Settings):
    more: dict = {}
    name = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)\.json$", 1)
    if a.layout:
        layout = files.read_layout(spark, a.layout).withColumn("doc_id", name)
        more |= {"layout_texts": files.layout_texts(layout), "layout_tables": files.layout_tables(layout), "undecoded": files.layout_undecoded(layout)}
    if a.metadata:
        metadata = files.read_metadata(spark, a.metadata)
        more |= {"meta": files.page_meta(metadata, name), "undecoded": files.undecoded_formulas(metadata, name)}
    if a.images:
        more |= {"images": files.read_images(spark, a.images), "image_folder": f"{a.out}/images"}
    return parse(html.read_pages(spark, a.html_dir), spans=files.read_spans(spark, a.spans) if a.spans else None, settings=settings, page_aware=a.page_aware, **more)


def _export(spark: SparkSession, a: argparse.Namespace, settings: Settings) -> None:
    """Layout documents by the service, and the metadata that parsing needs, one JSON file a document in a folder for each."""
    pdf = spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").load(a.pdf_dir)
    pdf = pdf.select(F.regexp_extract("path", r"([^/]+)\.pdf$", 1).alias("doc_id"), "content", F.lit(a.max_pages).alias("n_pages"))
    layout = files.kept_layout(files.convert_with_service(pdf, settings.serve_url, settings.serve_timeout, a.max_pages))
    render.write_text(layout, "layout", f"{a.out}/layout")
    render.write_text(files.layout_metadata(layout, pdf.select("doc_id", F.sha2("content", 256).alias("sha256"))), "metadata", f"{a.out}/metadata")


def main(argv: list[str] | None = None) -> None:
    a = _options().parse_args(argv)
    spark = SparkSession.builder.appName("pagewright").getOrCreate()
    if a.command == "export":
        return _export(spark, a, Settings())
    settings = Settings(match_threshold=a.threshold)
    if a.result:
        blocks = files.read_results(spark, a.result)
    else:
        parsed = _parsed(spark, a, settings)
        blocks = parsed.blocks
        render.write_text(render.result_json(blocks, parsed.documents), "json", f"{a.out}/json")
        render.write_text(render.document_html(render.block_html(blocks)), "html", f"{a.out}/html")
    if a.command == "compare":
        golden = files.read_results(spark, a.golden)
        report = compare_documents(golden, blocks, settings)
        for name in ("summary", "by_type", "by_page", "missed", "extra", "structure", "coverage", "status", "diff"):
            getattr(report, name).write.mode("overwrite").json(f"{a.out}/report/{name}")
        lines = render.full_report(report.summary, report.by_type, report.by_page, report.missed, report.extra)
        lines.orderBy("part", "n").select(F.col("line").alias("value")).coalesce(1).write.mode("overwrite").text(f"{a.out}/report/markdown")
        render.write_text(render.document_html(render.block_html(golden)), "html", f"{a.out}/golden_html")
        report.summary.join(report.coverage.select("doc_id", "coverage"), "doc_id", "left").orderBy("doc_id").show(truncate=False)
    else:
        blocks.groupBy("doc_id").agg(F.count("*").alias("blocks"), F.countDistinct("page").alias("pages")).orderBy("doc_id").show(truncate=False)


if __name__ == "__main__":
    main()
