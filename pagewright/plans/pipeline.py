"""Parse and compare whole collections: pages and PDF tables in, block tables, quality and reports out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.config import Settings
from pagewright.operators import cleanup, compare, enrich, quality, render, rewrite
from pagewright.schema import DEFAULT_PAGE
from pagewright.sources import html
from pagewright.storage import stored


@dataclass
class Parsed:
    blocks: DataFrame
    pages: DataFrame
    documents: DataFrame


def page_sizes(pages: DataFrame, meta: DataFrame | None) -> DataFrame:
    """Sizes of all pages: the metadata's, else the default."""
    base = pages.select("doc_id", "page").distinct()
    if meta is None:
        return base.withColumns({"width": F.lit(DEFAULT_PAGE[0]), "height": F.lit(DEFAULT_PAGE[1])})
    return base.join(meta, ["doc_id", "page"], "left").withColumns({"width": F.coalesce("width", F.lit(DEFAULT_PAGE[0])), "height": F.coalesce("height", F.lit(DEFAULT_PAGE[1]))})


def parse(pages: DataFrame, spans: DataFrame | None = None, images: DataFrame | None = None, layout_texts: DataFrame | None = None, layout_tables: DataFrame | None = None, undecoded: DataFrame | None = None, meta: DataFrame | None = None, settings: Settings = Settings(), root: tuple[str, str | None] = ("div", "page"), page_aware: bool = False, image_folder: str | None = None) -> Parsed:
    """From page HTML (doc_id, page, html) and, where there are any, PDF spans, images and the layout document's boxes.

    The order: substitute formulas, parse, rewrite, enrich, title levels, boxes from the PDF and then the layout, images, cleanup,
    quality. Formula images need boxes first; `page_aware` compares them with the boxes of their own page alone. Image files are
    written to `image_folder`, if there is one, by document.
    """
    sizes = page_sizes(pages, meta)
    lines = enrich.span_lines(spans) if spans is not None else None
    if undecoded is not None and lines is not None:
        pages = enrich.substitute_undecoded(pages, undecoded, lines, sizes)
    # Stored between groups of rules: each group reads its input more than once, and plans would multiply.
    blocks = stored(html.typed_blocks(html.raw_blocks(pages, root)), "blocks-raw")
    for k in range(0, len(rewrite.LAYOUT_RULES), 5):
        for rule in rewrite.LAYOUT_RULES[k : k + 5]:
            blocks = rule(blocks)
        blocks = stored(blocks, "blocks-layout")
    if lines is not None:
        lines = stored(lines, "pdf-lines")
        before, blocks = blocks, stored(enrich.enriched(blocks, lines), "blocks-enriched")
        index = enrich.overlay(enrich.bbox_index(lines), enrich.new_entries(before, blocks))
        blocks = enrich.title_levels(blocks, lines, settings.publisher_logo)
        blocks = enrich.restore_boxes(blocks, index)
    if layout_texts is not None:
        blocks = enrich.layout_boxes(blocks, layout_texts, sizes)
    if layout_tables is not None:
        blocks = enrich.bind_tables(blocks, layout_tables)
    if images is not None:
        files = enrich.name_images(images)
        blocks = stored(enrich.inject_images(enrich.bind_images(blocks, files), files), "blocks-images")
        formulas = enrich.formula_images(enrich.image_candidates(images.filter("bytes IS NOT NULL"), sizes), blocks, page_aware)
        blocks = enrich.inject_formulas(blocks, formulas)
        if image_folder is not None:
            named = files.select("doc_id", "file", "bytes").unionByName(formulas.select("doc_id", "file", "bytes"))
            stored(enrich.write_images(named, image_folder), "images")
    blocks = stored(cleanup.cleanup(stored(blocks, "blocks-bound"), settings, store=stored), "blocks")
    scored = quality.page_quality(blocks)
    return Parsed(blocks, quality.page_status(scored), quality.document_quality(scored))


@dataclass
class Report:
    match: DataFrame
    summary: DataFrame
    by_type: DataFrame
    by_page: DataFrame
    missed: DataFrame
    extra: DataFrame
    structure: DataFrame
    coverage: DataFrame
    status: DataFrame
    diff: DataFrame


def compare_documents(golden: DataFrame, result: DataFrame, settings: Settings = Settings()) -> Report:
    """Score result blocks against golden blocks of the same documents."""
    g, r = stored(compare.prepared(golden), "golden"), stored(compare.prepared(result), "result")
    match = stored(compare.greedy_match(g, r, settings.match_threshold), "match")
    status = stored(compare.status_rows(g, r, match), "status")
    missed, extra, structure = compare.unmatched(status, "missed"), compare.unmatched(status, "extra"), compare.structure_mismatches(g, r, match)
    return Report(match, compare.scores(status, "doc_id"), compare.scores(status, "type"), compare.scores(status, "page"), missed, extra, structure, compare.text_coverage(g, r, match), status, render.diff_html(missed, extra, structure))
