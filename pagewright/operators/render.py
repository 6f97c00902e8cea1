"""Blocks as HTML, JSON and Markdown, R1-R9 and the sinks K1-K9."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagewright.functions import text as X

PLAIN_LIST = r"(?U)^(?:\d+(?:\.\d+)+|\.\d+)\s"
FIRST_ROWS, SHORT = 50, 150
DUMP_LENGTH = 6000


def _list_html(ordered_names: tuple[str, ...]) -> Column:
    text = X.strip(F.coalesce("content", F.lit("")))
    lines = F.filter(F.transform(F.split(text, "\n"), X.strip), lambda t: t != "")
    li = F.array_join(F.transform(lines, lambda t: F.concat(F.lit("<li>"), X.escape_html(t), F.lit("</li>"))), "")
    ol = F.col("list_type").isin(*ordered_names)
    tag = F.when(ol, F.lit("ol")).otherwise(F.lit("ul"))
    plain = F.when(~F.coalesce(ol, F.lit(False)) & text.rlike(PLAIN_LIST), F.lit(' class="plain"')).otherwise(F.lit(""))
    return F.concat(F.lit("<"), tag, plain, F.lit(">"), li, F.lit("</"), tag, F.lit(">"))


def table_html(columns: Column, rows: Column) -> Column:
    """R3."""
    head = F.when(F.size(columns) > 0, F.concat(F.lit("<tr>"), F.array_join(F.transform(columns, lambda c: F.concat(F.lit("<th>"), X.escape_html(F.coalesce(c, F.lit(""))), F.lit("</th>"))), ""), F.lit("</tr>"))).otherwise("")
    cell = lambda c: F.concat(F.lit("<td>"), X.escape_html(F.array_join(F.transform(c["block"], lambda b: b["content"]), " ")), F.lit("</td>"))
    body = F.array_join(F.transform(rows, lambda r: F.concat(F.lit("<tr>"), F.array_join(F.transform(r["cells"], cell), ""), F.lit("</tr>"))), "")
    return F.concat(F.lit("<table>"), F.coalesce(head, F.lit("")), F.coalesce(body, F.lit("")), F.lit("</table>"))


def block_html(blocks: DataFrame, image_dir: str = "images", ordered_names: tuple[str, ...] = ("ordered",)) -> DataFrame:
    """A column `html`. Lists are `ol` only for the list types named."""
    text = X.strip(F.coalesce("content", F.lit("")))
    get = lambda n, kind: F.col(n) if n in blocks.columns else F.lit(None).cast(kind)
    latex = X.strip(F.coalesce(get("latex", "string"), F.lit("")))
    level = F.greatest(F.lit(1), F.least(F.lit(6), F.coalesce(F.nullif(get("heading_level", "int"), F.lit(0)), F.lit(2)))).cast("string")
    title = F.when(latex != "", F.concat(F.lit(' title="'), X.escape_html(latex), F.lit('"'))).otherwise("")
    wrap = lambda a, c, b: F.concat(F.lit(a), c, F.lit(b))
    path = get("temp_path", "string")
    image = F.when(F.coalesce(path, F.lit("")) != "", F.concat(F.lit(f'<img src="{image_dir}/'), X.escape_html(F.substring_index(path, "/", -1)), F.lit('" alt="">'))).otherwise(F.concat(F.lit('<span class="missing">[image: '), X.escape_html(F.coalesce(get("image_key", "string"), F.lit(""))), F.lit("]</span>")))
    d = blocks if "list_type" in blocks.columns else blocks.withColumn("list_type", F.lit(None).cast("string"))
    table = table_html(F.col("columns"), F.col("rows")) if "rows" in blocks.columns else F.lit("<table></table>")
    html = (
        F.when(F.col("type") == "heading", F.concat(F.lit("<h"), level, F.lit(">"), X.escape_html(text), F.lit("</h"), level, F.lit(">")))
        .when(F.col("type") == "paragraph", wrap("<p>", X.escape_html(text), "</p>"))
        .when(F.col("type") == "formula", F.concat(F.lit('<div class="formula"'), title, F.lit(">"), X.escape_html(F.when(text != "", text).otherwise(latex)), F.lit("</div>")))
        .when(F.col("type") == "list", _list_html(ordered_names)).when(F.col("type") == "table", table).when(F.col("type") == "image", wrap('<div class="image-block">', image, "</div>"))
        .otherwise(wrap("<div>", X.escape_html(text), "</div>"))
    )
    return d.withColumn("html", html).select(*blocks.columns, "html")


def page_sections(rendered: DataFrame) -> DataFrame:
    """(doc_id, section, page, html): a new section whenever the page changes along the order of blocks."""
    w = Window.partitionBy("doc_id").orderBy("seq")
    change = F.when(F.lag("page").over(w).eqNullSafe(F.col("page")), 0).otherwise(1)
    d = rendered.withColumn("__c", change).withColumn("section", F.sum("__c").over(w).cast("int"))
    inner = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "html"))), lambda x: x["html"]), "")
    p = F.col("page").cast("string")
    html = F.concat(F.lit('<section class="page" id="page-'), p, F.lit('" data-page="'), p, F.lit('"><div class="page-label"><a href="#page-'), p, F.lit('">Страница '), p, F.lit("</a></div>"), F.col("inner"), F.lit("</section>"))
    return d.groupBy("doc_id", "section", "page").agg(inner.alias("inner")).select("doc_id", "section", "page", html.alias("html"))


def document_html(rendered: DataFrame) -> DataFrame:
    """A whole page of HTML for each document, with links to its distinct pages."""
    s = page_sections(rendered)
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("section", "html"))), lambda x: x["html"]), "\n")
    nav = F.array_join(F.transform(F.array_sort(F.collect_set("page")), lambda p: F.concat(F.lit('<a href="#page-'), p.cast("string"), F.lit('">'), p.cast("string"), F.lit("</a>"))), " ")
    d = s.groupBy("doc_id").agg(body.alias("body"), nav.alias("nav"))
    return d.select("doc_id", F.concat(F.lit('<!DOCTYPE html><html><head><meta charset="utf-8"><title>'), X.escape_html(F.col("doc_id").cast("string")), F.lit("</title></head><body><nav>"), F.col("nav"), F.lit("</nav>"), F.col("body"), F.lit("</body></html>")).alias("html"))


def result_json(blocks: DataFrame, quality: DataFrame | None = None) -> DataFrame:
    """K1: (doc_id, json) with the names of the result format; nulls are left out. quality: doc_id, confidence, pages_processed."""
    names = {"type": "type", "page": "page number", "content": "content", "latex": "latex", "heading_level": "heading level", "list_type": "list_type", "number_of_rows": "number_of_rows", "number_of_columns": "number_of_columns", "columns": "columns", "rows": "rows", "image_key": "image_key", "bbox": "bounding box"}
    block = F.struct(*[F.col(a).alias(b) for a, b in names.items() if a in blocks.columns])
    d = blocks.groupBy("doc_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("seq", F.to_json(block).alias("b")))), lambda x: x["b"]).alias("b"), F.countDistinct("page").alias("pages"))
    if quality is not None:
        d = d.join(quality.select("doc_id", "confidence"), "doc_id", "left")
    else:
        d = d.withColumn("confidence", F.lit(0.75))
    head = F.concat(F.lit('{"content":{"document":{"source":'), F.to_json(F.struct(F.col("doc_id").cast("string").alias("file_name"), F.col("pages").alias("page_count"))), F.lit(',"block":['), F.array_join("b", ","))
    return d.select("doc_id", F.concat(head, F.lit(']},"quality":'), F.to_json(F.struct("confidence", F.col("pages").alias("pages_processed"))), F.lit(',"errors":[],"status":"completed"}}')).alias("json"))


def write_text(df: DataFrame, column: str, folder: str) -> None:
    """K1-K3, K7-K9: one text file a document, in a folder for each."""
    df.select("doc_id", F.col(column).alias("value")).write.mode("overwrite").partitionBy("doc_id").text(folder)


def page_files(pages: DataFrame) -> DataFrame:
    """K5: page files' names and contents, pages without HTML left out; and the sha256 of the content."""
    return pages.filter("coalesce(html, '') <> ''").select("doc_id", "page", F.format_string("page_%04d.html", "page").alias("file"), "html", F.sha2(F.col("html").cast("binary"), 256).alias("sha256"))


def span_dump(spans: DataFrame, images: DataFrame | None = None) -> DataFrame:
    """K8: a text row for each span (box, font, size, text) and then for each image (IMG and its box) of a page, numbered."""
    b = F.col("bbox")
    text = F.format_string("%.1f %.1f %.1f %.1f %s %.1f %s", F.col("line_x0"), F.col("line_y0"), F.col("line_x1"), F.col("line_y1"), F.col("font"), F.col("size"), F.col("text"))
    rows = spans.select("doc_id", "page", F.struct(F.lit(0).alias("k"), "block_no", "line_no", "span_no").alias("at"), text.alias("dump"))
    if images is not None:
        image = F.format_string("IMG %.1f %.1f %.1f %.1f", b[0], b[1], b[2], b[3])
        none = F.lit(None).cast("int")
        rows = rows.unionByName(images.select("doc_id", "page", F.struct(F.lit(1).alias("k"), F.col("ord").cast("int").alias("block_no"), none.alias("line_no"), none.alias("span_no")).alias("at"), image.alias("dump")))
    n = F.row_number().over(Window.partitionBy("doc_id", "page").orderBy("at")) - 1
    return rows.select("doc_id", "page", n.alias("n"), "dump")


def page_dump(parts: dict[str, DataFrame]) -> DataFrame:
    """K9: the named texts of a page (doc_id, page, text) one under the other, white space collapsed and cut."""
    u = None
    for k, (name, df) in enumerate(parts.items()):
        d = df.select("doc_id", "page", F.lit(k).alias("k"), F.concat(F.lit(f"== {name} ==\n"), F.substring(X.collapse(F.col("text")), 1, DUMP_LENGTH)).alias("t"))
        u = d if u is None else u.unionByName(d)
    return u.groupBy("doc_id", "page").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "t"))), lambda x: x["t"]), "\n").alias("dump"))


def _table_lines(table: DataFrame, part: int, key: str, title: str) -> DataFrame:
    """A heading and a Markdown table of counts and scores by `key`, as numbered lines."""
    cells = [F.coalesce(F.col(key).cast("string"), F.lit("")), *[F.col(c).cast("string") for c in ("golden", "result", "matched", "precision", "recall", "f1")]]
    w = Window.partitionBy(F.lit(0)).orderBy(key)
    rows = table.withColumn("n", (F.row_number().over(w) + 1).cast("long")).select(F.lit(part).alias("part"), "n", F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |")).alias("line"))
    spark = table.sparkSession
    head = spark.createDataFrame([(part, 0, f"## {title}"), (part, 1, f"| {key} | golden | result | matched | precision | recall | f1 |")], "part int, n long, line string")
    return head.unionByName(rows)


def _first_lines(blocks: DataFrame, part: int, title: str) -> DataFrame:
    """A heading, the first FIRST_ROWS blocks, and how many more there are."""
    spark = blocks.sparkSession
    w = Window.partitionBy(F.lit(0)).orderBy("doc_id", "page", "seq")
    first = blocks.orderBy("doc_id", "page", "seq").limit(FIRST_ROWS).withColumn("n", F.row_number().over(w).cast("long"))
    listed = first.select(F.lit(part).alias("part"), "n", F.concat(F.lit("- p"), F.col("page").cast("string"), F.lit(" "), "type", F.lit(": "), F.substring("content", 1, SHORT)).alias("line"))
    more = blocks.agg(F.count("*").alias("c")).filter(F.col("c") > FIRST_ROWS).select(F.lit(part).alias("part"), F.lit(FIRST_ROWS + 1).cast("long").alias("n"), F.concat(F.lit("… and "), (F.col("c") - FIRST_ROWS).cast("string"), F.lit(" more")).alias("line"))
    return spark.createDataFrame([(part, 0, f"## {title}")], "part int, n long, line string").unionByName(listed).unionByName(more)


def full_report(summary: DataFrame, by_type: DataFrame, by_page: DataFrame, missed: DataFrame, extra: DataFrame) -> DataFrame:
    """(part, n, line) of the whole Markdown report: summary, tables by type and by page, first missed and first extra blocks."""
    out = _table_lines(summary, 1, "doc_id", "Summary").unionByName(_table_lines(by_type, 2, "type", "By type")).unionByName(_table_lines(by_page, 3, "page", "By page"))
    return out.unionByName(_first_lines(missed, 4, "Missed")).unionByName(_first_lines(extra, 5, "Extra"))


def markdown_report(by_type: DataFrame, missed: DataFrame) -> DataFrame:
    """R8, the short one: lines of a table by type, then the first missed blocks, and how many more there are."""
    row = F.concat(F.lit("| "), "type", F.lit(" | "), F.col("golden").cast("string"), F.lit(" | "), F.col("result").cast("string"), F.lit(" | "), F.col("matched").cast("string"), F.lit(" |"))
    w = Window.partitionBy(F.lit(0)).orderBy("doc_id", "page", "seq")
    first = missed.orderBy("doc_id", "page", "seq").limit(FIRST_ROWS).withColumn("n", F.row_number().over(w).cast("long"))
    listed = first.select(F.lit(2).alias("part"), "n", F.concat(F.lit("- p"), F.col("page").cast("string"), F.lit(" "), "type", F.lit(": "), F.substring("content", 1, SHORT)).alias("line"))
    more = missed.agg(F.count("*").alias("c")).filter(F.col("c") > FIRST_ROWS).select(F.lit(3).alias("part"), F.lit(0).cast("long").alias("n"), F.concat(F.lit("… and "), (F.col("c") - FIRST_ROWS).cast("string"), F.lit(" more")).alias("line"))
    types = by_type.withColumn("n", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("type")).cast("long")).select(F.lit(1).alias("part"), "n", row.alias("line"))
    return types.unionByName(listed).unionByName(more)


def diff_html(missed: DataFrame, extra: DataFrame, structure: DataFrame) -> DataFrame:
    """For each page its missed, then extra blocks, then blocks of another structure, as HTML."""
    side = lambda d, k, name, text: d.select("doc_id", "page", F.lit(k).alias("k"), "seq", F.concat(F.lit(f'<div class="{name}">'), X.escape_html(text), F.lit("</div>")).alias("h"))
    u = side(missed, 1, "missed", F.col("content")).unionByName(side(extra, 2, "extra", F.col("content")))
    u = u.unionByName(side(structure, 3, "structure", F.concat_ws(" / ", "golden_shape", "result_shape")))
    return u.groupBy("doc_id", "page").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "seq", "h"))), lambda x: x["h"]), "").alias("html"))
