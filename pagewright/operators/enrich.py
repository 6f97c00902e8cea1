"""What the raw PDF adds to layout blocks, E1-E21: missing lines, boxes, images."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagewright.functions import geometry as G
from pagewright.functions import text as X

# Fixed values.
NUMERIC = r"(?U)^[\d\s\-—/]+$"
LETTER = r"[А-Яа-яA-Za-z\x{370}-\x{3FF}\x{1D400}-\x{1D7FF}]"
FORMULA_NUMBER = r"^\(\d{1,2}(?:\.\d{1,2})+\)$"
TABLE_CAPTION = r"(?U)^Таблица\s+\d{1,2}(?:\.\d{1,2}){1,2}(?=$|\s)"
MATH_SHARE, LEAST_KEY, SAME_PLACE = 0.3, 3, 0.5
TITLE_LEVELS = ((0.7, 1), (0.45, 2))
TITLE_LENGTH = 12
ROWS = "array<struct<cells:array<struct<block:array<struct<content:string>>>>>>"
MARKER = '<div class="formula-not-decoded">Formula not decoded</div>'


def span_lines(spans: DataFrame) -> DataFrame:
    """Spans to lines with the share of characters in mathematical fonts."""
    n = F.length("text")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("span_no", "text"))), lambda x: x["text"]), "")
    out = spans.groupBy("doc_id", "page", "block_no", "line_no").agg(
        X.strip(text).alias("text"), F.array(F.min("line_x0"), F.min("line_y0"), F.max("line_x1"), F.max("line_y1")).alias("bbox"), F.max("size").alias("size"),
        F.coalesce(F.sum(F.when(X.is_math_font(F.col("font")), n).otherwise(0)) / F.nullif(F.sum(n), F.lit(0)), F.lit(0.0)).alias("math_share"),
    )
    return out.filter("text <> ''")


def substitute_undecoded(pages: DataFrame, boxes: DataFrame, lines: DataFrame, page_meta: DataFrame) -> DataFrame:
    """The i-th marker of a page takes the one text line in the i-th box, if there is just one."""
    b = boxes.join(page_meta, ["doc_id", "page"]).withColumn("area", G.clip(F.col("bbox"), F.col("width"), F.col("height")))
    inside = (F.col("l")[0] >= F.col("area")[0]) & (F.col("l")[1] >= F.col("area")[1]) & (F.col("l")[2] <= F.col("area")[2]) & (F.col("l")[3] <= F.col("area")[3])
    good = lines.filter((F.length("text") >= 3) & ~F.col("text").rlike(r"(?U)^[\d\W]+$")).select("doc_id", "page", "text", F.col("bbox").alias("l"))
    found = b.join(good, ["doc_id", "page"]).filter(inside).groupBy("doc_id", "page", "ord").agg(F.count("*").alias("n"), F.min("text").alias("text")).filter("n = 1")
    texts = found.groupBy("doc_id", "page").agg(F.map_from_entries(F.collect_list(F.struct("ord", "text"))).alias("texts"))
    parts = F.split("html", MARKER.replace("-", r"\-"), -1)
    put = F.transform(parts, lambda p, i: F.concat(F.when(i == 0, "").otherwise(F.coalesce(F.concat(F.lit("<p>"), X.escape_html(F.get(F.map_values(F.map_filter("texts", lambda k, v: k == i - 1)), F.lit(0))), F.lit("</p>")), F.lit(MARKER))), p))
    return pages.join(texts, ["doc_id", "page"], "left").withColumn("html", F.when(F.col("texts").isNull(), F.col("html")).otherwise(F.array_join(put, ""))).drop("texts")


def page_text(blocks: DataFrame) -> DataFrame:
    """All block texts of a page as one, without separators after a leading space; blank blocks don't count. A table's text is its
    content, cells and column names."""
    get = lambda n, kind: F.col(n) if n in blocks.columns else F.lit(None).cast(kind)
    text = X.page_block_text(F.col("type"), F.col("content"), get("columns", "array<string>"), get("rows", ROWS)) if "type" in blocks.columns else F.coalesce("content", F.lit(""))
    d = blocks.select("doc_id", "page", "seq", text.alias("t")).filter(X.strip(F.col("t")) != "")
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("seq", X.norm_pdf(F.col("t")).alias("t")))), lambda x: x["t"])
    return d.groupBy("doc_id", "page").agg(F.concat(F.lit(" "), F.array_join(ordered, "")).alias("page_text"))


def missing_lines(lines: DataFrame, texts: DataFrame) -> DataFrame:
    """Lines that the page's blocks don't hold, not even without a closing number or without spaces."""
    texts = texts.withColumn("page_flat", X.flat(F.col("page_text")))  # once a page, not once a line
    d = lines.withColumn("norm", X.norm_pdf(F.col("text"))).withColumn("flat", X.flat(F.col("norm")))
    j = d.join(texts, ["doc_id", "page"], "left").withColumn("page_text", F.coalesce("page_text", F.lit(""))).withColumn("page_flat", F.coalesce("page_flat", F.lit("")))
    bare = F.regexp_replace("norm", r"(?U)[\d\s]+\s*$", "")
    t = F.col("page_text")
    held = t.contains(F.col("norm")) | ((bare != "") & ~bare.rlike(r"[-.]$") & t.contains(bare)) | F.col("page_flat").contains(F.col("flat"))
    return j.filter(~((t != "") & held)).drop("page_text", "page_flat", "flat")


def line_kind(text: Column, math_share: Column) -> Column:
    """Number, caption, noise, formula or text."""
    cleaned = X.soft_clean(text)
    hint = text.rlike(X.FORMULA_HINT) & ~text.rlike("^[а-яёА-ЯЁ«]") & (F.size(F.regexp_extract_all(text, F.lit(X.CYRILLIC_TOKEN), F.lit(1))) < 4) & ~text.contains("если")
    formula = ((math_share >= MATH_SHARE) & ~text.startswith("где ")) | hint
    return (
        F.when(text.rlike(FORMULA_NUMBER), F.lit("number")).when(text.rlike(NUMERIC) | ~text.rlike(LETTER), F.lit("noise")).when(text.rlike(TABLE_CAPTION), F.lit("caption"))
        .when(formula, F.lit("formula")).when(X.is_garbage(cleaned), F.lit("noise")).otherwise(F.lit("text"))
    )


def attach_formula_numbers(lines: DataFrame) -> DataFrame:
    """A number line closes the last formula of its page that has none yet; number lines go. lines: doc_id, page, seq, kind, text."""
    page = Window.partitionBy("doc_id", "page").orderBy("seq")
    owner = F.last(F.when(F.col("kind") == "formula", F.col("seq")), ignorenulls=True).over(page)
    # All of an owner's rows see its first number: one sort of the page's lines, which are read once.
    own = Window.partitionBy("doc_id", "page", "owner").orderBy("seq").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    number = F.first(F.when(F.col("kind") == "number", F.col("text")), ignorenulls=True).over(own)
    out = lines.withColumn("owner", owner).withColumn("number", number).filter("kind <> 'number'")
    return out.withColumn("text", F.concat_ws(" ", "text", F.when(F.col("owner") == F.col("seq"), F.col("number")))).drop("owner", "number")


def split_captions(lines: DataFrame) -> DataFrame:
    """A table caption becomes its own row before what is left of its line."""
    head = F.regexp_extract("text", TABLE_CAPTION, 0)
    rest = X.soft_clean(F.regexp_replace("text", TABLE_CAPTION, ""))
    pieces = F.when(head != "", F.filter(F.array(F.struct(F.lit("caption").alias("kind"), X.strip(head).alias("text")), F.struct(F.lit("text").alias("kind"), rest.alias("text"))), lambda x: x["text"] != "")).otherwise(F.array(F.struct(F.col("kind"), F.col("text"))))
    out = lines.select("*", F.posexplode(pieces).alias("part", "piece"))
    return out.withColumn("kind", F.col("piece.kind")).withColumn("text", F.col("piece.text")).drop("piece")


def paragraphs(lines: DataFrame) -> DataFrame:
    """Text lines of one PDF block between its formula lines are a paragraph. lines: doc_id, page, block_no, seq, kind, text, bbox."""
    block = Window.partitionBy("doc_id", "page", "block_no").orderBy("seq")
    d = lines.withColumn("run", F.sum((F.col("kind") == "formula").cast("int")).over(block)).filter("kind = 'text'")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "text"))), lambda x: x["text"]), " ")
    return d.groupBy("doc_id", "page", "block_no", "run").agg(F.min("seq").alias("seq"), text.alias("content"), G.union_agg(F.col("bbox")).alias("bbox"))


def enriched(blocks: DataFrame, lines: DataFrame) -> DataFrame:
    """Layout blocks and, at the end of each document, the formulas and paragraphs that the PDF has and they lack.

    lines: span_lines with seq. Formulas carry no mark of being enriched.
    """
    numbered = lines.withColumn("seq", F.col("block_no") * F.lit(100000).cast("long") + F.col("line_no"))
    left = missing_lines(numbered, page_text(blocks)).withColumn("kind", line_kind(F.col("text"), F.col("math_share")))
    # Noise goes after the window: a filter below it would compute the kind a second time.
    left = split_captions(attach_formula_numbers(left).filter("kind <> 'noise'"))
    new = _lines_to_blocks(left)
    offset = blocks.groupBy("doc_id").agg((F.max("seq") + 1).alias("offset"))
    w = Window.partitionBy("doc_id").orderBy("page", "seq", "part")
    new = new.join(offset, "doc_id", "left").withColumn("seq", F.coalesce("offset", F.lit(0)) + F.row_number().over(w) - 1).drop("offset", "part")
    return blocks.unionByName(new, allowMissingColumns=True)


def _lines_to_blocks(left: DataFrame) -> DataFrame:
    """Formulas and captions as they are, text lines as in `paragraphs`; in one pass, as what makes the lines is dear."""
    block = Window.partitionBy("doc_id", "page", "block_no").orderBy("seq")
    text = F.col("kind") == "text"
    d = left.filter("kind IN ('formula', 'caption', 'text')").withColumn("run", F.sum((F.col("kind") == "formula").cast("int")).over(block))
    d = d.withColumn("text", F.when(text, X.soft_clean(F.col("text"))).otherwise(F.col("text"))).withColumn("one", F.when(~text, F.struct("seq", "part")))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "text"))), lambda x: x["text"]), " ")
    out = d.groupBy("doc_id", "page", "block_no", "run", "kind", "one").agg(F.min("seq").alias("first"), joined.alias("content"), G.union_agg(F.col("bbox")).alias("around"), F.first("bbox").alias("own"))
    return out.select(
        "doc_id", "page", F.col("first").alias("seq"), F.when(text, F.lit(2)).otherwise(F.col("one.part")).alias("part"), F.when(F.col("kind") == "formula", F.lit("formula")).otherwise(F.lit("paragraph")).alias("type"),
        "content", F.when(text, F.col("around")).otherwise(F.col("own")).alias("bbox"), (F.col("kind") != "formula").alias("is_enriched"),
    )


def bbox_index(lines: DataFrame, priority: int = 0) -> DataFrame:
    """Line text to box, the last line of a text winning."""
    box = F.transform("bbox", lambda v: F.round(v, 1))
    order = F.struct("block_no", "line_no")
    return lines.withColumn("norm", X.norm_pdf(F.col("text"))).filter(F.length("norm") >= LEAST_KEY).groupBy("doc_id", "page", "norm").agg(F.max_by(box, order).alias("bbox"), F.lit(priority).alias("priority"))


def overlay(*indexes: DataFrame) -> DataFrame:
    """Of the same key the index with the highest priority."""
    u = indexes[0]
    for i in indexes[1:]:
        u = u.unionByName(i)
    return u.groupBy("doc_id", "page", "norm").agg(F.max_by("bbox", "priority").alias("bbox"))


def lookup(texts: DataFrame, index: DataFrame) -> DataFrame:
    """Texts (doc_id, page, seq, text) with the box of their text, else of it without closing dots, else of that and one dot."""
    return texts.join(_found(texts, index), ["doc_id", "page", "seq"], "left")


def _found(texts: DataFrame, index: DataFrame) -> DataFrame:
    """(doc_id, page, seq, bbox) of the texts that `lookup` finds. Rows are dealt by a hash of the text, which is compared as well."""
    n = F.col("n")
    bare = F.regexp_replace(n, r"\.+$", "")
    tries = F.array_distinct(F.array(n, bare, F.concat(bare, F.lit("."))))
    keys = texts.select("doc_id", "page", "seq", X.norm_pdf(F.col("text")).alias("n")).select("doc_id", "page", "seq", F.posexplode(tries).alias("rank", "norm")).filter(F.length("norm") >= LEAST_KEY)
    side = index.select("doc_id", "page", F.col("norm").alias("held"), F.xxhash64("norm").alias("h"), "bbox")
    hits = keys.withColumn("h", F.xxhash64("norm")).join(side, ["doc_id", "page", "h"]).filter(F.col("norm") == F.col("held"))
    return hits.groupBy("doc_id", "page", "seq").agg(F.min_by("bbox", "rank").alias("bbox"))


def restore_boxes(blocks: DataFrame, index: DataFrame) -> DataFrame:
    """Boxes of blocks by their text, of lists and tables as the union of their parts; formulas with a box keep it."""
    part = F.when(F.col("type") == "list", F.split("content", "\n")) if "rows" not in blocks.columns else F.when(F.col("type") == "list", F.transform("items", lambda i: i["content"])).when(F.col("type") == "table", X.cell_texts(F.col("rows")))
    parts = blocks.select("doc_id", "page", F.col("seq").alias("block"), F.posexplode(F.coalesce(part, F.array("content"))).alias("k", "text")).withColumn("seq", F.struct("block", "k"))
    got = _found(parts.select("doc_id", "page", "seq", "text"), index).groupBy("doc_id", "page", F.col("seq.block").alias("seq")).agg(G.union_agg(F.col("bbox")).alias("found"))
    keep = (F.col("type") == "formula") & G.known(F.col("bbox"))
    return blocks.join(got, ["doc_id", "page", "seq"], "left").withColumn("bbox", F.when(keep, F.col("bbox")).otherwise(F.coalesce("found", "bbox"))).select(*blocks.columns)


def layout_boxes(blocks: DataFrame, layout: DataFrame, page_meta: DataFrame) -> DataFrame:
    """Unknown boxes of paragraphs, headings and lists from layout texts (doc_id, page, ord, text, bbox from the bottom left)."""
    l = layout.join(page_meta, ["doc_id", "page"]).withColumn("norm", X.norm_pdf(F.col("text"))).withColumn("box", G.from_bottom(F.col("bbox"), F.col("height")))  # noqa: E741
    each = l.groupBy("doc_id", "page", "norm", "ord").agg(G.union_agg(F.col("box")).alias("box")).groupBy("doc_id", "page", "norm").agg(F.max_by("box", "ord").alias("found"))
    b = blocks.withColumn("norm", X.norm_pdf(F.coalesce("content", F.lit("")))).join(each, ["doc_id", "page", "norm"], "left")
    fill = F.col("type").isin("paragraph", "heading", "list") & ~G.known(F.col("bbox"))
    return b.withColumn("bbox", F.when(fill, F.coalesce("found", "bbox")).otherwise(F.col("bbox"))).select(*blocks.columns)


def bind_tables(blocks: DataFrame, layout_tables: DataFrame) -> DataFrame:
    """The n-th table of a page without a box takes the n-th layout table's. layout_tables: doc_id, page, ord, bbox (from the top)."""
    w = lambda o: Window.partitionBy("doc_id", "page").orderBy(o)
    t = layout_tables.withColumn("n", F.row_number().over(w("ord"))).select("doc_id", "page", "n", F.col("bbox").alias("found"))
    open_ = blocks.filter((F.col("type") == "table") & ~G.known(F.col("bbox"))).withColumn("n", F.row_number().over(w("seq"))).join(t, ["doc_id", "page", "n"]).select("doc_id", "page", "seq", "found")
    return blocks.join(open_, ["doc_id", "page", "seq"], "left").withColumn("bbox", F.coalesce("found", "bbox")).select(*blocks.columns)


def title_levels(blocks: DataFrame, lines: DataFrame, logo: str = "") -> DataFrame:
    """Levels of page 1's headings from their font size against the page's largest; the publisher's logo is a paragraph."""
    first = lines.filter("page = 1").select("doc_id", X.norm_pdf(F.col("text")).alias("norm"), "size")
    size = first.groupBy("doc_id", "norm").agg(F.max("size").alias("size"))
    top = size.groupBy("doc_id").agg(F.max("size").alias("top"))
    heads = blocks.filter("page = 1 AND type = 'heading'").select("doc_id", "seq", X.norm_pdf(F.col("content")).alias("h"))
    j = heads.join(size, "doc_id")
    related = (F.length("h") > TITLE_LENGTH) & (F.length("norm") > TITLE_LENGTH) & (F.col("h").contains(F.col("norm")) | F.col("norm").contains(F.col("h")))
    got = j.groupBy("doc_id", "seq").agg(F.max(F.when(F.col("h") == F.col("norm"), F.col("size"))).alias("equal"), F.max(F.when(related, F.col("size"))).alias("near"))
    ratio = F.coalesce("equal", "near") / F.col("top")
    level = F.when(ratio >= TITLE_LEVELS[0][0], 1).when(ratio >= TITLE_LEVELS[1][0], 2).when(ratio.isNotNull(), 3)
    got = got.join(top, "doc_id").select("doc_id", "seq", level.alias("found"))
    out = blocks.join(got, ["doc_id", "seq"], "left").withColumn("heading_level", F.coalesce("found", "heading_level"))
    if logo:
        is_logo = (F.col("type") == "heading") & (F.col("page") == 1) & F.col("content").contains(logo)
        out = out.withColumn("__logo", is_logo).withColumn("type", F.when(F.col("__logo"), F.lit("paragraph")).otherwise(F.col("type"))).withColumn("heading_level", F.when(~F.col("__logo"), F.col("heading_level")))
    return out.select(*blocks.columns)


def name_images(images: DataFrame, readable: Column | None = None) -> DataFrame:
    """Readable images of a page with their file names, numbered without gaps."""
    good = images.filter(readable) if readable is not None else images.filter("bytes IS NOT NULL")
    w = Window.partitionBy("doc_id", "page").orderBy("ord")
    return good.withColumn("n", F.row_number().over(w)).withColumn("file", F.format_string("page_%d_%d.png", "page", "n"))


def bind_images(blocks: DataFrame, files: DataFrame) -> DataFrame:
    """The n-th image block of a page takes the n-th file; its box only if it has none."""
    w = Window.partitionBy("doc_id", "page").orderBy("seq")
    mine = blocks.filter("type = 'image'").withColumn("n", F.row_number().over(w)).join(files.select("doc_id", "page", "n", "file", F.col("bbox").alias("found")), ["doc_id", "page", "n"]).select("doc_id", "page", "seq", "file", "found")
    out = blocks.join(mine, ["doc_id", "page", "seq"], "left")
    return out.withColumn("image_key", F.coalesce("file", "image_key")).withColumn("temp_path", F.coalesce("file", "temp_path")).withColumn("bbox", F.when(G.known(F.col("bbox")), F.col("bbox")).otherwise(F.coalesce("found", "bbox"))).select(*blocks.columns)


def inject_images(blocks: DataFrame, files: DataFrame) -> DataFrame:
    """Files that no block is bound to become image blocks at the end of their document."""
    bound = blocks.filter("temp_path IS NOT NULL").select("doc_id", F.col("temp_path").alias("file"))
    left = files.join(bound, ["doc_id", "file"], "left_anti")
    offset = blocks.groupBy("doc_id").agg((F.max("seq") + 1).alias("offset"))
    w = Window.partitionBy("doc_id").orderBy("page", "n")
    new = left.join(offset, "doc_id", "left").select("doc_id", "page", (F.coalesce("offset", F.lit(0)) + F.row_number().over(w) - 1).alias("seq"), F.lit("image").alias("type"), F.lit("").alias("content"), F.col("file").alias("image_key"), F.col("file").alias("temp_path"), "bbox")
    return blocks.unionByName(new, allowMissingColumns=True)


def formula_images(candidates: DataFrame, blocks: DataFrame, page_aware: bool = False) -> DataFrame:
    """Candidates (doc_id, page, ord, bbox) that no known box of the document covers by half; with `page_aware`, of the page."""
    known = blocks.filter(G.known(F.col("bbox"))).select(F.col("doc_id").alias("d"), F.col("page").alias("p"), F.col("bbox").alias("k"))
    on = (F.col("doc_id") == F.col("d")) & (G.iou(F.col("bbox"), F.col("k")) >= SAME_PLACE)
    left = candidates.join(known, on & (F.col("page") == F.col("p")) if page_aware else on, "left_anti")
    w = Window.partitionBy("doc_id", "page").orderBy("ord")
    return left.withColumn("n", F.row_number().over(w)).withColumn("file", F.format_string("formula_p%d_%d.png", "page", "n"))


def write_images(files: DataFrame, folder: str) -> DataFrame:
    """K6: the bytes of named images (doc_id, file, bytes) as `folder`/doc_id/file; returns doc_id, file, size for each one written.

    Files are put under another name and moved, so that a task that runs twice leaves one whole file.
    """
    import uuid
    from collections.abc import Iterator

    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.fs

        for b in batches:
            for doc, name, data in zip(*(c.to_pylist() for c in b.columns), strict=True):
                fs, at = pyarrow.fs.FileSystem.from_uri(f"{folder}/{doc}")
                fs.create_dir(at, recursive=True)
                tmp = f"{at}/.{uuid.uuid4().hex}"
                with fs.open_output_stream(tmp) as out:
                    out.write(data)
                fs.move(tmp, f"{at}/{name}")
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([len(x) for x in b.column(2).to_pylist()], pa.int64())], names=["doc_id", "file", "size"])

    good = files.filter("bytes IS NOT NULL").select(F.col("doc_id").cast("string").alias("doc_id"), "file", "bytes")
    return good.mapInArrow(run, "doc_id string, file string, size long")


def new_entries(before: DataFrame, after: DataFrame, priority: int = 1) -> DataFrame:
    """Index entries of the blocks that enrichment appended, by their text."""
    new = after.join(before.select("doc_id", "seq"), ["doc_id", "seq"], "left_anti").filter(G.known(F.col("bbox"))).withColumn("norm", X.norm_pdf(F.coalesce("content", F.lit(""))))
    return new.filter(F.length("norm") >= LEAST_KEY).groupBy("doc_id", "page", "norm").agg(F.max_by("bbox", "seq").alias("bbox"), F.lit(priority).alias("priority"))


def image_candidates(images: DataFrame, sizes: DataFrame) -> DataFrame:
    """Images that may be formulas, with their page's height."""
    return images.join(sizes.select("doc_id", "page", "height"), ["doc_id", "page"]).filter(G.image_candidate(F.col("bbox"), F.col("height"))).drop("height")


def inject_formulas(blocks: DataFrame, files: DataFrame) -> DataFrame:
    """Formula images become formula blocks at the end of their document."""
    offset = blocks.groupBy("doc_id").agg((F.max("seq") + 1).alias("offset"))
    w = Window.partitionBy("doc_id").orderBy("page", "n")
    new = files.join(offset, "doc_id", "left").select("doc_id", "page", (F.coalesce("offset", F.lit(0)) + F.row_number().over(w) - 1).alias("seq"), F.lit("formula").alias("type"), F.lit("").alias("content"), F.col("file").alias("image_key"), F.col("file").alias("temp_path"), "bbox")
    return blocks.unionByName(new, allowMissingColumns=True)


def collect_undecoded(layout: DataFrame) -> DataFrame:
    """Boxes of formula items without text, by page. layout: doc_id, ord, label, text, page, bbox."""
    empty = layout.filter("label = 'formula' AND coalesce(trim(text), '') = ''")
    box = F.transform("bbox", lambda v: F.round(v, 1))
    return empty.groupBy("doc_id", "page").agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", box.alias("b")))), lambda x: x["b"]).alias("boxes"))
