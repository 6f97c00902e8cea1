"""Rules on layout blocks, B1-B16. Each takes and returns a block table; the order of `layout_rules` is the order of application."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagewright.config import Settings
from pagewright.functions import text as X

# Patterns of the rules.
CAPITAL = "[А-ЯA-Z«(]"
HEADING_LIKE = r"(?U)^\d{1,2}(?:\.\d{1,2})?\s+[А-ЯA-Z][А-ЯA-Z\s\-—]*$"
FRAGMENT_START = r"(?U)^(=|\d{1,2}\s*[+\-−)]|1/2|−|[)\]])"
SENTENCE_END = r"(?U)[.!?;:]\s*$"
ITEM_END = r"(?U)[.;:]\s*$"
WHERE = r"(?U),\s+где\b"
ZERO_IF = r"(?U)(?<=\.)\s+(?==\s*0,\s*если\b)"
FORMULA_SIGNS = r"[\x{370}-\x{3FF}\x{2200}-\x{22FF}\x{2100}-\x{214F}\x{1D400}-\x{1D7FF}$]|\\\(|\\\["


def document() -> "Window":
    """Blocks of a document in order."""
    return Window.partitionBy("doc_id").orderBy("seq")



def renumber(blocks: DataFrame, *order: str) -> DataFrame:
    """seq as 0, 1, ... in each document, in order of seq and the given columns, which go."""
    w = Window.partitionBy("doc_id").orderBy("seq", *order)
    return blocks.withColumn("__n", (F.row_number().over(w) - 1).cast("long")).drop(*order).withColumn("seq", F.col("__n")).drop("__n")


def _put(blocks: DataFrame, **values: Column) -> DataFrame:
    """Replace those of the columns that the table has."""
    return blocks.withColumns({k: v for k, v in values.items() if k in blocks.columns})


def join_spaced_letters(blocks: DataFrame) -> DataFrame:
    """B1: letter-spaced words are joined in paragraphs, headings, list items and cells."""
    out = blocks.withColumn("content", F.when(F.col("type").isin("paragraph", "heading"), X.remove_spaced_letters(F.coalesce("content", F.lit("")))).otherwise(F.col("content")))
    if "items" in blocks.columns:
        out = out.withColumn("items", F.when(F.col("type") == "list", F.transform("items", lambda i: i.withField("content", X.remove_spaced_letters(F.coalesce(i["content"], F.lit("")))))).otherwise(F.col("items")))
    if "rows" in blocks.columns:
        cell = lambda c: c.withField("block", F.transform(c["block"], lambda b: b.withField("content", X.remove_spaced_letters(b["content"]))))
        out = out.withColumn("rows", F.transform("rows", lambda r: r.withField("cells", F.transform(r["cells"], cell))))
    return out


def _exploded(blocks: DataFrame, pieces: Column) -> DataFrame:
    return blocks.select("*", F.posexplode(pieces).alias("__at", "__piece"))


def split_merged(blocks: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """B2: paragraphs are cut before clause marks; pieces like headings become headings without a box."""
    cut = rf"(?U)(?<=\.)\s+(?={settings.stop_mark}\s+{CAPITAL})|\s+(?={settings.clause_mark}\s+{CAPITAL})|(?<=\.)\s+(?={settings.split_phrase})"
    parts = F.split("content", cut, -1)
    pieces = F.when((F.col("type") == "paragraph") & (F.size(parts) > 1), F.filter(F.transform(parts, X.strip), lambda p: p != "")).otherwise(F.array("content"))
    split = (F.col("type") == "paragraph") & (F.size(parts) > 1)
    heading = F.col("__split") & F.col("__piece").rlike(HEADING_LIKE)
    out = _exploded(blocks.withColumn("__split", F.coalesce(split, F.lit(False))), pieces)
    out = _put(out, heading_level=F.when(heading, F.lit(2)).otherwise(F.col("heading_level") if "heading_level" in blocks.columns else None), bbox=F.when(~heading, F.col("bbox")) if "bbox" in blocks.columns else F.lit(None))
    out = out.withColumn("type", F.when(heading, F.lit("heading")).otherwise(F.col("type"))).withColumn("content", F.col("__piece")).drop("__piece", "__split")
    return renumber(out, "__at")


def _cut_list(blocks: DataFrame, cuts: Column) -> DataFrame:
    """Lists cut before the items of these numbers (from 0, ascending); other blocks and lists without cuts stay whole."""
    n = F.size("items")
    edges = F.concat(F.array(F.lit(0)), cuts, F.array(n))
    starts = F.when((F.col("type") == "list") & (F.size(cuts) > 0), F.transform(F.sequence(F.lit(0), F.size(cuts)), lambda k: F.struct(edges[k].alias("a"), edges[k + 1].alias("b"))))
    whole = F.array(F.struct(F.lit(-1).alias("a"), F.lit(-1).alias("b")))
    out = blocks.select("*", F.posexplode(F.coalesce(starts, whole)).alias("__at", "__span"))
    piece = F.slice("items", F.col("__span.a") + 1, F.col("__span.b") - F.col("__span.a"))
    split = F.col("__span.a") >= 0
    out = out.withColumn("items", F.when(split, piece).otherwise(F.col("items")))
    out = out.withColumn("content", F.when(split, F.array_join(F.transform("items", lambda i: F.coalesce(i["content"], F.lit(""))), "\n")).otherwise(F.col("content")))
    return renumber(out.drop("__span"), "__at")


def _numbers(n: Column) -> Column:
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def _item(i: Column) -> Column:
    return F.coalesce(F.get(F.col("items"), i)["content"], F.lit(""))


def split_lists(blocks: DataFrame) -> DataFrame:
    """Lists are cut at both members of every pair of clause-marked neighbours, if a sub-marked item comes before a pair."""
    n = F.size("items")
    full = lambda i: (i >= 0) & (i < n) & _item(i).rlike(X.CLAUSE_MARK)
    pair = lambda i: full(i) & full(i + 1)
    cuts = F.filter(_numbers(n), lambda i: pair(i) | pair(i - 1))
    last_pair = F.array_max(F.filter(_numbers(n), pair))
    led = F.exists(F.filter(_numbers(n), lambda k: k < last_pair), lambda k: _item(k).rlike(X.SUB_MARK))
    return _cut_list(blocks, F.when((n >= 3) & F.coalesce(led, F.lit(False)), cuts).otherwise(F.array().cast("array<int>")))


def split_list_before_mark(blocks: DataFrame) -> DataFrame:
    """Lists are cut before a clause-marked item that follows a finished item without a mark."""
    n = F.size("items")
    before = lambda i: _item(i - 1)
    cuts = F.filter(_numbers(n), lambda i: (i > 0) & _item(i).rlike(X.CLAUSE_MARK) & ~before(i).rlike(X.CLAUSE_MARK) & ~before(i).rlike(X.SUB_MARK) & before(i).rlike(ITEM_END))
    return _cut_list(blocks, F.coalesce(cuts, F.array().cast("array<int>")))


def split_formula_where(blocks: DataFrame) -> DataFrame:
    """B5: "formula, где explanation" becomes a formula and a paragraph."""
    t = X.strip(F.coalesce("content", F.lit("")))
    parts = F.split(t, WHERE, 2)
    split = F.coalesce((F.col("type") == "paragraph") & (F.size(parts) == 2) & parts[0].contains("="), F.lit(False))
    right = X.strip(F.get(parts, F.lit(1)))
    pieces = F.when(split, F.filter(F.array(X.strip(parts[0]), F.when(right != "", F.concat(F.lit("где "), right))), lambda p: p.isNotNull())).otherwise(F.array("content"))
    out = _exploded(blocks.withColumn("__split", split), pieces)
    formula = F.col("__split") & (F.col("__at") == 0)
    out = out.withColumn("type", F.when(formula, F.lit("formula")).otherwise(F.col("type"))).withColumn("is_where", formula).withColumn("content", F.col("__piece"))
    return renumber(out.drop("__piece", "__split"), "__at")


def merge_fragments(blocks: DataFrame) -> DataFrame:
    """A fragment continues the block before it on the page. Whether it does depends on the previous row alone, so that chains are islands."""
    t = X.strip(F.coalesce("content", F.lit("")))
    kinds = ("paragraph", "formula", "list")
    before = F.lag(F.struct("type", "page", X.rstrip(F.coalesce("content", F.lit(""))).alias("text"))).over(document())
    link = F.col("type").isin(*kinds) & before["type"].isin(*kinds) & (before["page"] == F.col("page")) & ~before["text"].rlike(SENTENCE_END) & t.rlike(FRAGMENT_START) & (t != "")
    tagged = blocks.withColumn("__text", t).withColumn("__new", F.when(F.coalesce(link, F.lit(False)), 0).otherwise(1)).withColumn("__island", F.sum("__new").over(document()))
    text = F.transform(F.array_sort(F.collect_list(F.struct("seq", "__text", "content"))), lambda x: x)
    joined = tagged.groupBy("doc_id", "__island").agg(text.alias("__all"))
    head = tagged.filter("__new = 1").drop("__text", "__new")
    more = F.transform(F.slice("__all", 2, F.greatest(F.size("__all") - 1, F.lit(1))), lambda x: x["__text"])
    merged = F.concat_ws(" ", F.array(X.rstrip(F.coalesce("content", F.lit("")))), more)
    out = head.join(joined, ["doc_id", "__island"])
    return out.withColumn("content", F.when(F.size("__all") > 1, merged).otherwise(F.col("content"))).select(*blocks.columns)


def split_zero_if(blocks: DataFrame) -> DataFrame:
    """B7: "... . = 0, если ..." is cut before the sign, once."""
    parts = F.split("content", ZERO_IF, 2)
    split = (F.col("type") == "paragraph") & (F.size(parts) == 2)
    pieces = F.when(split, F.filter(F.transform(parts, X.strip), lambda p: p != "")).otherwise(F.array("content"))
    out = _exploded(blocks, pieces)
    return renumber(out.withColumn("content", F.col("__piece")).drop("__piece"), "__at")


def trim_heading_suffix(blocks: DataFrame) -> DataFrame:
    """A closing " 1" leaves headings in capitals."""
    c = F.col("content")
    return blocks.withColumn("content", F.when((F.col("type") == "heading") & (c != "") & (F.upper(c) == c), X.strip(F.regexp_replace(c, r"(?U)\s+1$", ""))).otherwise(c))


def _key(blocks: DataFrame) -> Column:
    extra = [F.col(x) for x in ("items", "columns", "rows")] if "rows" in blocks.columns else []
    return X.norm_key(F.col("type"), F.col("content"), *extra)


def dedup_keep_last(blocks: DataFrame) -> DataFrame:
    """Of blocks equal in type, page and text the last one stays; blank ones all stay."""
    w = Window.partitionBy("doc_id", "page", "type", "__key").orderBy(F.col("seq").desc())
    out = blocks.withColumn("__key", _key(blocks)).withColumn("__n", F.row_number().over(w))
    return out.filter("__n = 1 OR __key = ''").drop("__key", "__n")


def map_private_use(blocks: DataFrame) -> DataFrame:
    """Two private-use characters in contents, LaTeX and cells."""
    out = blocks.withColumn("content", X.map_symbols(F.col("content")))
    if "latex" in blocks.columns:
        out = out.withColumn("latex", X.map_symbols(F.col("latex")))
    if "rows" in blocks.columns:
        cell = lambda c: c.withField("block", F.transform(c["block"], lambda b: b.withField("content", X.map_symbols(b["content"]))))
        out = out.withColumn("rows", F.transform("rows", lambda r: r.withField("cells", F.transform(r["cells"], cell))))
    return out


def retype_formula(blocks: DataFrame) -> DataFrame:
    """Paragraphs with mathematical signs become formulas."""
    c = F.coalesce("content", F.lit(""))
    return blocks.withColumn("type", F.when((F.col("type") == "paragraph") & c.rlike(FORMULA_SIGNS), F.lit("formula")).otherwise(F.col("type")))


def demote_formula(blocks: DataFrame) -> DataFrame:
    """Formulas that read like Cyrillic prose become paragraphs again, but those cut off by B5."""
    t = X.strip(F.coalesce("content", F.lit("")))
    prose = t.rlike("^[а-яёА-ЯЁ«]") | (F.size(F.regexp_extract_all(t, F.lit(X.CYRILLIC_TOKEN), F.lit(1))) >= 4) | t.contains("если")
    where = F.coalesce(F.col("is_where"), F.lit(False)) if "is_where" in blocks.columns else F.lit(False)
    out = blocks.withColumn("type", F.when((F.col("type") == "formula") & ~where & prose, F.lit("paragraph")).otherwise(F.col("type")))
    return out.drop("is_where") if "is_where" in blocks.columns else out


def drop_numeric(blocks: DataFrame) -> DataFrame:
    """Blocks of digits, dashes and slashes alone go."""
    return blocks.filter(~F.coalesce(F.col("content").rlike(r"(?U)^[\d\s\-—/]+$"), F.lit(False)))


def document_summary(blocks: DataFrame) -> DataFrame:
    """A row for each document, with the defaults that later steps replace."""
    return blocks.groupBy("doc_id").agg(F.count("*").alias("n_blocks"), F.countDistinct("page").alias("n_pages"), F.bool_or(F.col("type") == "table").alias("has_tables")).withColumns({"confidence": F.lit(0.75), "status": F.lit("completed")})


def caption_images(blocks: DataFrame) -> DataFrame:
    """B15, off by default: a short paragraph with рис or fig after an image becomes its content."""
    after = F.lead(F.struct("type", "page", "content")).over(document())
    is_caption = lambda kind, page, text: (kind == "paragraph") & (page == F.col("page")) & (F.length(text) < 100) & F.lower(text).rlike("рис|fig")
    out = blocks.withColumn("__after", after)
    takes = (F.col("type") == "image") & F.coalesce(is_caption(F.col("__after.type"), F.col("__after.page"), F.col("__after.content")), F.lit(False))
    out = out.withColumn("__takes", takes).withColumn("__gone", F.coalesce(F.lag("__takes").over(document()), F.lit(False)))
    return out.withColumn("content", F.when(F.col("__takes"), F.col("__after.content")).otherwise(F.col("content"))).filter(~F.col("__gone")).drop("__after", "__takes", "__gone")


def merge_adjacent_lists(blocks: DataFrame) -> DataFrame:
    """B16, off by default: a list that begins with a mark continues a finished list before it on the page."""
    first = F.element_at(F.split("content", "\n"), 1)
    before = F.lag(F.struct("type", "page", "content")).over(document())
    link = (F.col("type") == "list") & (before["type"] == "list") & (before["page"] == F.col("page")) & X.rstrip(before["content"]).rlike(ITEM_END) & (first.rlike(X.CLAUSE_MARK) | first.rlike(X.SUB_MARK))
    tagged = blocks.withColumn("__new", F.when(F.coalesce(link, F.lit(False)), 0).otherwise(1)).withColumn("__island", F.sum("__new").over(document()))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "content"))), lambda x: x["content"]), "\n")
    joined = tagged.groupBy("doc_id", "__island").agg(text.alias("__text"))
    return tagged.filter("__new = 1").join(joined, ["doc_id", "__island"]).withColumn("content", F.col("__text")).select(*blocks.columns)


#: The order of application.
LAYOUT_RULES: tuple[Callable[[DataFrame], DataFrame], ...] = (
    join_spaced_letters, split_merged, split_lists, split_list_before_mark, split_formula_where, merge_fragments, split_zero_if,
    trim_heading_suffix, dedup_keep_last, map_private_use, retype_formula, demote_formula, drop_numeric,
)


def layout_rules(blocks: DataFrame) -> DataFrame:
    for rule in LAYOUT_RULES:
        blocks = rule(blocks)
    return blocks
