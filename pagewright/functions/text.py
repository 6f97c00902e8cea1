"""Scalar text functions as Column expressions.

Patterns carry ``(?U)`` so that \\s, \\w, \\d and \\b are Unicode-aware, as block text is full of no-break spaces and Cyrillic.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Character classes and patterns that results depend on.
CYRILLIC = "а-яёА-ЯЁ"
SPACED_RUN = r"(?U)\b[А-ЯA-Zа-яa-z]\b(?: [А-ЯA-Zа-яa-z]\b){2,}"
SPACED_RUN_STRICT = r"(?U)(?<=\b[а-яёa-zА-ЯЁA-Z])(?: [а-яёa-zА-ЯЁA-Z]){2,}(?![а-яёa-zА-ЯЁA-Z])"
PRIVATE_USE = r"[\x{f000}-\x{f8ff}]"
ALLOWED = r"""[a-zA-Zа-яёА-ЯЁ0-9\s.,!?:;()\-«»"“”'–—/\\№%@&*#+<=>]"""
CLAUSE_MARK = r"(?U)^\d{1,2}\.\d{1,2}(?:\.\d{1,2})+\s"
SUB_MARK = r"(?U)^\.\d{1,3}(?:\.\d{1,3})?(\s|$)"
MATH_FONTS = ("math", "symbol", "mt extra", "mathematical", "pi", "greek", "monotype")
FORMULA_HINT = "[=×÷±·≤≥≈≠∑∫√∞∂∆^_αβγδεζηθικλμνξπρστυφχψωΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ]"
CYRILLIC_TOKEN = r"(?U)(?:^|\s)([а-яёА-ЯЁ]+)(?=\s|$|[,.;:])"
WORD_SPLIT = r"(?U)[\s,;:.()«»\-]+"
PLAIN_NAMES = ("image", "pdf", "doc", "txt")


def strip(c: Column) -> Column:
    """Without white space at either end, Unicode-aware."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def rstrip(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)\s+$", "")


def collapse(c: Column) -> Column:
    """Runs of white space as one space, none at the ends."""
    return strip(F.regexp_replace(c, r"(?U)\s+", " "))


def count_of(c: Column, pattern: str) -> Column:
    """Characters that a one-character class matches."""
    return F.length(c) - F.length(F.regexp_replace(c, pattern, ""))


def _join_runs(c: Column, pattern: str) -> Column:
    runs = F.regexp_extract_all(c, F.lit(pattern), F.lit(0))
    return F.aggregate(F.array_distinct(runs), c, lambda acc, m: F.replace(acc, m, F.replace(m, F.lit(" "), F.lit(""))))


def remove_spaced_letters(c: Column) -> Column:
    """three or more single letters with one space between are joined."""
    return _join_runs(c, SPACED_RUN)


def soft_clean(c: Column) -> Column:
    """no control or format characters (but tab, line feed, return), no slash-number runs, white space collapsed."""
    t = F.regexp_replace(c, r"[\p{C}&&[^\t\n\r]]", "")
    return collapse(F.regexp_replace(t, r"(?U)/\d+(?:/\d+)*", ""))


def is_garbage(c: Column, min_cyrillic: float = 0.6, min_allowed: float = 0.4) -> Column:
    """whether a cleaned line is noise; the first rule that applies decides."""
    return bound(strip(c), lambda s: _noise(s, min_cyrillic, min_allowed))


def bound(c: Column, f: Callable[[Column], Column]) -> Column:
    """f of c, with c computed once: where f names it in several branches, it would be computed in each."""
    return F.transform(F.array(c), f)[0]


def _noise(s: Column, min_cyrillic: float, min_allowed: float) -> Column:
    words = F.filter(F.split(s, r"(?U)\s+"), lambda w: w != "")
    n = F.size(words)
    mean = F.aggregate(words, F.lit(0), lambda a, w: a + F.length(w)) / n
    solid = F.length(F.replace(s, F.lit(" "), F.lit("")))
    letters = count_of(s, "[A-Za-zА-Яа-яЁё]")
    cyrillic = count_of(s, "[А-яёЁ]")
    return (
        F.when(s == "", True)
        .when(F.lower(s).isin(*PLAIN_NAMES), False)
        .when(s.rlike(r"(?U)^[A-Z\s]+$"), True)
        .when((n >= 3) & (mean < 1.8), True)
        .when((solid > 0) & (count_of(s, "(?U)" + ALLOWED) / solid < min_allowed), True)
        .when(letters == 0, True)
        .when(cyrillic / letters >= min_cyrillic, False)
        .when((cyrillic == 0) & ~s.rlike(r"(?U)\d") & (F.length(s) < 20), True)
        .otherwise(False)
    )


def clean_text(c: Column) -> Column:
    """every line cleaned, noise left out."""
    lines = F.transform(F.split(c, "\n"), soft_clean)
    return F.array_join(F.filter(lines, lambda x: ~is_garbage(x)), "\n")


def _punctuation(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, "[—–]", "-"), r"(?U)\s+([,.;:])", "$1")


def _tighten(c: Column) -> Column:
    t = F.regexp_replace(F.regexp_replace(c, r"(?U)\(\s+", "("), r"(?U)\s+\)", ")")
    t = F.regexp_replace(t, r"(?U)(?<=[а-яёa-z0-9])\s+(?=[0-9])", "")
    return F.lower(strip(t))


def norm_pdf(c: Column) -> Column:
    """the key under which lines of the PDF and of blocks meet."""
    t = F.regexp_replace(F.regexp_replace(c, r"(?U)[\s\x{a0}]+", " "), PRIVATE_USE, "")
    return _tighten(_punctuation(t))


def map_symbols(c: Column) -> Column:
    """two private-use characters become the middle dot and the capital delta."""
    return F.translate(c, "", "·Δ")


def norm_compare(c: Column) -> Column:
    """the text that golden and result blocks are compared by."""
    t = F.regexp_replace(map_symbols(F.coalesce(c, F.lit(""))), PRIVATE_USE, "")
    t = _punctuation(F.regexp_replace(t, r"(?U)[\s\x{a0}]+", " "))
    return _tighten(_join_runs(t, SPACED_RUN_STRICT))


def norm_verify_words(c: Column) -> Column:
    """signs become spaces, single spaces between word characters go."""
    t = collapse(F.regexp_replace(c, r"(?U)[^\w\s]", " "))
    return F.lower(F.regexp_replace(t, r"(?U)(?<=\w) (?=\w)", ""))


def norm_verify_flat(c: Column) -> Column:
    """F8: lower-case letters and digits alone."""
    return F.regexp_replace(F.lower(c), "[^а-яёa-z0-9]", "")


def norm_draft(c: Column) -> Column:
    """white space collapsed, none between word characters."""
    return F.lower(F.regexp_replace(collapse(c), r"(?U)(?<=\w) (?=\w)", ""))


def strip_html(c: Column, references: dict[str, str] | None = None) -> Column:
    """a page's visible text. All character references are decoded, Arrow-batched, as there is no built-in for that; with
    `references` these alone, one after the other."""
    t = F.regexp_replace(c, r"(?is)<(script|style)[^>]*>.*?</\1>", " ")
    t = F.regexp_replace(t, r"<[^>]+>", " ")
    if references is None:
        return collapse(unescape_html(t))
    for name, char in references.items():
        t = F.replace(t, F.lit(name), F.lit(char))
    return collapse(t)


@F.pandas_udf(T.StringType())
def unescape_html(text: pd.Series) -> pd.Series:
    from html import unescape

    return text.map(unescape, na_action="ignore")


def escape_html(c: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def is_math_font(font: Column) -> Column:
    """F13."""
    return F.lower(F.coalesce(font, F.lit(""))).rlike("|".join(MATH_FONTS))


def detect_tables(c: Column) -> Column:
    """two lines at least that look like table rows."""
    lines = F.split(c, "\n")
    return (F.size(lines) >= 2) & (F.size(F.filter(lines, lambda x: x.rlike(r"[|\t]{2,}| {2,}"))) >= 2)


def detect_formulas(c: Column) -> Column:
    """F16."""
    patterns = (r"\$[^$]+\$", r"\\[a-zA-Z]+", r"[=+\-*/^]", r"[0-9]+ *[xX*] *[0-9]+")
    return reduce(lambda a, b: a | b, [c.rlike(p) for p in patterns])


def words_of(c: Column) -> Column:
    """words of two characters or more, in order."""
    return F.filter(F.split(c, WORD_SPLIT), lambda w: F.length(w) >= 2)


def flat(c: Column) -> Column:
    """without white space."""
    return F.regexp_replace(c, r"(?U)\s+", "")


def core(c: Column) -> Column:
    """a flat formula without closing signs, with the plain minus."""
    return F.replace(F.regexp_replace(c, r"[),;:.]+$", ""), F.lit("−"), F.lit("-"))


def is_formula_tail(c: Column) -> Column:
    """a short condition that continues a formula."""
    t = strip(c)
    return (t != "") & (F.length(t) < 70) & t.rlike(r"^\p{Ll}") & F.element_at(F.split(t, r"(?U)\s+"), 1).isin("для", "при", "если")


def cell_texts(rows: Column) -> Column:
    """All texts of a table's cells, in order."""
    cells = F.flatten(F.transform(rows, lambda r: r["cells"]))
    return F.flatten(F.transform(cells, lambda c: F.transform(c["block"], lambda b: b["content"])))


def _some(a: Column) -> Column:
    return F.filter(a, lambda x: x.isNotNull() & (x != ""))


def block_text(kind: Column, content: Column, items: Column, columns: Column, rows: Column) -> Column:
    """a block's text for comparison."""
    empty = F.array().cast("array<string>")
    table = F.array_join(F.concat(_some(F.coalesce(columns, empty)), _some(F.coalesce(cell_texts(rows), empty))), " | ")
    listed = F.array_join(F.transform(F.coalesce(items, F.array().cast("array<struct<content:string,bbox:array<double>>>")), lambda i: F.coalesce(i["content"], F.lit(""))), " ")
    return F.when(kind == "table", table).when(kind == "list", listed).otherwise(F.coalesce(content, F.lit("")))


def page_block_text(kind: Column, content: Column, columns: Column, rows: Column) -> Column:
    """A block's text for the search of PDF lines: its content if there is any, and a table's cells and then column names."""
    empty = F.array().cast("array<string>")
    own = F.when(strip(F.coalesce(content, F.lit(""))) != "", F.array(content)).otherwise(empty)
    table = F.when(kind == "table", F.concat(_some(F.coalesce(cell_texts(rows), empty)), _some(F.coalesce(columns, empty)))).otherwise(empty)
    return F.array_join(F.concat(own, table), " ")


def verify_text(kind: Column, content: Column, items: Column, columns: Column, rows: Column) -> Column:
    """a block's text for the draft's verification: a list's items by line, a table's column names and cells by space."""
    empty = F.array().cast("array<string>")
    listed = F.array_join(F.transform(items, lambda i: F.coalesce(i["content"], F.lit(""))), "\n")
    table = F.array_join(F.concat(F.coalesce(columns, empty), F.coalesce(cell_texts(rows), empty)), " ")
    return F.when(kind == "table", table).when((kind == "list") & items.isNotNull(), listed).otherwise(F.coalesce(content, F.lit("")))


def norm_key(kind: Column, content: Column, items: Column | None = None, columns: Column | None = None, rows: Column | None = None) -> Column:
    """the text that duplicates are found by."""
    text = F.coalesce(content, F.lit(""))
    if items is not None:
        empty = F.array().cast("array<string>")
        listed = F.array_join(F.transform(items, lambda i: F.coalesce(i["content"], F.lit(""))), " ")
        table = F.array_join(F.concat(F.coalesce(cell_texts(rows), empty), _some(F.coalesce(columns, empty))), " ")
        text = F.when(kind == "list", F.coalesce(listed, F.lit(""))).when(kind == "table", table).otherwise(text)
    return F.lower(collapse(text))


def fingerprint(kind: Column, level: Column, image_key: Column, latex_or_content: Column, n_columns: Column, n_rows: Column, n_items: Column) -> Column:
    """what must agree in structure between matched blocks, as text; null where nothing must."""
    has = lambda c: F.when(F.coalesce(c, F.lit("")) != "", "true").otherwise("false")
    return (
        F.when(kind == "table", F.concat_ws(",", n_columns.cast("string"), n_rows.cast("string")))
        .when(kind == "list", n_items.cast("string"))
        .when(kind == "heading", level.cast("string"))
        .when(kind == "image", F.coalesce(image_key, F.lit("")))
        .when(kind == "formula", F.concat_ws(",", has(strip(F.coalesce(latex_or_content, F.lit("")))), has(image_key)))
    )
