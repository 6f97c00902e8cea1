"""Parts that the other catalogues don't reach, over inputs made from the words of all lines: page HTML of every element, PDF spans,
caption lines, index overlays, formula chains, tables as HTML."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from pagewright.functions import text as X
from pagewright.operators import cleanup as C
from pagewright.operators import compare as M
from pagewright.operators import enrich as E
from pagewright.operators import golden as D
from pagewright.operators import render as V
from pagewright.operators import rewrite as R
from pagewright.plans.compare_queries import _ESC
from pagewright.plans.inputs import BOXES_SQL, LINES_SQL, boxes, lines
from pagewright.plans.registry import registry
from pagewright.sources import html as H

QUERIES, SQL, query = registry()

# The first word of a line, letters and digits alone; "x" if there is none.
_WORD_SQL = "coalesce(nullif(regexp_extract(content, '[A-Za-z0-9]+'), ''), 'x')"
_WORDS_SQL = f"{LINES_SQL}, w AS (SELECT doc_id, page, seq, {_WORD_SQL} AS w FROM lines)"


def _words(spark, sf_dir):
    d = lines(spark, sf_dir)
    return d.select("doc_id", "page", "seq", F.coalesce(F.nullif(F.regexp_extract("content", "[A-Za-z0-9]+", 0), F.lit("")), F.lit("x")).alias("w"))


@query(f"""WITH {_WORDS_SQL}, b AS (
  SELECT doc_id, seq, 0 AS pos, 'heading' AS kind, w AS text, NULL AS items, NULL AS cells, NULL::BOOLEAN AS has_header, NULL AS header_rows FROM w UNION ALL
  SELECT doc_id, seq, 1, 'table', NULL, NULL, 'h|' || w || '/1|2 ' || w || '/t|d', true, '0' FROM w UNION ALL
  SELECT doc_id, seq, 2, 'formula', w || ' = 1', NULL, NULL, NULL, NULL FROM w UNION ALL
  SELECT doc_id, seq, 3, 'formula', 'by ' || w, NULL, NULL, NULL, NULL FROM w UNION ALL
  SELECT doc_id, seq, 4, 'image', '', NULL, NULL, NULL, NULL FROM w UNION ALL
  SELECT doc_id, seq, 5, 'paragraph', 'caption ' || w, NULL, NULL, NULL, NULL FROM w UNION ALL
  SELECT doc_id, seq, 6, 'image', '', NULL, NULL, NULL, NULL FROM w UNION ALL
  SELECT doc_id, seq, 7, 'paragraph', 'II — ' || w, NULL, NULL, NULL, NULL FROM w UNION ALL
  SELECT doc_id, seq, 8, 'paragraph', 'IV - end', NULL, NULL, NULL, NULL FROM w UNION ALL
  SELECT doc_id, seq, 9, 'list', NULL, ' ' || w || ' ;b', NULL, NULL, NULL FROM w UNION ALL
  SELECT doc_id, seq, 10, 'formula', '', NULL, NULL, NULL, NULL FROM w UNION ALL
  SELECT doc_id, seq, 11, 'paragraph', 'kept ' || w, NULL, NULL, NULL, NULL FROM w)
SELECT doc_id || '-' || seq AS doc_id, pos, kind, text, items, cells, has_header, header_rows FROM b""")
def html_elements(spark, sf_dir):
    """Every element of page HTML; what is outside of the page, unclosed, blank or without rows is no block."""
    w = F.col("w")
    parts = [
        "<p>outside</p><div class='page'><h2> ", w, " </h2>loose<table></table><table><tr><th>h</th><th>", w, "</th></tr><tr></tr><tr><td>1</td><td> 2 ", w, "</td></tr><tr><th>t</th><td>d</td></tr></table>",
        "<figure class='formula'>", w, " = 1<figcaption>unused</figcaption></figure><figure class='formula'><figcaption>by ", w, "</figcaption></figure><figure><figcaption> caption ", w, "</figcaption></figure><figure></figure>",
        "<ul><li>II — ", w, "</li><li> </li><li>IV - end</li></ul><ol><li> ", w, " </li><li>b</li></ol><ul></ul><div class=\"formula-not-decoded\"><p>", w, "</p></div><p> </p><div><p>kept ", w, "</p></div><p>lost ", w, "</h3></p><p>open</div><p>after</p>",
    ]
    d = _words(spark, sf_dir).select(F.concat("doc_id", F.lit("-"), "seq").alias("doc_id"), "page", F.concat(*[p if not isinstance(p, str) else F.lit(p) for p in parts]).alias("html"))
    b = H.raw_blocks(d)
    cells = F.array_join(F.transform("rows", lambda r: F.array_join(r, "|")), "/")
    return b.select("doc_id", "pos", "kind", "text", F.array_join("items", ";").alias("items"), cells.alias("cells"), "has_header", F.array_join(F.transform("header_rows", lambda x: x.cast("string")), ",").alias("header_rows"))


def _spans(spark, sf_dir):
    """A span for each word; every third one in a mathematical font."""
    d = boxes(spark, sf_dir).select("doc_id", "page", F.floor(F.col("seq") / 5).cast("int").alias("block_no"), (F.col("seq") % 5).cast("int").alias("line_no"), "bbox", F.posexplode(F.split("content", " ")).alias("span_no", "word"))
    b = F.col("bbox")
    font = F.when(F.col("span_no") % 3 == 0, F.lit("Cambria Math")).otherwise(F.lit("Arial"))
    return d.select("doc_id", "page", "block_no", "line_no", "span_no", F.concat("word", F.lit(" ")).alias("text"), font.alias("font"), (10.0 + F.col("span_no") % 4).alias("size"), b[0].alias("line_x0"), b[1].alias("line_y0"), b[2].alias("line_x1"), b[3].alias("line_y1"))


_SPANS_SQL = BOXES_SQL + """, s AS (SELECT doc_id, page, (seq // 5)::INT AS block_no, (seq % 5)::INT AS line_no, x0, y0, x1, y1, unnest(string_split(content, ' ')) || ' ' AS text, generate_subscripts(string_split(content, ' '), 1) - 1 AS span_no FROM boxes)"""


@query(f"""WITH {_SPANS_SQL}, l AS (SELECT doc_id, page, block_no, line_no, trim(string_agg(text, '' ORDER BY span_no)) AS text, max(10.0 + span_no % 4)::DOUBLE AS size, sum(CASE WHEN span_no % 3 = 0 THEN length(text) ELSE 0 END) / sum(length(text)) AS share, min(x0) AS x0, max(y1) AS y1 FROM s GROUP BY ALL)
SELECT doc_id, page, block_no, line_no, md5(text) AS text, size, round(share, 6) AS math_share, x0, y1 FROM l WHERE text <> ''""")
def span_lines(spark, sf_dir):
    d = E.span_lines(_spans(spark, sf_dir))
    return d.select("doc_id", "page", "block_no", "line_no", F.md5("text").alias("text"), "size", F.round("math_share", 6).alias("math_share"), F.col("bbox")[0].alias("x0"), F.col("bbox")[3].alias("y1"))


@query(f"""WITH {_SPANS_SQL} SELECT doc_id, block_no, line_no, md5(string_agg(text, '' ORDER BY span_no)) AS text, min(y0) AS y0, CASE WHEN count(*) > 1 THEN 'Arial,Cambria Math' ELSE 'Cambria Math' END AS fonts, array_to_string(list_sort(list_distinct(list((10.0 + span_no % 4)::INT))), ',') AS sizes
FROM s WHERE page = 2 AND y0 >= 100 AND y1 <= 250 GROUP BY doc_id, block_no, line_no""")
def line_fonts(spark, sf_dir):
    d = D.line_fonts(_spans(spark, sf_dir), 2, 100.0, 250.0)
    return d.select("doc_id", "block_no", "line_no", F.md5("text").alias("text"), "y0", F.array_join("fonts", ",").alias("fonts"), F.array_join(F.transform("sizes", lambda x: x.cast("int").cast("string")), ",").alias("sizes"))


@query(f"""WITH {_WORDS_SQL} SELECT doc_id, seq, 0 AS part, 'caption' AS kind, 'Таблица 2.' || (seq % 30) AS text FROM w WHERE seq % 2 = 0 UNION ALL
SELECT doc_id, seq, 1, 'text', w FROM w WHERE seq % 4 = 0 UNION ALL SELECT doc_id, seq, 0, 'formula', 'Таблицы ' || w FROM w WHERE seq % 2 = 1""")
def split_captions(spark, sf_dir):
    s = F.col("seq")
    text = F.when(s % 4 == 0, F.concat(F.lit("Таблица 2."), (s % 30).cast("string"), F.lit("  "), "w")).when(s % 2 == 0, F.concat(F.lit("Таблица 2."), (s % 30).cast("string"), F.lit(" "))).otherwise(F.concat(F.lit("Таблицы "), "w"))
    return E.split_captions(_words(spark, sf_dir).select("doc_id", "seq", F.lit("formula").alias("kind"), text.alias("text"))).select("doc_id", "seq", "part", "kind", "text")


@query(f"""WITH {_WORDS_SQL}, k AS (SELECT doc_id, page, 'key ' || lower(w) AS norm, max(seq) AS last, max(CASE WHEN seq % 3 = 0 THEN seq END) AS new FROM w GROUP BY ALL)
SELECT doc_id, page, norm, CASE WHEN new IS NULL THEN last ELSE 1000 + new END::DOUBLE AS x0 FROM k""")
def index_overlay(spark, sf_dir):
    d = _words(spark, sf_dir).select("doc_id", "page", F.lower(F.concat(F.lit("key "), "w")).alias("norm"), "seq")
    entry = lambda x, shift, priority: x.groupBy("doc_id", "page", "norm").agg(F.max("seq").alias("m")).select("doc_id", "page", "norm", F.array((F.col("m") + shift).cast("double"), F.lit(0.0), F.lit(0.0), F.lit(1.0)).alias("bbox"), F.lit(priority).alias("priority"))
    return E.overlay(entry(d, 0, 0), entry(d.filter("seq % 3 = 0"), 1000, 1)).select("doc_id", "page", "norm", F.col("bbox")[0].alias("x0"))


@query(f"""WITH {_WORDS_SQL}, d AS (SELECT doc_id, page, seq, CASE WHEN seq % 11 = 10 THEN 'paragraph' ELSE 'formula' END AS type, CASE seq % 4 WHEN 0 THEN w || ' =' WHEN 3 THEN '(' || w || ').' ELSE '+ ' || w END AS content FROM w),
l AS (SELECT *, lag(type) OVER p AS t0, lag(content) OVER p AS c0 FROM d WINDOW p AS (PARTITION BY doc_id, page ORDER BY seq)),
g AS (SELECT *, sum(CASE WHEN type = 'formula' AND t0 = 'formula' AND NOT regexp_matches(c0, '[.;:]$') AND regexp_matches(content, '^[-0-9+−=×()⁄,/]') THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id, page ORDER BY seq) AS run FROM l)
SELECT doc_id, min(seq) AS seq, page, any_value(type) AS type, string_agg(content, ' ' ORDER BY seq) AS content FROM g GROUP BY doc_id, page, run""")
def merge_formula_fragments(spark, sf_dir):
    s = F.col("seq")
    text = F.when(s % 4 == 0, F.concat("w", F.lit(" ="))).when(s % 4 == 3, F.concat(F.lit("("), "w", F.lit(")."))).otherwise(F.concat(F.lit("+ "), "w"))
    d = _words(spark, sf_dir).withColumns({"type": F.when(s % 11 == 10, F.lit("paragraph")).otherwise(F.lit("formula")), "content": text, "is_enriched": F.lit(True), "bbox": F.array(*[F.lit(0.0)] * 4)}).drop("w")
    return C.merge_formula_fragments(d).select("doc_id", "seq", "page", "type", "content")


@query(f"""WITH {_WORDS_SQL} SELECT doc_id, seq, '<table>' || CASE WHEN seq % 3 = 0 THEN '' ELSE '<tr><th>a&amp;b</th><th></th></tr>' END || '<tr><td>' || w || ' &lt;1&gt;</td><td>' || seq || '</td></tr><tr><td>z</td></tr></table>' AS html FROM w""")
def table_html(spark, sf_dir):
    block = lambda *x: F.struct(F.array(*[F.struct(c.alias("content")) for c in x]).alias("block"))
    rows = F.array(F.struct(F.array(block(F.col("w"), F.lit("<1>")), block(F.col("seq").cast("string"))).alias("cells")), F.struct(F.array(block(F.lit("z"))).alias("cells")))
    columns = F.when(F.col("seq") % 3 == 0, F.array().cast("array<string>")).otherwise(F.array(F.lit("a&b"), F.lit(None).cast("string")))
    return _words(spark, sf_dir).select("doc_id", "seq", V.table_html(columns, rows).alias("html"))


@query(f"WITH {_WORDS_SQL} SELECT doc_id, seq, 'зато · (м3 - ' || lower(w) || '), 5' AS norm FROM w")
def norm_compare_steps(spark, sf_dir):
    """every step of the normal form has work."""
    text = F.concat(F.lit("з а т о   ( м 3 — "), "w", F.lit(" ) , 5"))
    return _words(spark, sf_dir).select("doc_id", "seq", X.norm_compare(text).alias("norm"))


_JOINED = "'Общие' || CASE WHEN regexp_full_match(w, '[A-Za-z]') THEN '' ELSE ' ' END || w"


@query(f"WITH {_WORDS_SQL} SELECT doc_id, seq, CASE seq % 4 WHEN 0 THEN {_JOINED} WHEN 1 THEN {_JOINED} WHEN 2 THEN 'О б щ и е ' || w || chr(10) || 'b' ELSE 'О б щ и е ' || w END AS content, CASE WHEN seq % 4 = 2 THEN {_JOINED} || ';b' END AS items, CASE WHEN seq % 4 = 3 THEN {_JOINED} END AS cells FROM w")
def join_spaced_letters(spark, sf_dir):
    """B1: in paragraphs, headings, list items and cells, but not in what lists and tables have as content."""
    s = F.col("seq") % 4
    text = F.concat(F.lit("О б щ и е "), "w")
    items = F.array(F.struct(text.alias("content")), F.struct(F.lit("b").alias("content")))
    rows = F.array(F.struct(F.array(F.struct(F.array(F.struct(text.alias("content"))).alias("block"))).alias("cells")))
    d = _words(spark, sf_dir).withColumns({"type": F.element_at(F.array(*map(F.lit, ("paragraph", "heading", "list", "table"))), (s + 1).cast("int")), "content": F.when(s == 2, F.concat(text, F.lit("\nb"))).otherwise(text), "items": F.when(s == 2, items), "rows": F.when(s == 3, rows)})
    out = R.join_spaced_letters(d)
    return out.select("doc_id", "seq", "content", F.array_join(F.transform("items", lambda i: i["content"]), ";").alias("items"), F.array_join(X.cell_texts(F.col("rows")), ";").alias("cells"))


@query(f"""WITH {_WORDS_SQL}, l AS (SELECT doc_id, seq, lower(w) || ' line ' || seq % 6 AS norm, 10.0 + 5 * (seq % 4) AS size FROM w WHERE page = 1),
z AS (SELECT doc_id, norm, max(size) AS size FROM l GROUP BY ALL), t AS (SELECT doc_id, max(size) AS top FROM z GROUP BY doc_id)
SELECT w.doc_id, w.seq, w.page, CASE WHEN w.seq % 7 = 0 AND w.seq = 7 THEN 'paragraph' WHEN w.seq % 7 = 0 THEN 'heading' ELSE 'paragraph' END AS type,
  CASE WHEN w.seq % 7 <> 0 OR w.seq = 7 THEN 0 WHEN w.page > 1 THEN 6 WHEN z.size / top >= 0.7 THEN 1 WHEN z.size / top >= 0.45 THEN 2 ELSE 3 END AS heading_level
FROM w LEFT JOIN z ON z.doc_id = w.doc_id AND w.page = 1 AND z.norm = lower(w) || ' line ' || seq % 6 LEFT JOIN t ON t.doc_id = w.doc_id""")
def title_page_levels(spark, sf_dir):
    """Headings of page 1 by the size of the line with their text; the logo is a paragraph; other pages stay."""
    s = F.col("seq")
    text = F.concat("w", F.lit(" Line "), (s % 6).cast("string"))
    w = _words(spark, sf_dir)
    heading = s % 7 == 0
    blocks = w.select("doc_id", "page", "seq", F.when(heading, F.lit("heading")).otherwise(F.lit("paragraph")).alias("type"), F.when(s == 7, F.concat(text, F.lit(" ЛОГО"))).otherwise(text).alias("content"), F.when(heading, F.lit(6)).alias("heading_level"))
    found = w.select("doc_id", "page", "seq", text.alias("text"), (10.0 + 5 * (s % 4)).alias("size"))
    return E.title_levels(blocks, found, "ЛОГО").select("doc_id", "seq", "page", "type", F.coalesce("heading_level", F.lit(0)).alias("heading_level"))


@query(f"""WITH {_SPANS_SQL}, l AS (SELECT doc_id, page, block_no, line_no, trim(string_agg(text, '' ORDER BY span_no)) AS text, min(x0) AS x0, max(10.0 + span_no % 4)::DOUBLE AS size, bool_or(span_no % 3 = 0) AS math FROM s WHERE trim(text) <> '' GROUP BY ALL)
SELECT doc_id, page, block_no, line_no, 'line' AS kind, md5(text) AS text, x0, size, math FROM l UNION ALL
SELECT doc_id, page, -1, seq::INT, 'img', md5(''), 72.0, 0.0, false FROM boxes WHERE seq % 6 = 0""")
def draft_lines(spark, sf_dir):
    images = boxes(spark, sf_dir).filter("seq % 6 = 0").select("doc_id", "page", F.col("seq").alias("ord"), "bbox")
    d = D.draft_lines(_spans(spark, sf_dir), images)
    return d.select("doc_id", "page", F.coalesce("block_no", F.lit(-1)).alias("block_no"), "line_no", "kind", F.md5("text").alias("text"), F.col("bbox")[0].alias("x0"), F.coalesce("size", F.lit(0.0)).alias("size"), F.coalesce("math", F.lit(False)).alias("math"))


_COORDS = "format('{{:.1f}} {{:.1f}} {{:.1f}} {{:.1f}}', x0, y0, x1, y1)".replace("{{", "{").replace("}}", "}")


@query("WITH " + _SPANS_SQL + ", r AS (SELECT doc_id, page, 0 AS k, block_no, line_no, span_no, " + _COORDS + " || CASE WHEN span_no % 3 = 0 THEN ' Cambria Math ' ELSE ' Arial ' END || (10 + span_no % 4) || '.0 ' || text AS dump FROM s UNION ALL SELECT doc_id, page, 1, seq::INT, NULL, NULL, 'IMG ' || " + _COORDS + " FROM boxes WHERE seq % 6 = 0) SELECT doc_id, page, (row_number() OVER (PARTITION BY doc_id, page ORDER BY k, block_no, line_no, span_no) - 1)::INT AS n, md5(dump) AS dump FROM r")
def span_dump(spark, sf_dir):
    images = boxes(spark, sf_dir).filter("seq % 6 = 0").select("doc_id", "page", F.col("seq").alias("ord"), "bbox")
    return V.span_dump(_spans(spark, sf_dir), images).withColumn("dump", F.md5("dump"))


@query(f"""WITH {_WORDS_SQL} SELECT doc_id, page, seq, CASE seq % 3 WHEN 0 THEN 'list' WHEN 1 THEN 'table' ELSE 'heading' END AS type, CASE WHEN seq % 3 = 2 THEN w ELSE '' END AS content,
  CASE WHEN seq % 3 = 0 THEN w || ';b' ELSE '' END AS items, CASE WHEN seq % 3 = 1 THEN w || ';2' ELSE '' END AS cells, CASE WHEN seq % 3 = 1 THEN 1 ELSE 0 END AS number_of_rows, CASE WHEN seq % 3 = 2 THEN 3 ELSE 0 END AS heading_level FROM w""")
def markup_to_blocks(spark, sf_dir):
    """M11 there, back and there again, with every field."""
    s, w = F.col("seq") % 3, F.col("w")
    kind = F.element_at(F.array(F.lit("li"), F.lit("table"), F.lit("h")), (s + 1).cast("int"))
    d = _words(spark, sf_dir).select("doc_id", F.col("page").alias("p"), "seq", kind.alias("t"), F.when(s == 2, w).alias("c"), F.when(s == 2, F.lit(3)).alias("lvl"), F.when(s == 0, F.array(w, F.lit("b"))).alias("items"), F.when(s == 1, F.array(F.lit("x"), F.lit("y"))).alias("cols"), F.when(s == 1, F.array(F.array(w, F.lit("2")))).alias("rows"))
    out = D.from_markup(D.to_markup(D.from_markup(d)))
    items, cells = F.array_join(F.transform("items", lambda i: i["content"]), ";"), F.array_join(X.cell_texts(F.col("rows")), ";")
    empty = lambda c: F.coalesce(c, F.lit(""))
    return out.select("doc_id", "page", "seq", "type", empty(F.col("content")).alias("content"), empty(items).alias("items"), empty(cells).alias("cells"), F.coalesce("number_of_rows", F.lit(0)).alias("number_of_rows"), F.coalesce("heading_level", F.lit(0)).alias("heading_level"))


_SUBSTITUTED = _ESC.format("content")


@query(f"""WITH {BOXES_SQL}, g AS (SELECT *, length(content) >= 3 AND x1 <= 595 AND NOT regexp_full_match(content, '[^\\p{{L}}\\p{{M}}\\p{{Pc}}]+', 's') AS good FROM boxes)
SELECT doc_id, page, md5(string_agg('<b>' || seq || '</b>' || CASE WHEN seq % 5 <> 0 THEN '' WHEN good THEN '<p>' || {_SUBSTITUTED} || '</p>' ELSE '{E.MARKER}' END, '' ORDER BY seq)) AS html FROM g GROUP BY doc_id, page""")
def substitute_undecoded(spark, sf_dir):
    """Every fifth line was not decoded; its box finds the line where it is on the page and has letters."""
    d = boxes(spark, sf_dir)
    marked = F.concat(F.lit("<b>"), F.col("seq").cast("string"), F.lit("</b>"), F.when(F.col("seq") % 5 == 0, F.lit(E.MARKER)).otherwise(F.lit("")))
    parts = F.transform(F.array_sort(F.collect_list(F.struct("seq", marked.alias("t")))), lambda x: x["t"])
    pages = d.groupBy("doc_id", "page").agg(F.array_join(parts, "").alias("html"))
    b = F.col("bbox")
    w = Window.partitionBy("doc_id", "page").orderBy("seq")
    found = d.filter("seq % 5 = 0").select("doc_id", "page", (F.row_number().over(w) - 1).alias("ord"), F.array(b[0], 842 - b[1], b[2], 842 - b[3]).alias("bbox"))
    meta = d.select("doc_id", "page").distinct().withColumns({"width": F.lit(595.0), "height": F.lit(842.0)})
    out = E.substitute_undecoded(pages, found, d.select("doc_id", "page", F.col("content").alias("text"), "bbox"), meta)
    return out.select("doc_id", "page", F.md5("html").alias("html"))


# Texts of one letter: their likeness is known, 2 * min / (n + m) for the same letter and 0 otherwise, so that SQL can follow the matching.
_LETTERS_SQL = f"""{LINES_SQL},
g AS (SELECT doc_id, page, seq, CASE WHEN seq % 8 = 7 THEN 'image' ELSE type END AS type, CASE WHEN seq % 8 = 7 THEN '' ELSE repeat(chr((97 + seq % 5)::INT), (5 + seq * 7 % 11)::INT) END AS t, CASE WHEN seq % 8 = 7 THEN 'k' || seq % 3 ELSE '' END AS key,
  row_number() OVER (PARTITION BY doc_id, page ORDER BY seq) AS n FROM lines),
r AS (SELECT doc_id, page, list({{'seq': seq, 'type': CASE WHEN seq % 8 = 7 THEN 'image' WHEN seq % 9 = 8 THEN 'formula' ELSE type END, 't': CASE WHEN seq % 8 = 7 THEN '' ELSE repeat(chr((97 + seq % 5)::INT), (5 + seq * 5 % 11)::INT) END, 'key': CASE WHEN seq % 8 = 7 THEN 'k' || seq // 8 % 3 ELSE '' END}} ORDER BY seq) AS rows FROM lines WHERE seq % 5 <> 4 GROUP BY doc_id, page),
p AS (SELECT g.*, list_filter(list_transform(coalesce(rows, []), lambda x: {{'like': CASE WHEN g.t = '' THEN CASE WHEN x.t = '' AND x.key = g.key THEN 1.0 ELSE 0.0 END WHEN x.t = '' OR x.t[1] <> g.t[1] THEN 0.0 ELSE 2.0 * least(length(x.t), length(g.t)) / (length(x.t) + length(g.t)) END::DOUBLE, 'back': -x.seq, 'same': x.type = g.type, 'length': length(x.t)}}), lambda x: x."like" >= 0.6) AS o FROM g LEFT JOIN r ON r.doc_id = g.doc_id AND r.page = g.page),
m AS (SELECT doc_id, page, seq, n, t, list_reverse_sort(list_filter(o, lambda x: x.same))[1] AS hit, len(list_filter(o, lambda x: NOT x.same)) > 0 AND t <> '' AS other, list_filter([list_reverse_sort(list_filter(o, lambda x: x.same))[1]."back"], lambda x: x IS NOT NULL) AS used FROM p WHERE n = 1 UNION ALL
  SELECT doc_id, page, seq, n, t, hit, other, list_concat(used, list_filter([hit."back"], lambda x: x IS NOT NULL)) FROM (
    SELECT p.doc_id, p.page, p.seq, p.n, p.t, m.used, list_reverse_sort(list_filter(p.o, lambda x: x.same AND NOT list_contains(m.used, x."back")))[1] AS hit, len(list_filter(p.o, lambda x: NOT x.same AND NOT list_contains(m.used, x."back"))) > 0 AND p.t <> '' AS other FROM m JOIN p ON p.doc_id = m.doc_id AND p.page = m.page AND p.n = m.n + 1))"""


def _letters(spark, sf_dir):
    s = F.col("seq")
    image, letter = s % 8 == 7, F.char(97 + s % 5)
    d = lines(spark, sf_dir)
    side = lambda x, kind, length, key: M.prepared(x.withColumns({"type": F.when(image, F.lit("image")).otherwise(kind), "content": F.when(image, F.lit("")).otherwise(F.repeat(letter, length.cast("int"))), "image_key": F.when(image, F.concat(F.lit("k"), key.cast("string")))}))
    golden = side(d, F.col("type"), 5 + s * 7 % 11, s % 3)
    result = side(d.filter(s % 5 != 4), F.when(s % 9 == 8, F.lit("formula")).otherwise(F.col("type")), 5 + s * 5 % 11, F.floor(s / 8) % 3)
    return golden, result, M.greedy_match(golden, result)


@query(f"""WITH RECURSIVE {_LETTERS_SQL} SELECT doc_id, page, seq, coalesce(-hit."back", -1) AS result_seq, round(coalesce(hit."like", 0), 6)::DOUBLE AS likeness, hit IS NULL AND other AS type_break FROM m""")
def greedy_match_letters(spark, sf_dir):
    return _letters(spark, sf_dir)[2].select("doc_id", "page", "seq", F.coalesce("result_seq", F.lit(-1)).alias("result_seq"), F.round(F.coalesce("likeness", F.lit(0.0)), 6).alias("likeness"), "type_break")


@query(f"""WITH RECURSIVE {_LETTERS_SQL}, c AS (SELECT doc_id, sum(length(t))::BIGINT AS total, sum(CASE WHEN hit IS NULL THEN 0 ELSE least(length(t), hit.length) END)::BIGINT AS same FROM m GROUP BY doc_id) SELECT *, CASE WHEN total > 0 THEN round(same / total, 3) ELSE 0 END::DOUBLE AS coverage FROM c""")
def text_coverage_letters(spark, sf_dir):
    return M.text_coverage(*_letters(spark, sf_dir))


@query(f"""WITH {BOXES_SQL}, l AS (SELECT doc_id, page, seq, (97 + seq % 5)::INT AS c, (4 + seq * 7 % 13)::INT AS n, (4 + seq * 5 % 11)::INT AS m, x0, y0, x1, y1 FROM boxes),
j AS (SELECT d.doc_id, d.page, d.seq, l.seq AS line_no, CASE WHEN d.c <> l.c THEN 0.0 WHEN l.m <= d.n THEN 1.0 ELSE 2.0 * least(d.n, l.m) / (d.n + l.m) END AS r, l.x0, l.y0, l.x1, l.y1 FROM l d JOIN l ON d.doc_id = l.doc_id AND d.page = l.page),
k AS (SELECT *, row_number() OVER w AS n, first_value(line_no) OVER w AS best, first_value(r) OVER w AS top FROM j WINDOW w AS (PARTITION BY doc_id, page, seq ORDER BY r DESC, line_no))
SELECT doc_id, page, seq, round(min(x0), 1) AS x0, round(min(y0), 1) AS y0, round(max(x1), 1) AS x1, round(max(y1), 1) AS y1 FROM k WHERE top >= 0.6 AND ((r >= 0.6 AND n <= 8) OR (abs(line_no - best) <= 6 AND r >= 0.3)) GROUP BY doc_id, page, seq""")
def locate_drafts_letters(spark, sf_dir):
    """M13 over texts of one letter, whose likeness is known."""
    s = F.col("seq")
    text = lambda n: F.repeat(F.char(97 + s % 5), n.cast("int"))
    d = boxes(spark, sf_dir)
    out = D.locate_drafts(d.select("doc_id", "page", "seq", text(4 + s * 7 % 13).alias("content")), d.select("doc_id", "page", s.cast("int").alias("line_no"), text(4 + s * 5 % 11).alias("text"), "bbox"))
    return out.select("doc_id", "page", "seq", *[F.col("bbox")[i].alias(c) for i, c in enumerate(("x0", "y0", "x1", "y1"))])


@query(f"""WITH {LINES_SQL}, b AS (SELECT doc_id, page, string_agg(repeat('a', (3 + seq % 9)::INT) || 'b', '' ORDER BY seq) AS hay, max(3 + seq % 9) AS longest FROM lines WHERE seq % 4 <> 2 GROUP BY doc_id, page)
SELECT l.doc_id, l.page, l.seq FROM lines l LEFT JOIN b ON b.doc_id = l.doc_id AND b.page = l.page WHERE coalesce(longest, 0) < 0.85 * (5 + l.seq % 17)""")
def verify_draft_letters(spark, sf_dir):
    """Runs of one letter, whose longest common part with a page is its longest run."""
    d = lines(spark, sf_dir)
    source = d.withColumn("content", F.repeat(F.lit("a"), (5 + F.col("seq") % 17).cast("int")))
    held = d.filter(F.col("seq") % 4 != 2).withColumn("content", F.concat(F.repeat(F.lit("a"), (3 + F.col("seq") % 9).cast("int")), F.lit("b")))
    return D.missing_from(source, held).select("doc_id", "page", "seq")
