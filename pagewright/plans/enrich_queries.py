"""Enrichment from the PDF, boxes and images over typeset lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagewright.functions import geometry as G
from pagewright.operators import enrich as E
from pagewright.plans.inputs import BOXES_SQL, LINES_SQL, boxes, lines
from pagewright.plans.registry import registry

QUERIES, SQL, query = registry()

_BOX = "x0, y0, x1, y1"


def _flat(df, *names):
    b = F.col("bbox")
    return df.select(*names, b[0].alias("x0"), b[1].alias("y0"), b[2].alias("x1"), b[3].alias("y1"))


def _pdf_lines(spark, sf_dir):
    """Lines as a PDF library gives them: five lines a block."""
    d = boxes(spark, sf_dir)
    return d.select("doc_id", "page", F.floor(F.col("seq") / 5).cast("int").alias("block_no"), F.col("seq").cast("int").alias("line_no"), "seq", F.col("content").alias("text"), "bbox", (10 + F.col("seq") % 7).cast("double").alias("size"), F.lit(0.0).alias("math_share"))


@query(f"WITH {BOXES_SQL} SELECT doc_id, page, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1 FROM boxes GROUP BY doc_id, page")
def box_union(spark, sf_dir):
    return _flat(boxes(spark, sf_dir).groupBy("doc_id", "page").agg(G.union_agg(F.col("bbox")).alias("bbox")), "doc_id", "page")


@query(f"""WITH {BOXES_SQL}, p AS (SELECT doc_id, seq, y0, y1, x1, lag(y0 + 7) OVER w AS b0, lag(y1 + 7) OVER w AS b1, lag(x1) OVER w AS bx FROM boxes WINDOW w AS (PARTITION BY doc_id, page ORDER BY seq)),
q AS (SELECT doc_id, seq, least(x1, bx) - 72 AS w, least(y1, b1) - greatest(y0, b0) AS h, (x1 - 72) * (y1 - y0) + (bx - 72) * (b1 - b0) AS area FROM p WHERE b0 IS NOT NULL)
SELECT doc_id, seq, round(CASE WHEN w <= 0 OR h <= 0 THEN 0.0 ELSE w * h / (area - w * h) END, 6)::DOUBLE AS iou, h > 0.5 AS same_band FROM q""")
def box_overlap(spark, sf_dir):
    from pyspark.sql import Window

    w = Window.partitionBy("doc_id", "page").orderBy("seq")
    d = boxes(spark, sf_dir).withColumn("before", F.lag(F.transform("bbox", lambda v, i: F.when((i == 1) | (i == 3), v + 7).otherwise(v))).over(w)).filter("before IS NOT NULL")
    return d.select("doc_id", "seq", F.round(G.iou(F.col("bbox"), F.col("before")), 6).alias("iou"), G.same_band(F.col("bbox"), F.col("before")).alias("same_band"))


@query(f"WITH {BOXES_SQL} SELECT doc_id, seq, round(x0, 1) AS x0, round(842.25 - y1, 1) AS y0, round(x1, 1) AS x1, round(842.25 - y0, 1) AS y1 FROM boxes")
def box_from_bottom(spark, sf_dir):
    b = F.col("bbox")
    d = boxes(spark, sf_dir).withColumn("bbox", G.from_bottom(F.array(b[0], b[3], b[2], b[1]), F.lit(842.25)))
    return _flat(d, "doc_id", "seq")


@query(f"WITH {BOXES_SQL} SELECT doc_id, seq FROM boxes WHERE x1 - x0 > 10 AND x1 - x0 < 400 AND y0 >= 842 * 0.15 AND y1 + 8 <= 842 * 0.85")
def image_candidates(spark, sf_dir):
    d = boxes(spark, sf_dir).withColumn("bbox", F.transform("bbox", lambda v, i: F.when(i == 3, v + 8).otherwise(v)))
    return d.filter(G.image_candidate(F.col("bbox"), F.lit(842.0))).select("doc_id", "seq")


_NORM = r"regexp_replace(regexp_replace(lower(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace({0}, '\s+', ' ', 'g'), '[—–]', '-', 'g'), '\s+([,.;:])', '\1', 'g'), '\(\s+', '(', 'g'), '\s+\)', ')', 'g'), '([а-яёa-z0-9])\s+([0-9])', '\1\2', 'g'))), '^$', ''), '^$', '')"


def _with_tables(d):
    """Every fourth line is a table without content: its words are the cells of one row, and it has a column name."""
    block = lambda w: F.struct(F.array(F.struct(w.alias("content"))).alias("block"))
    rows = F.array(F.struct(F.transform(F.split("content", " "), block).alias("cells")))
    t = F.col("seq") % 4 == 1
    return d.withColumns({"rows": F.when(t, rows), "columns": F.when(t, F.array(F.lit("Col"), F.lit(""))), "type": F.when(t, F.lit("table")).otherwise(F.col("type")), "content": F.when(~t, F.col("content"))})


_TABLE_TEXT = "CASE WHEN seq % 4 = 1 THEN array_to_string(list_filter(string_split(content, ' '), lambda x: x <> ''), ' ') || CASE WHEN trim(content) = '' THEN 'Col' ELSE ' Col' END ELSE content END"


@query(f"WITH {LINES_SQL} SELECT doc_id, page, md5(' ' || string_agg({_NORM.format(_TABLE_TEXT)}, '' ORDER BY seq)) AS page_text FROM lines WHERE trim({_TABLE_TEXT}) <> '' GROUP BY doc_id, page")
def page_text(spark, sf_dir):
    return E.page_text(_with_tables(lines(spark, sf_dir))).select("doc_id", "page", F.md5("page_text").alias("page_text"))


@query(f"""WITH {LINES_SQL}, p AS (SELECT doc_id, page, ' ' || string_agg({_NORM.format('content')}, '' ORDER BY seq) AS t FROM lines WHERE seq % 3 <> 1 GROUP BY doc_id, page),
l AS (SELECT lines.*, {_NORM.format('content')} AS n, coalesce(t, '') AS t FROM lines LEFT JOIN p USING (doc_id, page)), m AS (SELECT *, regexp_replace(n, '[0-9\\s]+\\s*$', '') AS bare FROM l)
SELECT doc_id, page, seq FROM m WHERE NOT (t <> '' AND (contains(t, n) OR bare <> '' AND NOT regexp_matches(bare, '[-.]$') AND contains(t, bare) OR contains(regexp_replace(t, '\\s+', '', 'g'), regexp_replace(n, '\\s+', '', 'g'))))""")
def missing_lines(spark, sf_dir):
    d = lines(spark, sf_dir)
    return E.missing_lines(d.withColumn("text", F.col("content")), E.page_text(d.filter(F.col("seq") % 3 != 1))).select("doc_id", "page", "seq")


@query(f"""WITH {LINES_SQL}, k AS (SELECT doc_id, page, seq, CASE seq % 4 WHEN 0 THEN 'formula' WHEN 3 THEN 'number' ELSE 'text' END AS kind FROM lines),
o AS (SELECT *, max(CASE WHEN kind = 'formula' THEN seq END) OVER (PARTITION BY doc_id, page ORDER BY seq) AS owner FROM k),
n AS (SELECT doc_id, page, owner, min(seq) AS first FROM o WHERE kind = 'number' AND owner IS NOT NULL GROUP BY ALL)
SELECT k.doc_id, k.seq, k.kind, CASE WHEN n.first IS NULL THEN 't' || k.seq ELSE 't' || k.seq || ' (1.' || n.first || ')' END AS text FROM k LEFT JOIN n ON k.doc_id = n.doc_id AND k.page = n.page AND k.seq = n.owner WHERE kind <> 'number'""")
def formula_numbers(spark, sf_dir):
    m, n = F.col("seq") % 4, F.col("seq").cast("string")
    d = lines(spark, sf_dir).select("doc_id", "page", "seq", F.when(m == 0, "formula").when(m == 3, "number").otherwise("text").alias("kind"), F.when(m == 3, F.concat(F.lit("(1."), n, F.lit(")"))).otherwise(F.concat(F.lit("t"), n)).alias("text"))
    return E.attach_formula_numbers(d).select("doc_id", "seq", "kind", "text")


@query(f"WITH {LINES_SQL} SELECT doc_id, seq, CASE seq % 5 WHEN 0 THEN 'number' WHEN 1 THEN 'noise' WHEN 2 THEN 'caption' WHEN 3 THEN 'formula' ELSE 'text' END AS kind FROM lines")
def line_kinds(spark, sf_dir):
    m = F.col("seq") % 5
    text = F.when(m == 0, F.lit("(2.3.1)")).when(m == 1, F.lit("12 - 3/4")).when(m == 2, F.lit("Таблица 2.2.1 Группа")).when(m == 3, F.concat(F.lit("G = qS "), F.lit("β"))).otherwise(F.lit("Изоляция помещений судна"))
    return lines(spark, sf_dir).select("doc_id", "seq", E.line_kind(text, F.lit(0.0)).alias("kind"))


@query(f"""WITH {BOXES_SQL}, k AS (SELECT *, seq // 5 AS block_no, CASE WHEN seq % 5 = 2 THEN 'formula' ELSE 'text' END AS kind FROM boxes),
r AS (SELECT *, sum((kind = 'formula')::INT) OVER (PARTITION BY doc_id, page, block_no ORDER BY seq) AS run FROM k)
SELECT doc_id, min(seq) AS seq, md5(string_agg(content, ' ' ORDER BY seq)) AS content, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1 FROM r WHERE kind = 'text' GROUP BY doc_id, page, block_no, run""")
def enrich_paragraphs(spark, sf_dir):
    d = _pdf_lines(spark, sf_dir).withColumn("kind", F.when(F.col("seq") % 5 == 2, "formula").otherwise("text"))
    return _flat(E.paragraphs(d).withColumn("content", F.md5("content")), "doc_id", "seq", "content")


@query(f"WITH {BOXES_SQL}, n AS (SELECT *, {_NORM.format('content')} AS norm FROM boxes) SELECT doc_id, page, md5(norm) AS norm, arg_max(x0, seq) AS x0, arg_max(y0, seq) AS y0, arg_max(x1, seq) AS x1, arg_max(y1, seq) AS y1 FROM n WHERE length(norm) >= 3 GROUP BY doc_id, page, norm")
def bbox_index(spark, sf_dir):
    return _flat(E.bbox_index(_pdf_lines(spark, sf_dir)).withColumn("norm", F.md5("norm")), "doc_id", "page", "norm")


_INDEX = f"n AS (SELECT *, {_NORM.format('content')} AS norm FROM boxes), i AS (SELECT doc_id, page, norm, arg_max(x0, seq) AS x0, arg_max(y0, seq) AS y0, arg_max(x1, seq) AS x1, arg_max(y1, seq) AS y1 FROM n WHERE length(norm) >= 3 GROUP BY doc_id, page, norm)"


@query(f"WITH {BOXES_SQL}, {_INDEX} SELECT n.doc_id, n.seq, coalesce(i.x0, j.x0, k.x0) AS x0, coalesce(i.y0, j.y0, k.y0) AS y0, coalesce(i.x1, j.x1, k.x1) AS x1, coalesce(i.y1, j.y1, k.y1) AS y1 FROM (SELECT doc_id, page, seq, norm || '..' AS a, regexp_replace(norm, '\\.+$', '') AS b FROM n) n LEFT JOIN i ON i.doc_id = n.doc_id AND i.page = n.page AND i.norm = n.a LEFT JOIN i j ON j.doc_id = n.doc_id AND j.page = n.page AND j.norm = n.b LEFT JOIN i k ON k.doc_id = n.doc_id AND k.page = n.page AND k.norm = n.b || '.'")
def bbox_lookup(spark, sf_dir):
    d = lines(spark, sf_dir).select("doc_id", "page", "seq", F.concat("content", F.lit("..")).alias("text"))
    return _flat(E.lookup(d, E.bbox_index(_pdf_lines(spark, sf_dir))), "doc_id", "seq")


@query(f"WITH {BOXES_SQL}, {_INDEX} SELECT n.doc_id, n.seq, coalesce(i.x0, 0.0) AS x0, coalesce(i.y0, 0.0) AS y0, coalesce(i.x1, 0.0) AS x1, coalesce(i.y1, 0.0) AS y1 FROM n LEFT JOIN i USING (doc_id, page, norm)")
def bbox_restore(spark, sf_dir):
    zero = F.array(*[F.lit(0.0)] * 4)
    return _flat(E.restore_boxes(boxes(spark, sf_dir).withColumn("bbox", zero), E.bbox_index(_pdf_lines(spark, sf_dir))), "doc_id", "seq")


@query(f"WITH {BOXES_SQL}, {_INDEX} SELECT n.doc_id, n.seq, CASE WHEN type IN ('paragraph', 'heading', 'list') THEN coalesce(j.y0, 0.0) ELSE 0.0 END AS y0 FROM n LEFT JOIN (SELECT doc_id, page, norm, arg_max(round(y0, 1), seq) AS y0 FROM n GROUP BY ALL) j USING (doc_id, page, norm)")
def layout_bbox(spark, sf_dir):
    d = boxes(spark, sf_dir)
    b = F.col("bbox")
    layout = d.select("doc_id", "page", F.col("seq").alias("ord"), F.col("content").alias("text"), F.array(b[0], 842 - b[1], b[2], 842 - b[3]).alias("bbox"))
    meta = d.select("doc_id", "page").distinct().withColumn("width", F.lit(595.0)).withColumn("height", F.lit(842.0))
    return E.layout_boxes(d.withColumn("bbox", F.array(*[F.lit(0.0)] * 4)), layout, meta).select("doc_id", "seq", F.col("bbox")[1].alias("y0"))


@query(f"WITH {LINES_SQL}, t AS (SELECT *, row_number() OVER (PARTITION BY doc_id, page ORDER BY seq) AS n FROM lines WHERE seq % 2 = 0 AND seq % 4 <> 0) SELECT l.doc_id, l.seq, CASE WHEN l.seq % 2 = 1 THEN 0.0 WHEN l.seq % 4 = 0 THEN 1.0 ELSE coalesce(CASE WHEN t.n <= 3 THEN t.n * 10.0 END, 0.0) END::DOUBLE AS x0 FROM lines l LEFT JOIN t ON t.doc_id = l.doc_id AND t.seq = l.seq")
def table_ordinal(spark, sf_dir):
    d = lines(spark, sf_dir).withColumn("type", F.when(F.col("seq") % 2 == 0, "table").otherwise("paragraph"))
    d = d.withColumn("bbox", F.array_repeat(F.when(F.col("seq") % 4 == 0, F.lit(1.0)).otherwise(F.lit(0.0)), 4))
    t = d.select("doc_id", "page").distinct().withColumn("ord", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3)))).withColumn("bbox", F.array_repeat((F.col("ord") * 10).cast("double"), 4))
    return E.bind_tables(d, t).select("doc_id", "seq", F.col("bbox")[0].alias("x0"))


@query(None)
def title_levels(spark, sf_dir):
    d = lines(spark, sf_dir).withColumn("heading_level", F.lit(2))
    return E.title_levels(d, _pdf_lines(spark, sf_dir)).filter("type = 'heading' AND page = 1").select("doc_id", "seq", "heading_level")


def _files(spark, sf_dir):
    d = boxes(spark, sf_dir).filter(F.col("seq") % 3 == 0)
    return E.name_images(d.select("doc_id", "page", F.col("seq").alias("ord"), "bbox", F.lit(b"x").alias("bytes")))


def _image_blocks(spark, sf_dir):
    none = F.lit(None).cast("string")
    d = lines(spark, sf_dir).withColumn("type", F.when(F.col("seq") % 4 == 0, "image").otherwise("paragraph"))
    return d.withColumns({"image_key": none, "temp_path": none, "bbox": F.array(*[F.lit(0.0)] * 4)})


_FILES = f"f AS (SELECT doc_id, page, x1, row_number() OVER (PARTITION BY doc_id, page ORDER BY seq) AS n FROM boxes WHERE seq % 3 = 0), b AS (SELECT doc_id, page, seq, row_number() OVER (PARTITION BY doc_id, page ORDER BY seq) AS n FROM lines WHERE seq % 4 = 0)"


@query(f"WITH {BOXES_SQL}, {_FILES} SELECT b.doc_id, b.seq, CASE WHEN f.n IS NOT NULL THEN 'page_' || b.page || '_' || f.n || '.png' END AS image_key, coalesce(f.x1, 0.0) AS x1 FROM b LEFT JOIN f USING (doc_id, page, n)")
def image_bind(spark, sf_dir):
    return E.bind_images(_image_blocks(spark, sf_dir), _files(spark, sf_dir)).filter("type = 'image'").select("doc_id", "seq", "image_key", F.col("bbox")[2].alias("x1"))


@query(f"WITH {BOXES_SQL}, {_FILES}, t AS (SELECT doc_id, max(seq) + 1 AS top FROM lines GROUP BY doc_id) SELECT f.doc_id, top + row_number() OVER (PARTITION BY f.doc_id ORDER BY f.page, f.n) - 1 AS seq, 'page_' || f.page || '_' || f.n || '.png' AS image_key FROM f JOIN t ON t.doc_id = f.doc_id LEFT JOIN b ON b.doc_id = f.doc_id AND b.page = f.page AND b.n = f.n WHERE b.n IS NULL")
def inject_images(spark, sf_dir):
    files = _files(spark, sf_dir)
    base = _image_blocks(spark, sf_dir)
    top = base.groupBy("doc_id").agg(F.max("seq").alias("top"))
    return E.inject_images(E.bind_images(base, files), files).join(top, "doc_id").filter("seq > top").select("doc_id", "seq", "image_key")


@query(f"WITH {BOXES_SQL}, c AS (SELECT * FROM boxes WHERE seq % 5 = 1), k AS (SELECT * FROM boxes WHERE seq % 5 <> 1 OR seq % 2 = 0) SELECT doc_id, page, seq AS ord FROM c WHERE NOT EXISTS (SELECT 1 FROM k WHERE k.doc_id = c.doc_id AND k.page = c.page AND least(k.x1, c.x1) > 72 AND least(k.y1, c.y1) > greatest(k.y0, c.y0) AND (least(k.x1, c.x1) - 72) * (least(k.y1, c.y1) - greatest(k.y0, c.y0)) / ((k.x1 - 72) * 12 + (c.x1 - 72) * 12 - (least(k.x1, c.x1) - 72) * (least(k.y1, c.y1) - greatest(k.y0, c.y0))) >= 0.5)")
def formula_images(spark, sf_dir):
    d = boxes(spark, sf_dir)
    c = d.filter(F.col("seq") % 5 == 1).select("doc_id", "page", F.col("seq").alias("ord"), "bbox")
    return E.formula_images(c, d.filter((F.col("seq") % 5 != 1) | (F.col("seq") % 2 == 0)), page_aware=True).select("doc_id", "page", "ord")


@query(f"WITH {BOXES_SQL} SELECT doc_id, page, string_agg(round(x1, 1)::BIGINT::VARCHAR, ',' ORDER BY seq) AS boxes FROM boxes WHERE type = 'formula' AND seq % 2 = 1 GROUP BY doc_id, page")
def undecoded_formulas(spark, sf_dir):
    d = boxes(spark, sf_dir).select("doc_id", "page", F.col("seq").alias("ord"), F.col("type").alias("label"), F.when(F.col("seq") % 2 == 1, F.lit(" ")).otherwise(F.lit("x")).alias("text"), "bbox")
    return E.collect_undecoded(d).select("doc_id", "page", F.array_join(F.transform("boxes", lambda b: b[2].cast("long").cast("string")), ",").alias("boxes"))


@query(None)
def enriched_blocks(spark, sf_dir):
    """E9 over typeset lines, two thirds of which the layout engine has."""
    d = boxes(spark, sf_dir).withColumn("is_enriched", F.lit(False))
    return E.enriched(d.filter(F.col("seq") % 3 != 1), _pdf_lines(spark, sf_dir).drop("seq")).select("doc_id", "page", "seq", "type", "content", "is_enriched")


