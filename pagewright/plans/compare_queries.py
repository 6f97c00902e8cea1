"""Golden comparison, golden tools, rendering and JSON: golden blocks are lines, result blocks are the same lines cleaned and thinned."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagewright.functions import text as X
from pagewright.operators import compare as M
from pagewright.operators import golden as D
from pagewright.operators import render as V
from pagewright.plans.inputs import LINES_SQL, lines, pages
from pagewright.plans.registry import registry
from pagewright.sources import files as S

QUERIES, SQL, query = registry()


def _prepared(d):
    """Short forms are enough where only equality matters: text as norm."""
    key = X.norm_key(F.col("type"), F.col("content"))
    shape = F.when(F.col("type") == "heading", F.lit("2")).when(F.col("type") == "list", F.length("content").cast("string"))
    return d.select("doc_id", "page", "seq", "type", F.col("content").alias("text"), key.alias("norm"), key.alias("deep"), F.lit(None).cast("string").alias("image_key"), shape.alias("shape"))


def _golden(spark, sf_dir):
    return _prepared(lines(spark, sf_dir))


def _result(spark, sf_dir):
    """Without every fifth line, with a tail on every sixth and spaces around every seventh."""
    s = F.col("seq")
    c = F.when(s % 6 == 1, F.concat("content", F.lit(" x"))).when(s % 7 == 2, F.concat(F.lit("  "), "content", F.lit(" "))).otherwise(F.col("content"))
    return _prepared(lines(spark, sf_dir).filter(s % 5 != 4).withColumn("content", c))


_MATCH = LINES_SQL + r""", g AS (SELECT *, lower(trim(regexp_replace(content, '\s+', ' ', 'g'))) AS norm, CASE type WHEN 'heading' THEN '2' WHEN 'list' THEN length(content)::VARCHAR END AS shape FROM lines),
r0 AS (SELECT doc_id, page, seq, type, CASE WHEN seq % 6 = 1 THEN content || ' x' WHEN seq % 7 = 2 THEN '  ' || content || ' ' ELSE content END AS content FROM lines WHERE seq % 5 <> 4),
r AS (SELECT *, lower(trim(regexp_replace(content, '\s+', ' ', 'g'))) AS norm, CASE type WHEN 'heading' THEN '2' WHEN 'list' THEN length(content)::VARCHAR END AS shape FROM r0),
gn AS (SELECT *, row_number() OVER (PARTITION BY doc_id, page, type, norm ORDER BY seq) AS n FROM g WHERE norm <> ''), rn AS (SELECT *, row_number() OVER (PARTITION BY doc_id, page, type, norm ORDER BY seq) AS n FROM r WHERE norm <> ''),
m AS (SELECT gn.doc_id, gn.page, gn.seq, rn.seq AS result_seq, gn.type, gn.shape AS golden_shape, rn.shape AS result_shape FROM gn JOIN rn USING (doc_id, page, type, norm, n)),
st AS (SELECT 'golden' AS side, g.doc_id, g.page, g.seq, g.type, g.content, CASE WHEN m.seq IS NULL THEN 'missed' ELSE 'ok' END AS status FROM g LEFT JOIN m ON m.doc_id = g.doc_id AND m.page = g.page AND m.seq = g.seq
  UNION ALL SELECT 'result', r.doc_id, r.page, r.seq, r.type, r.content, CASE WHEN m.seq IS NULL THEN 'extra' ELSE 'ok' END FROM r LEFT JOIN m ON m.doc_id = r.doc_id AND m.page = r.page AND m.result_seq = r.seq)"""
_SCORE = "round(CASE WHEN result > 0 THEN matched / result ELSE 0 END, 3)::DOUBLE AS precision, round(CASE WHEN golden > 0 THEN matched / golden ELSE 0 END, 3)::DOUBLE AS recall, round(CASE WHEN golden > 0 AND result > 0 AND matched > 0 THEN 2 * (matched / result) * (matched / golden) / (matched / result + matched / golden) ELSE 0 END, 3)::DOUBLE AS f1"
_COUNTS = "count(*) FILTER (side = 'golden') AS golden, count(*) FILTER (side = 'result') AS result, count(*) FILTER (side = 'golden' AND status = 'ok') AS matched"


def _match(spark, sf_dir):
    g, r = _golden(spark, sf_dir), _result(spark, sf_dir)
    return g, r, M.exact_match(g, r)


def _status(spark, sf_dir):
    return M.status_rows(*_match(spark, sf_dir))


@query(f"WITH {_MATCH} SELECT doc_id, page, seq, result_seq FROM m")
def exact_match(spark, sf_dir):
    return _match(spark, sf_dir)[2].select("doc_id", "page", "seq", "result_seq")


@query(f"WITH {_MATCH} SELECT side, doc_id, page, seq, type, status FROM st")
def status(spark, sf_dir):
    return _status(spark, sf_dir).select("side", "doc_id", "page", "seq", "type", "status")


@query(f"WITH {_MATCH}, c AS (SELECT doc_id, {_COUNTS} FROM st GROUP BY doc_id) SELECT *, {_SCORE} FROM c")
def match_summary(spark, sf_dir):
    return M.scores(_status(spark, sf_dir), "doc_id")


@query(f"WITH {_MATCH}, c AS (SELECT type, {_COUNTS} FROM st GROUP BY type) SELECT *, {_SCORE} FROM c")
def match_by_type(spark, sf_dir):
    return M.scores(_status(spark, sf_dir), "type")


@query(f"WITH {_MATCH}, c AS (SELECT page, {_COUNTS} FROM st GROUP BY page) SELECT *, {_SCORE} FROM c")
def match_by_page(spark, sf_dir):
    return M.scores(_status(spark, sf_dir), "page")


@query(f"WITH {_MATCH}, c AS (SELECT type, page, {_COUNTS} FROM st GROUP BY GROUPING SETS ((), (type), (page))) SELECT * REPLACE (page::VARCHAR AS page), {_SCORE} FROM c")
def report_rollup(spark, sf_dir):
    return M.score_rollup(_status(spark, sf_dir)).withColumn("page", F.col("page").cast("string"))


@query(f"WITH {_MATCH} SELECT doc_id, page, seq, type, substring(content, 1, 300) AS content FROM st WHERE status = 'missed'")
def missed(spark, sf_dir):
    return M.unmatched(_status(spark, sf_dir), "missed")


@query(f"WITH {_MATCH} SELECT doc_id, page, seq, type, substring(content, 1, 300) AS content FROM st WHERE status = 'extra'")
def extra(spark, sf_dir):
    return M.unmatched(_status(spark, sf_dir), "extra")


@query(f"WITH {_MATCH} SELECT doc_id, page, seq, result_seq, type, golden_shape, result_shape FROM m WHERE golden_shape IS DISTINCT FROM result_shape")
def structure_diff(spark, sf_dir):
    g, r, m = _match(spark, sf_dir)
    return M.structure_mismatches(g, r, m).select("doc_id", "page", "seq", "result_seq", "type", "golden_shape", "result_shape")


@query(None)
def greedy_match(spark, sf_dir):
    d = lines(spark, sf_dir)
    r = d.filter(F.col("seq") % 5 != 4).withColumn("content", F.concat(F.lit("x "), "content"))
    return M.greedy_match(M.prepared(d), M.prepared(r))


@query(None)
def text_coverage(spark, sf_dir):
    d = lines(spark, sf_dir)
    g, r = M.prepared(d), M.prepared(d.filter(F.col("seq") % 5 != 4).withColumn("content", F.concat(F.lit("x "), "content")))
    return M.text_coverage(g, r, M.greedy_match(g, r))


@query(None)
def type_breaks(spark, sf_dir):
    d = lines(spark, sf_dir)
    r = d.withColumn("type", F.when(F.col("seq") % 2 == 0, F.when(F.col("type") == "formula", F.lit("paragraph")).otherwise(F.lit("formula"))).otherwise(F.col("type")))
    return M.greedy_match(M.prepared(d), M.prepared(r)).filter("type_break").select("doc_id", "page", "seq")


# ---- golden tools ------------------------------------------------------------------------------------------------------------


@query(f"WITH {LINES_SQL} SELECT doc_id, page, seq, type, md5(content) AS content FROM lines")
def markup_roundtrip(spark, sf_dir):
    return D.from_markup(D.to_markup(lines(spark, sf_dir))).select("doc_id", "page", "seq", "type", F.md5("content").alias("content"))


_FLAT = r"regexp_replace(lower({0}), '[^а-яёa-z0-9]', '', 'g')"


@query(f"WITH {LINES_SQL}, p AS (SELECT doc_id, page, {_FLAT.format('''string_agg(content, ' ' ORDER BY seq)''')} AS hay FROM lines WHERE seq % 4 <> 2 GROUP BY doc_id, page), l AS (SELECT lines.doc_id, page, seq, content, {_FLAT.format('content')} AS needle, coalesce(hay, '') AS hay FROM lines LEFT JOIN p USING (doc_id, page)) SELECT doc_id, page, seq FROM l WHERE needle <> '' AND NOT contains(hay, needle) AND NOT regexp_full_match(trim(content), '[0-9]{{1,2}}')")
def verify_draft_exact(spark, sf_dir):
    d = lines(spark, sf_dir)
    return D.missing_from(d, d.filter(F.col("seq") % 4 != 2), fuzzy=False).select("doc_id", "page", "seq")


@query(f"WITH {LINES_SQL}, p AS (SELECT doc_id, page, {_FLAT.format('''string_agg(content, ' ' ORDER BY seq)''')} AS hay FROM lines WHERE seq % 4 <> 2 GROUP BY doc_id, page), l AS (SELECT lines.doc_id, page, seq, type, content, {_FLAT.format('content')} AS needle, coalesce(hay, '') AS hay FROM lines LEFT JOIN p USING (doc_id, page)) SELECT doc_id, page, seq, type FROM l WHERE length(trim(content)) >= 20 AND needle <> '' AND NOT contains(hay, needle)")
def unsupported_blocks(spark, sf_dir):
    d = lines(spark, sf_dir)
    return D.unsupported(d, d.filter(F.col("seq") % 4 != 2), fuzzy=False).select("doc_id", "page", "seq", "type")


@query(None)
def verify_draft(spark, sf_dir):
    d = lines(spark, sf_dir)
    return D.missing_from(d, d.filter(F.col("seq") % 4 != 2)).select("doc_id", "page", "seq")


@query(None)
def locate_drafts(spark, sf_dir):
    from pagewright.plans.inputs import boxes

    d = boxes(spark, sf_dir)
    return D.locate_drafts(d.select("doc_id", "page", "seq", "content"), d.select("doc_id", "page", F.col("seq").cast("int").alias("line_no"), F.col("content").alias("text"), "bbox"))


_LOSS = LINES_SQL + r""", o AS (SELECT doc_id, page, string_agg(content, ' ' ORDER BY seq) AS t FROM lines GROUP BY doc_id, page), x AS (SELECT doc_id, page, string_agg(content, ' ' ORDER BY seq) AS other FROM lines WHERE seq % 4 <> 2 GROUP BY doc_id, page),
k AS (SELECT DISTINCT doc_id, page, unnest(list_filter(string_split_regex(t, '\s+'), lambda w: w <> '')) AS token FROM o), loss AS (SELECT k.*, NOT coalesce(contains(other, token), false) AS lost FROM k LEFT JOIN x USING (doc_id, page))"""


def _loss(spark, sf_dir):
    d = lines(spark, sf_dir)
    return D.word_loss(D.page_texts(d, "content").withColumnRenamed("all_text", "text"), D.page_texts(d.filter(F.col("seq") % 4 != 2), "content").withColumnRenamed("all_text", "text"))


@query(f"WITH {_LOSS} SELECT doc_id, page, count(*) AS tokens, count(*) FILTER (lost) AS lost, round(count(*) FILTER (lost) / count(*), 3) AS rate FROM loss GROUP BY doc_id, page")
def word_loss_by_page(spark, sf_dir):
    return D.word_loss_by_page(_loss(spark, sf_dir))


@query(f"WITH {_LOSS} SELECT token, count(*) AS n FROM loss WHERE lost AND length(token) > 3 AND NOT regexp_full_match(token, '[0-9]+') GROUP BY token ORDER BY n DESC, token LIMIT 60")
def word_loss(spark, sf_dir):
    return D.word_loss_sample(_loss(spark, sf_dir))


# ---- rendering ---------------------------------------------------------------------------------------------------------------

_ESC = "replace(replace(replace(replace(replace({0}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#x27;')"
_T = _ESC.format("trim(content, ' ' || chr(9) || chr(13))")
_HTML = f"CASE type WHEN 'heading' THEN '<h2>' || {_T} || '</h2>' WHEN 'paragraph' THEN '<p>' || {_T} || '</p>' WHEN 'formula' THEN '<div class=\"formula\">' || {_T} || '</div>' ELSE '<ul' || CASE WHEN regexp_matches(trim(content), '^(?:[0-9]+(?:\\.[0-9]+)+|\\.[0-9]+)\\s') THEN ' class=\"plain\"' ELSE '' END || '>' || CASE WHEN trim(content) = '' THEN '' ELSE '<li>' || {_T} || '</li>' END || '</ul>' END"


@query(f"WITH {LINES_SQL} SELECT doc_id, seq, md5({_HTML}) AS html FROM lines")
def render_block_html(spark, sf_dir):
    return V.block_html(lines(spark, sf_dir)).select("doc_id", "seq", F.md5("html").alias("html"))


@query(f"WITH {LINES_SQL} SELECT doc_id, page AS section, page, md5('<section class=\"page\" id=\"page-' || page || '\" data-page=\"' || page || '\"><div class=\"page-label\"><a href=\"#page-' || page || '\">Страница ' || page || '</a></div>' || string_agg({_HTML}, '' ORDER BY seq) || '</section>') AS html FROM lines GROUP BY doc_id, page")
def render_page_sections(spark, sf_dir):
    return V.page_sections(V.block_html(lines(spark, sf_dir))).select("doc_id", "section", "page", F.md5("html").alias("html"))


@query(f"""WITH {LINES_SQL}, s AS (SELECT doc_id, page, '<section class="page" id="page-' || page || '" data-page="' || page || '"><div class="page-label"><a href="#page-' || page || '">Страница ' || page || '</a></div>' || string_agg({_HTML}, '' ORDER BY seq) || '</section>' AS html FROM lines GROUP BY doc_id, page)
SELECT doc_id, md5('<!DOCTYPE html><html><head><meta charset="utf-8"><title>' || doc_id || '</title></head><body><nav>' || string_agg('<a href="#page-' || page || '">' || page || '</a>', ' ' ORDER BY page) || '</nav>' || string_agg(html, chr(10) ORDER BY page) || '</body></html>') AS html FROM s GROUP BY doc_id""")
def render_document_html(spark, sf_dir):
    return V.document_html(V.block_html(lines(spark, sf_dir))).select("doc_id", F.md5("html").alias("html"))


@query(f"WITH {_MATCH}, c AS (SELECT type, {_COUNTS} FROM st GROUP BY type), x AS (SELECT *, row_number() OVER (ORDER BY doc_id, page, seq) AS n FROM st WHERE status = 'missed') SELECT 1 AS part, row_number() OVER (ORDER BY type) AS n, '| ' || type || ' | ' || golden || ' | ' || result || ' | ' || matched || ' |' AS line FROM c UNION ALL SELECT 2, n, '- p' || page || ' ' || type || ': ' || substring(content, 1, 150) FROM x WHERE n <= 50 UNION ALL SELECT 3, 0, '… and ' || (count(*) - 50) || ' more' FROM x HAVING count(*) > 50")
def report_markdown(spark, sf_dir):
    st = _status(spark, sf_dir)
    return V.markdown_report(M.scores(st, "type"), M.unmatched(st, "missed"))


_CUT = _ESC.format("substring(content, 1, 300)")


@query(f"""WITH {_MATCH}, u AS (SELECT doc_id, page, CASE status WHEN 'missed' THEN 1 ELSE 2 END AS k, seq, '<div class="' || status || '">' || {_CUT} || '</div>' AS h FROM st WHERE status <> 'ok'
UNION ALL SELECT doc_id, page, 3, seq, '<div class="structure">' || concat_ws(' / ', golden_shape, result_shape) || '</div>' FROM m WHERE golden_shape IS DISTINCT FROM result_shape)
SELECT doc_id, page, md5(string_agg(h, '' ORDER BY k, seq, h)) AS html FROM u GROUP BY doc_id, page""")
def diff_html(spark, sf_dir):
    g, r, m = _match(spark, sf_dir)
    st = M.status_rows(g, r, m)
    return V.diff_html(M.unmatched(st, "missed"), M.unmatched(st, "extra"), M.structure_mismatches(g, r, m)).withColumn("html", F.md5("html"))


# ---- JSON and sinks ----------------------------------------------------------------------------------------------------------


@query(f"WITH {LINES_SQL} SELECT doc_id::VARCHAR AS doc_id, page, seq, type, md5(content) AS content FROM lines")
def json_roundtrip(spark, sf_dir):
    j = V.result_json(lines(spark, sf_dir))
    return S.flatten_blocks(j.select(F.col("doc_id").cast("string").alias("doc_id"), S.blocks_of(F.col("json")).alias("blocks"))).select("doc_id", "page", "seq", "type", F.md5("content").alias("content"))


@query("SELECT event_id, json_extract_string(props, '$.k') AS k, len(json_keys(props))::INT AS n_keys FROM events")
def props_extract(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    return e.select("event_id", F.get_json_object("props", "$.k").alias("k"), F.size(F.json_object_keys("props")).alias("n_keys"))


@query("SELECT page_id::VARCHAR AS doc_id, 'page_0001.html' AS file, sha256(html) AS sha256 FROM pages WHERE coalesce(html, '') <> ''")
def page_files(spark, sf_dir):
    return V.page_files(pages(spark, sf_dir)).select("doc_id", "file", "sha256")


@query(f"WITH {LINES_SQL} SELECT doc_id, seq FROM lines WHERE contains(lower(content), 'the ')")
def needle_search(spark, sf_dir):
    return S.find_blocks(lines(spark, sf_dir), "THE ").select("doc_id", "seq")


@query(f"WITH {LINES_SQL}, p AS (SELECT doc_id, page, string_agg(content, ' ' ORDER BY seq) AS t FROM lines GROUP BY doc_id, page) SELECT doc_id, page, md5('== pdf ==' || chr(10) || substring(trim(regexp_replace(t, '\\s+', ' ', 'g')), 1, 6000) || chr(10) || '== html ==' || chr(10) || substring(trim(regexp_replace(t, '\\s+', ' ', 'g')), 1, 6000)) AS dump FROM p")
def page_dump(spark, sf_dir):
    t = D.page_texts(lines(spark, sf_dir), "content").withColumnRenamed("all_text", "text")
    return V.page_dump({"pdf": t, "html": t}).withColumn("dump", F.md5("dump"))
