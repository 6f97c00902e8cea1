import random

import pytest

from pagewright.operators import cleanup as C
from pagewright.operators import compare as M
from pagewright.operators import quality as Q
from pagewright.operators import rewrite as R
from pagewright.operators import tables as T
from pagewright.sources import html as H

SCHEMA = "doc_id string, page int, seq long, type string, content string, latex string, image_key string, bbox array<double>, is_enriched boolean, is_rebuilt boolean, heading_level int"
ZERO = [0.0] * 4


def blocks(spark, *rows, **more):
    out = []
    for i, r in enumerate(rows):
        d = {"page": 1, "latex": None, "image_key": None, "bbox": ZERO, "is_enriched": False, "is_rebuilt": False, "heading_level": None} | (r[2] if len(r) > 2 else {})
        out.append(("d", d["page"], i, r[0], r[1], d["latex"], d["image_key"], d["bbox"], d["is_enriched"], d["is_rebuilt"], d["heading_level"]))
    return spark.createDataFrame(out, SCHEMA)


def shown(df):
    return [(r["type"], r["content"]) for r in df.orderBy("seq").collect()]


P, FO = "paragraph", "formula"


def test_html_parser():
    page = "<div class='page'><h2> A </h2>x<p>one<p>two</p><ul><li>I - a</li><li> </li></ul><ol><li>b</li></ol><table><tr><th>h</th><th></th></tr><tr><td>1</td></tr></table><figure class='formula'>f</figure><figure><figcaption>cap</figcaption></figure><script>'</p>'</script></div><p>out</p>"
    got = [(b["kind"], b.get("text"), b.get("items"), b.get("rows")) for b in H.parse_page(page)]
    assert got == [("heading", "A", None, None), (P, "one", None, None), (P, "two", None, None), (P, "I - a", None, None), ("list", None, ["b"], None), ("table", None, None, [["h", ""], ["1"]]), (FO, "f", None, None), ("image", "", None, None), (P, "cap", None, None)]
    assert H.parse_page(None) == [] and H.parse_page("") == []
    assert [b["kind"] for b in H.parse_page('<div class="page"><div class="formula-not-decoded">x</div></div>')] == [FO]
    assert H.parse_page("<div class='page'><ul><li>a<ul><li>b</li></ul>tail</li></ul></div>")  # never an error


def test_tables(spark):
    pages = spark.createDataFrame([("d", 1, "<div class='page'><table><tr><th>a</th><th>b</th></tr><tr><th></th><th>c</th></tr><tr><td>1</td></tr></table><table><tr><td>x</td></tr></table></div>")], "doc_id string, page int, html string")
    t = H.typed_blocks(H.raw_blocks(pages)).orderBy("seq").collect()
    assert t[0]["columns"] == ["a", "c"] and t[0]["number_of_rows"] == 1 and t[0]["number_of_columns"] == 2
    assert [c["block"][0]["content"] for c in t[0]["rows"][0]["cells"]] == ["1", ""] and t[0]["rows"][0]["row_number"] == 3
    assert t[1]["columns"] == [] and t[1]["number_of_rows"] == 1
    assert T.structured


def test_splits(spark):
    b = blocks(spark, (P, "Изолированы. 8.1.2 Изоляция плит 8.1.3 Кровля"), (P, "x = 1, где x шум"), (P, "Угол 5°. = 0, если мало"))
    assert shown(R.split_merged(b))[:3] == [(P, "Изолированы."), (P, "8.1.2 Изоляция плит"), (P, "8.1.3 Кровля")]
    assert (FO, "x = 1") in shown(R.split_formula_where(b)) and (P, "где x шум") in shown(R.split_formula_where(b))
    assert shown(R.split_zero_if(b))[-2:] == [(P, "Угол 5°."), (P, "= 0, если мало")]


def fold(rows):
    out = []
    for kind, text in rows:
        t = text.strip()
        if out and t and kind in (P, FO, "list") and out[-1][0] in (P, FO, "list") and not out[-1][1].rstrip()[-1:] in tuple(".!?;:") and t[:1] in "=)":
            out[-1] = (out[-1][0], out[-1][1].rstrip() + " " + t)
        else:
            out.append((kind, text))
    return out


def test_merge_fragments_equals_fold(spark):
    rng = random.Random(1)
    rows = [(rng.choice([P, FO, "heading"]), rng.choice(["= a", ") b", "text", "end.", "", "x;"])) for _ in range(120)]
    assert shown(R.merge_fragments(blocks(spark, *rows))) == fold(rows)


def test_dedup_and_types(spark):
    b = blocks(spark, (P, "Same"), (P, " same "), (P, ""), (P, ""), ("heading", "ИТОГ 1"), (P, "a ≤ b"), (FO, "если мало"), (P, "12 - 3/4"))
    assert shown(R.dedup_keep_last(b))[:3] == [(P, " same "), (P, ""), (P, "")]
    once = R.dedup_keep_last(b)
    assert shown(R.dedup_keep_last(once)) == shown(once)
    assert ("heading", "ИТОГ") in shown(R.trim_heading_suffix(b))
    assert (FO, "a ≤ b") in shown(R.retype_formula(b)) and (P, "если мало") in shown(R.demote_formula(b))
    assert (P, "12 - 3/4") not in shown(R.drop_numeric(b))


@pytest.mark.parametrize(("overlap", "merged"), [(0.5, False), (0.51, True)])
def test_geometry_merge(spark, overlap, merged):
    b = blocks(spark, (FO, "a", {"bbox": [0.0, 0.0, 5.0, 10.0]}), (FO, "b", {"bbox": [9.0, 10.0 - overlap, 20.0, 30.0]}))
    assert shown(C.merge_by_geometry(b)) == ([(FO, "a b")] if merged else [(FO, "a"), (FO, "b")])


def test_tails_keep_earlier_paragraph(spark):
    box = {"bbox": [0.0, 0.0, 5.0, 10.0]}
    right = {"bbox": [6.0, 0.0, 9.0, 10.0]}
    assert shown(C.formula_tails(blocks(spark, (FO, "f", box), (P, "для a", right)))) == [(FO, "f для a")]
    assert shown(C.formula_tails(blocks(spark, (P, "для a", right), (FO, "f", box)))) == [(P, "для a"), (FO, "f для a")]


def test_paragraph_merge(spark):
    assert shown(C.merge_broken_paragraphs(blocks(spark, (P, "Плотность всей"), (P, "системы.")))) == [(P, "Плотность всей системы.")]
    assert shown(C.merge_broken_paragraphs(blocks(spark, (P, "Приточные"), (P, "10.1.13 жилые")))) == [(P, "10.1.13 Приточные жилые")]
    lost = blocks(spark, (P, "8.1.3 по"), (P, "8.1.4 и 8"))
    assert shown(C.merge_broken_paragraphs(lost)) == [(P, "8.1.3 по")]
    assert shown(C.merge_broken_paragraphs(lost, parity=False)) == [(P, "8.1.3 по"), (P, "8.1.4 и 8")]


def test_zero_rebuild_keeps_images(spark):
    b = blocks(spark, (P, "= 0, если мало"), (FO, "s1 грузовых судов.", {"image_key": "k"}))
    assert shown(C.rebuild_zero(b)) == [(P, "= 0, если мало"), (FO, "s1 грузовых судов.")]


def test_blank_formula_has_no_content(spark):
    b = M.prepared(blocks(spark, (FO, "  "), (FO, "x"), (FO, None, {"image_key": "k"})))
    assert [r["shape"] for r in b.orderBy("seq").collect()] == ["false,false", "true,false", "false,true"]


def test_table_text_is_not_missing(spark):
    """A table's cells and column names are text of its page: PDF lines with them are not appended again."""
    from pagewright.operators import enrich as E

    table = "array(named_struct('cells', array(named_struct('block', array(named_struct('content', 'cell one'))))))"
    b = blocks(spark, (P, "text"), ("table", "")).selectExpr("*", f"case when type = 'table' then {table} end as rows", "case when type = 'table' then array('Column two', '') end as columns")
    lines = spark.createDataFrame([("d", 1, i, t) for i, t in enumerate(["Cell one", "column two", "text", "absent"])], "doc_id string, page int, seq long, text string")
    assert [r["text"] for r in E.missing_lines(lines, E.page_text(b)).collect()] == ["absent"]


def test_zero_rebuild_and_where(spark):
    assert shown(C.rebuild_zero(blocks(spark, (P, "= 0, если мало"), (FO, "s1 грузовых судов.")))) == [(FO, "s1 = 0"), (P, "если мало грузовых судов.")]
    assert shown(C.where_reassembly(blocks(spark, (P, "где"), (FO, "Np"), (P, "— число")))) == [(P, "где Np — число")]


@pytest.mark.parametrize(
    ("rows", "left"),
    [
        ([(P, "abcdefghijkl", {"is_enriched": True}), (P, "abcdefghijkl and quite some more")], 1),
        ([(P, "abcdefghijk", {"is_enriched": True}), (P, "abcdefghijk and quite some more")], 2),
        ([(P, "abcdefghijkl"), (P, "abcdefghijkl and quite some more")], 2),
        ([(P, "one two three four five", {"is_enriched": True}), (P, "two one three four five")], 1),
        ([(FO, "a-b);"), (FO, "a−b")], 1),
        ([(FO, "4);"), (P, "где C = 12 + 4);")], 1),
        ([(FO, "θr -"), (FO, "θr= θg")], 1),
        ([(P, "Same"), (P, "same"), (P, ""), (P, "")], 3),
    ],
)
def test_fragments(spark, rows, left):
    assert C.drop_fragments(blocks(spark, *rows)).count() == left


def test_captions(spark):
    im = lambda y, k: ("image", "", {"bbox": [0.0, y - 10, 9.0, y], "image_key": k})
    cap = lambda y: (P, "Рис. 1.2-3", {"bbox": [0.0, y, 9.0, y + 5]})
    b = blocks(spark, cap(98.0), im(100.0, "a"), im(300.0, "b"), (P, "x"), cap(297.9))
    assert [r["image_key"] or r["content"] for r in C.place_captions(b).orderBy("seq").collect()] == ["a", "Рис. 1.2-3", "b", "x", "Рис. 1.2-3"]


def test_regroup(spark):
    b = blocks(spark, (P, "a", {"page": 2}), (P, "b", {"page": 1}), (P, "c", {"page": 2}))
    assert [t for _, t in shown(C.regroup_pages(b))] == ["a", "c", "b"]


def test_compare_self_and_threshold(spark):
    b = blocks(spark, (P, "один два три"), ("heading", "ИТОГ", {"heading_level": 2}), ("image", "", {"image_key": "k"}), (P, ""))
    g = M.prepared(b)
    m = M.greedy_match(g, M.prepared(b))
    assert sorted(r["result_seq"] for r in m.filter("result_seq is not null").collect()) == [0, 1, 2]
    assert M.text_coverage(g, g, m).first()["coverage"] == 1.0
    other = M.prepared(blocks(spark, ("table", "один два три"), (P, "совсем иное")))
    assert M.greedy_match(g, other).filter("type_break").count() == 0  # a table's text is its cells
    wrong = M.prepared(blocks(spark, (FO, "один два три")))
    assert [r["seq"] for r in M.greedy_match(g, wrong).filter("type_break").collect()] == [0]


def test_quality_of_empty_page(spark):
    r = Q.page_quality(blocks(spark, (P, ""))).first()
    assert r["text_length"] == 0 and r["is_problematic"]


def test_partition_count_does_not_matter(spark):
    rows = [(P, f"= {i}" if i % 3 else f"text {i}") for i in range(40)]
    b = blocks(spark, *rows)
    assert shown(R.merge_fragments(b.repartition(7))) == shown(R.merge_fragments(b.coalesce(1)))


def test_enrichment_reads_the_lines_once(spark):
    """What tells missing lines is dear; it was in the plan four times."""
    from pagewright.operators import enrich as E

    lines = spark.createDataFrame([(1, 1, 0, i, t, [0.0, 10.0 * i, 50.0, 10.0 * i + 8], 0.0) for i, t in enumerate(["held text", "a = b + c", "(1.2)", "lost words of a line,", "its other half, longer than that"])], "doc_id long, page int, block_no int, line_no int, text string, bbox array<double>, math_share double")
    held = spark.createDataFrame([(1, 1, 0, "paragraph", "held text", [0.0] * 4, False)], "doc_id long, page int, seq long, type string, content string, bbox array<double>, is_enriched boolean")
    out = E.enriched(held, lines)
    assert [(r["seq"], r["type"], r["content"], r["is_enriched"]) for r in out.orderBy("seq").collect()] == [(0, P, "held text", False), (1, FO, "a = b + c (1.2)", False), (2, P, "lost words of a line, its other half, longer than that", True)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("page_flat") and plan.count("AS page_flat#") <= 2
