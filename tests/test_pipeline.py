import json

from pagewright.operators import render
from pagewright.plans import pipeline
from pagewright.sources import files, html
from pagewright.streaming import pages as stream

PAGE = "<div class='page'><h2>ОБЩИЕ ПОЛОЖЕНИЯ</h2><p>Судно должно иметь класс.</p><ul><li>первый;</li><li>второй.</li></ul></div>"


def saved(tmp_path):
    d = tmp_path / "in" / "doc"
    d.mkdir(parents=True)
    for k in (1, 2):
        (d / f"page_{k:04d}.html").write_text(PAGE.replace("класс", f"класс {k}"))
    return str(tmp_path / "in")


def test_parse_and_compare(spark, tmp_path):
    spans = spark.createDataFrame([("doc", 1, 0, 0, 0, "Новая строка из документа.", "Arial", 10.0, 1.0, 2.0, 3.0, 4.0, None)], "doc_id string, page int, block_no int, line_no int, span_no int, text string, font string, size double, line_x0 double, line_y0 double, line_x1 double, line_y1 double, block_bbox array<double>")
    p = pipeline.parse(html.read_pages(spark, saved(tmp_path)), spans=spans)
    texts = [r["content"] for r in p.blocks.orderBy("seq").collect()]
    assert "Новая строка из документа." in texts and "Судно должно иметь класс 2." in texts
    assert p.documents.first()["pages_processed"] == 2
    r = pipeline.compare_documents(p.blocks, p.blocks)
    s = r.summary.first()
    assert (s["precision"], s["recall"], s["f1"]) == (1.0, 1.0, 1.0) and r.structure.count() == 0
    j = json.loads(render.result_json(p.blocks, p.documents).first()["json"])
    assert len(j["content"]["document"]["block"]) == len(texts)
    assert "<section" in render.document_html(render.block_html(p.blocks)).first()["html"]


def test_result_shapes(spark):
    b = [{"type": "paragraph", "content": "x", "page number": 2}]
    shapes = [{"block": b}, {"kids": b}, {"content": {"block": b}}, {"content": {"document": {"block": b}}}, {"content": {"document": {"kids": b}}}, {"other": b}]
    df = spark.createDataFrame([(json.dumps(s),) for s in shapes], "t string").select(files.blocks_of("t").alias("b"))
    assert [len(r["b"]) for r in df.collect()] == [1, 1, 1, 1, 1, 0]


def test_stream(spark, tmp_path):
    got = []
    q = stream.score_each_batch(stream.newest(stream.read(spark, saved(tmp_path))), lambda df, _: got.extend(df.collect()), str(tmp_path / "checkpoint"))
    q.awaitTermination(120)
    assert len(got) == 2


def test_missing_folder(spark, tmp_path):
    import pytest

    (tmp_path / "none").mkdir()
    with pytest.raises(FileNotFoundError):
        html.read_pages(spark, str(tmp_path / "none"))


def test_images_layout_and_overlay(spark, tmp_path):
    """Image blocks are bound, formula-sized images become formulas, files are written, layout boxes and tables are used."""
    page = "<div class='page'><p>Первый абзац текста.</p><figure></figure><table><tr><td>1</td></tr></table></div>"
    pages = spark.createDataFrame([("doc", 1, page)], "doc_id string, page int, html string")
    images = spark.createDataFrame([("doc", 1, 0, [0.0, 0.0, 500.0, 50.0], b"png0"), ("doc", 1, 1, [100.0, 300.0, 200.0, 350.0], b"png1"), ("doc", 1, 2, [1.0, 1.0, 2.0, 2.0], None)], "doc_id string, page int, ord int, bbox array<double>, bytes binary")
    texts = spark.createDataFrame([("doc", 1, 0, "Первый абзац текста.", [10.0, 800.0, 90.0, 780.0])], "doc_id string, page int, ord long, text string, bbox array<double>")
    tables = spark.createDataFrame([("doc", 1, 0, [1.0, 2.0, 3.0, 4.0])], "doc_id string, page int, ord long, bbox array<double>")
    p = pipeline.parse(pages, images=images, layout_texts=texts, layout_tables=tables, image_folder=f"file://{tmp_path}/images")
    got = {(r["type"], r["content"] or ""): r for r in p.blocks.collect()}
    assert got["paragraph", "Первый абзац текста."]["bbox"] == [10.0, 42.0, 90.0, 62.0]
    assert [r["bbox"] for r in p.blocks.filter("type = 'table'").collect()] == [[1.0, 2.0, 3.0, 4.0]]
    assert [r["image_key"] for r in p.blocks.filter("type = 'image'").orderBy("seq").collect()] == ["page_1_1.png", "page_1_2.png"]
    assert (tmp_path / "images" / "doc" / "page_1_1.png").read_bytes() == b"png0"


def test_formula_images(spark):
    from pagewright.operators import enrich as E

    b = spark.createDataFrame([("d", 2, 0, "paragraph", "x", None, None, [100.0, 300.0, 200.0, 350.0])], "doc_id string, page int, seq long, type string, content string, image_key string, temp_path string, bbox array<double>")
    images = spark.createDataFrame([("d", 1, 0, [100.0, 300.0, 200.0, 350.0], b"a"), ("d", 1, 1, [300.0, 500.0, 380.0, 540.0], b"b"), ("d", 1, 2, [0.0, 0.0, 590.0, 800.0], b"c")], "doc_id string, page int, ord int, bbox array<double>, bytes binary")
    sizes = spark.createDataFrame([("d", 1, 595.0, 842.0)], "doc_id string, page int, width double, height double")
    found = E.image_candidates(images, sizes)
    assert [r["ord"] for r in E.formula_images(found, b).collect()] == [1]  # a box of another page counts
    assert [r["ord"] for r in E.formula_images(found, b, page_aware=True).orderBy("ord").collect()] == [0, 1]
    out = E.inject_formulas(b, E.formula_images(found, b)).orderBy("seq").collect()
    assert [(r["seq"], r["type"], r["image_key"]) for r in out] == [(0, "paragraph", None), (1, "formula", "formula_p1_1.png")]


def test_report_has_all_sections(spark):
    b = [("d", 1, i, "paragraph", f"line number {i} of the text") for i in range(60)]
    schema = "doc_id string, page int, seq long, type string, content string"
    r = pipeline.compare_documents(spark.createDataFrame(b, schema), spark.createDataFrame([("d", 2, 0, "heading", "other")], schema))
    lines = [x["line"] for x in render.full_report(r.summary, r.by_type, r.by_page, r.missed, r.extra).orderBy("part", "n").collect()]
    assert [x for x in lines if x.startswith("## ")] == ["## Summary", "## By type", "## By page", "## Missed", "## Extra"]
    assert "| paragraph | 60 | 0 | 0 | 0.0 | 0.0 | 0.0 |" in lines and "… and 10 more" in lines and "- p2 heading: other" in lines


def test_conversion_by_a_service(spark, tmp_path):
    """Against a server of our own that answers with a fixed layout document."""
    import threading
    from http.server import BaseHTTPRequestHandler, HTTPServer

    layout = {"texts": [{"label": "formula", "text": "", "prov": [{"page_no": 1, "bbox": {"l": 1.04, "t": 90.0, "r": 3.0, "b": 80.0}}]}, {"label": "text", "text": "абв", "prov": [{"page_no": 1, "bbox": {"l": 1.0, "t": 70.0, "r": 3.0, "b": 60.0}}]}], "tables": [{"prov": [{"page_no": 1, "bbox": {"l": 1.0, "t": 50.0, "r": 3.0, "b": 40.0}}]}], "pages": {"1": {"size": {"width": 100.04, "height": 100.0}}}}

    class Answer(BaseHTTPRequestHandler):
        def do_POST(self):
            body = self.rfile.read(int(self.headers["Content-Length"]))
            ok = b"%PDF good" in body and b'name="page_range"' in body
            data = json.dumps({"status": "success", "document": {"json_content": layout}} if ok else {"status": "failure"}).encode()
            self.send_response(200)
            self.end_headers()
            self.wfile.write(data)

        def log_message(self, *_):
            pass

    server = HTTPServer(("127.0.0.1", 0), Answer)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    url = f"http://127.0.0.1:{server.server_port}"
    pdf = spark.createDataFrame([("doc", bytearray(b"%PDF good"), 3)], "doc_id string, content binary, n_pages int")
    got = files.kept_layout(files.convert_with_service(pdf, url, 10.0, 2))
    meta = json.loads(files.layout_metadata(got, spark.createDataFrame([("doc", "abc")], "doc_id string, sha256 string")).first()["metadata"])
    assert meta["source"] == {"file_name": "doc.pdf", "file_hash_sha256": "abc", "page_count": 1} and meta["pages"] == [{"page": 1, "width": 100.0, "height": 100.0}]
    assert meta["formula_bboxes"] == {"1": [[1.0, 90.0, 3.0, 80.0]]} and meta["html_files"] == ["page_0001.html"]
    (tmp_path / "doc.json").write_text(json.dumps(layout))
    read = files.read_layout(spark, str(tmp_path)).selectExpr("'doc' as doc_id", "*")
    assert [(r["text"], r["bbox"]) for r in files.layout_texts(read).orderBy("ord").collect()] == [("", [1.04, 90.0, 3.0, 80.0]), ("абв", [1.0, 70.0, 3.0, 60.0])]
    assert files.layout_tables(read).first()["bbox"] == [1.0, 50.0, 3.0, 60.0]
    bad = spark.createDataFrame([("doc", bytearray(b"other"), 3)], "doc_id string, content binary, n_pages int")
    try:
        files.convert_with_service(bad, url, 10.0, 2).collect()
        raise AssertionError("a failed conversion must raise")
    except Exception as e:
        assert "conversion of doc failed" in str(e)
    server.shutdown()
    assert files.read_layout(spark, str(tmp_path / "absent")).count() == 0


def test_quality_inputs(spark):
    block = {"text": "a", "level": 1.0}
    page = {"page": 2, "blocks": [block]}
    shapes = [[page], {"pages": [page]}, {"data": {"10": {"page": 10, "blocks": []}, "2": page}}, {"kids": [{"page number": 3, "content": "x"}, {"page_num": "1", "content": "y"}, {"page": "3", "content": "z"}, {"page": "no"}]}, {"other": 1}, {"content": "text"}]
    df = spark.createDataFrame([(i, json.dumps(s)) for i, s in enumerate(shapes)] + [(9, "broken {")], "i int, t string")
    got = {r["i"]: [(p["page"], [b["text"] or b["content"] for b in p["blocks"]]) for p in r["p"]] for r in df.select("i", files.quality_pages(df["t"]).alias("p")).collect()}
    assert got[0] == got[1] == [(2, ["a"])] and got[2] == [(2, ["a"]), (10, [])] and got[3] == [(1, ["y"]), (3, ["x", "z"])] and got[4] == got[5] == got[9] == []
