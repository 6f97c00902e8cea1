"""JSON and text sources, S2-S11."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.functions import geometry as G
from pagewright.operators.enrich import collect_undecoded
from pagewright.schema import DEFAULT_PAGE, PDF_IMAGE, PDF_SPAN
from pagewright.storage import stored

_BOX = "struct<l:double,t:double,r:double,b:double,coord_origin:string>"
METADATA = "source struct<file_name:string,file_hash_sha256:string,page_count:int>, pages array<struct<page:int,width:double,height:double>>, formula_bboxes map<string,array<array<double>>>, generated_at string, html_files array<string>"
LAYOUT = f"texts array<struct<label:string,text:string,prov:array<struct<page_no:int,bbox:{_BOX}>>>>, tables array<struct<prov:array<struct<page_no:int,bbox:{_BOX}>>>>, pages map<string,struct<size:struct<width:double,height:double>>>"
_CELL = "struct<row_number:int,column_number:int,row_span:int,column_span:int,page:int,bbox:array<double>,block:array<struct<content:string>>>"
BLOCKS_JSON = (
    "array<struct<type:string,`page number`:int,`bounding box`:array<double>,content:string,`heading level`:int,list_type:string,items:array<struct<content:string,`bounding box`:array<double>>>,"
    f"columns:array<string>,number_of_rows:int,number_of_columns:int,rows:array<struct<row_number:int,cells:array<{_CELL}>>>,latex:string,image_key:string,_temp_path:string,_enriched:boolean,_rebuilt:boolean>>"
)
MARKUP = "array<struct<t:string,p:int,c:string,b:array<double>,lvl:int,lt:string,items:array<string>,cols:array<string>,rows:array<array<string>>,key:string,latex:string>>"


def _json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", True).option("mode", "PERMISSIVE").json(path)


def page_meta(metadata: DataFrame, doc_id: Column) -> DataFrame:
    """Page sizes."""
    return metadata.select(doc_id.alias("doc_id"), F.explode("pages").alias("p")).select("doc_id", "p.page", "p.width", "p.height")


def undecoded_formulas(metadata: DataFrame, doc_id: Column) -> DataFrame:
    """Boxes of formulas without text, numbered within their page."""
    m = metadata.select(doc_id.alias("doc_id"), F.explode("formula_bboxes").alias("page", "boxes"))
    return m.select("doc_id", F.col("page").cast("int").alias("page"), F.posexplode("boxes").alias("ord", "bbox"))


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    return _json(spark, path, METADATA)


def read_layout(spark: SparkSession, path: str) -> DataFrame:
    """S3: a missing or broken file is an empty table."""
    try:
        return _json(spark, path, LAYOUT)
    except Exception as e:  # the analyser's error for a path that is not there
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], LAYOUT)


def layout_texts(layout: DataFrame) -> DataFrame:
    """S3: texts of layout documents (doc_id, texts, ...): doc_id, page, ord, text, bbox from the bottom left."""
    t = layout.select("doc_id", F.posexplode("texts").alias("ord", "t")).select("doc_id", "ord", "t.text", F.explode("t.prov").alias("p"))
    b = F.col("p.bbox")
    return t.select("doc_id", F.col("p.page_no").alias("page"), F.col("ord").cast("long").alias("ord"), "text", F.array(b["l"], b["t"], b["r"], b["b"]).alias("bbox"))


def layout_tables(layout: DataFrame) -> DataFrame:
    """S3: tables of layout documents: doc_id, page, ord, bbox from the top; heights are those of the document's pages."""
    t = layout.select("doc_id", "pages", F.posexplode("tables").alias("ord", "t")).select("doc_id", "pages", "ord", F.explode("t.prov").alias("p"))
    b, height = F.col("p.bbox"), F.element_at("pages", F.col("p.page_no").cast("string"))["size"]["height"]
    height = F.coalesce(height, F.lit(DEFAULT_PAGE[1]))
    return t.select("doc_id", F.col("p.page_no").alias("page"), F.col("ord").cast("long").alias("ord"), G.from_bottom(F.array(b["l"], b["t"], b["r"], b["b"]), height).alias("bbox"))


def layout_undecoded(layout: DataFrame) -> DataFrame:
    """Boxes of formulas without text, numbered within their page."""
    t = layout.select("doc_id", F.posexplode("texts").alias("ord", "t")).select("doc_id", F.col("ord").cast("long").alias("ord"), "t.label", "t.text", F.explode("t.prov").alias("p"))
    b = F.col("p.bbox")
    boxes = collect_undecoded(t.select("doc_id", "ord", "label", "text", F.col("p.page_no").alias("page"), F.array(b["l"], b["t"], b["r"], b["b"]).alias("bbox")))
    return boxes.select("doc_id", "page", F.posexplode("boxes").alias("ord", "bbox"))


def kept_layout(converted: DataFrame) -> DataFrame:
    """The service's answers, stored, so that no file is sent twice."""
    return stored(converted, "layout")


def layout_metadata(converted: DataFrame, hashes: DataFrame) -> DataFrame:
    """K5: (doc_id, metadata) as JSON in the form that `read_metadata` reads: file name, hash, page sizes, boxes of undecoded formulas."""
    parsed = converted.select("doc_id", F.from_json("layout", LAYOUT).alias("l")).select("doc_id", "l.*")
    sizes = F.array_sort(F.transform(F.map_entries("pages"), lambda e: F.struct(e["key"].cast("int").alias("page"), F.round(e["value"]["size"]["width"], 1).alias("width"), F.round(e["value"]["size"]["height"], 1).alias("height"))))
    boxes = layout_undecoded(parsed).groupBy("doc_id", "page").agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", "bbox"))), lambda x: x["bbox"]).alias("boxes"))
    boxes = boxes.groupBy("doc_id").agg(F.map_from_entries(F.collect_list(F.struct(F.col("page").cast("string"), "boxes"))).alias("formula_bboxes"))
    d = parsed.select("doc_id", sizes.alias("sizes")).join(hashes, "doc_id").join(boxes, "doc_id", "left")
    source = F.struct(F.concat("doc_id", F.lit(".pdf")).alias("file_name"), F.col("sha256").alias("file_hash_sha256"), F.size("sizes").alias("page_count"))
    names = F.transform("sizes", lambda p: F.format_string("page_%04d.html", p["page"]))
    none = F.create_map().cast("map<string,array<array<double>>>")
    return d.select("doc_id", F.to_json(F.struct(source.alias("source"), F.col("sizes").alias("pages"), F.coalesce("formula_bboxes", none).alias("formula_bboxes"), names.alias("html_files"))).alias("metadata"))


def blocks_of(text) -> Column:
    """The block list of a result or golden JSON in any of its five shapes; an unknown shape has none."""
    paths = ("content.document.block", "content.document.kids", "content.block", "block", "kids")
    found = [F.from_json(F.get_json_object(text, f"$.{p}"), BLOCKS_JSON) for p in paths]
    return F.coalesce(*found, F.array().cast(BLOCKS_JSON))


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """Files as (doc_id, blocks exploded with seq)."""
    df = spark.read.option("wholetext", True).text(path)
    name = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)\.json$", 1)
    return flatten_blocks(df.select(name.alias("doc_id"), blocks_of(F.col("value")).alias("blocks")))


def flatten_blocks(df: DataFrame) -> DataFrame:
    """(doc_id, blocks) to a row for each block; a missing page is 1, a missing type 'unknown'."""
    b = df.select("doc_id", F.posexplode("blocks").alias("seq", "b"))
    items = F.transform("b.items", lambda i: F.struct(i["content"].alias("content"), i["bounding box"].alias("bbox")))
    return b.select(
        "doc_id", F.coalesce(F.col("b")["page number"], F.lit(1)).alias("page"), F.col("seq").cast("long").alias("seq"), F.coalesce("b.type", F.lit("unknown")).alias("type"), "b.content", "b.latex",
        F.col("b")["heading level"].alias("heading_level"), "b.list_type", items.alias("items"), "b.columns", "b.number_of_rows", "b.number_of_columns", "b.rows", "b.image_key", F.col("b")["_temp_path"].alias("temp_path"),
        F.col("b")["bounding box"].alias("bbox"), F.col("b")["_enriched"].alias("is_enriched"), F.lit(False).alias("is_where"), F.col("b")["_rebuilt"].alias("is_rebuilt"),
    )


def read_markup(spark: SparkSession, path: str) -> DataFrame:
    """Flat markup lists."""
    df = spark.read.option("wholetext", True).text(path)
    name = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)\.json$", 1)
    return df.select(name.alias("doc_id"), F.posexplode(F.from_json("value", MARKUP)).alias("seq", "m")).select("doc_id", F.col("seq").cast("long").alias("seq"), "m.*")


_QUALITY_BLOCK = "struct<text:string,content:string,level:double,depth:double,bbox:array<double>>"
_QUALITY_PAGE = f"struct<page:int,page_num:int,number:int,blocks:array<{_QUALITY_BLOCK}>>"
_KID = "struct<`page number`:string,page_num:string,page:string,text:string,content:string,level:double,depth:double,bbox:array<double>>"


def quality_pages(text: Column) -> Column:
    """Pages of a quality input; none for any other shape.

    Blocks under `kids` are put together by their page (`page number`, `page_num` or `page`; what is no whole number is left out);
    pages under `pages`, `document`, `content` or `data` are a list, or an object with a page for each key; or the input is a list.
    """
    listed = f"array<{_QUALITY_PAGE}>"
    kids = F.from_json(F.get_json_object(text, "$.kids"), f"array<{_KID}>")
    whole = lambda c: c.try_cast("int")
    number = lambda k: F.coalesce(whole(k["page number"]), whole(k["page_num"]), whole(k["page"]))
    none = F.lit(None).cast("int")
    block = lambda k: F.struct(*[k[c].alias(c) for c in ("text", "content", "level", "depth", "bbox")])
    numbers = F.array_sort(F.array_distinct(F.filter(F.transform(kids, number), lambda n: n.isNotNull())))
    grouped = F.transform(numbers, lambda n: F.struct(n.alias("page"), none.alias("page_num"), none.alias("number"), F.transform(F.filter(kids, lambda k: number(k) == n), block).alias("blocks")))
    found = [F.when(F.size(grouped) > 0, grouped)]
    for p in ("pages", "document", "content", "data"):
        value = F.get_json_object(text, f"$.{p}")
        entries = F.map_entries(F.from_json(value, f"map<string,{_QUALITY_PAGE}>"))
        values = F.transform(F.array_sort(F.transform(entries, lambda e: F.struct(F.coalesce(whole(e["key"]), F.lit(2**31 - 1)).alias("n"), e["key"].alias("k"), e["value"].alias("v")))), lambda e: e["v"])
        values = F.filter(values, lambda v: v["blocks"].isNotNull())
        found += [F.when(F.ltrim(value).startswith("["), F.from_json(value, listed)), F.when(F.ltrim(value).startswith("{") & (F.size(values) > 0), values)]
    return F.coalesce(F.from_json(F.when(F.trim(text).startswith("["), text), listed), *found, F.array().cast(listed))


def find_blocks(blocks: DataFrame, needle: str) -> DataFrame:
    """Blocks whose content has the needle, in any case."""
    return blocks.filter(F.lower("content").contains(needle.lower()))


def read_spans(spark: SparkSession, path: str) -> DataFrame:
    """Spans of text that a PDF library has extracted, as Parquet."""
    return spark.read.schema(PDF_SPAN).parquet(path)


def read_images(spark: SparkSession, path: str) -> DataFrame:
    """S5."""
    return spark.read.schema(PDF_IMAGE).parquet(path)


def convert_with_service(files: DataFrame, url: str, timeout: float, max_pages: int) -> DataFrame:
    """Layout documents from the conversion service for (doc_id, content, n_pages); each task sends its own rows.

    A failed conversion raises; needs a running service.
    """
    import json
    import urllib.request
    import uuid

    import pandas as pd

    def run(batches):
        for pdf in batches:
            out = []
            for doc, content, n in zip(pdf["doc_id"], pdf["content"], pdf["n_pages"], strict=True):
                mark = uuid.uuid4().hex
                fields = {"to_formats": "json", "do_ocr": "false", "table_mode": "accurate", "do_formula_enrichment": "false", "include_images": "true"}
                pages = [("page_range", "1"), ("page_range", str(min(max_pages, int(n))))]
                body = b"".join(f'--{mark}\r\nContent-Disposition: form-data; name="{k}"\r\n\r\n{v}\r\n'.encode() for k, v in [*fields.items(), *pages])
                body += f'--{mark}\r\nContent-Disposition: form-data; name="files"; filename="{doc}.pdf"\r\nContent-Type: application/pdf\r\n\r\n'.encode() + content + f"\r\n--{mark}--\r\n".encode()
                request = urllib.request.Request(f"{url}/v1/convert/file", data=body, headers={"Content-Type": f"multipart/form-data; boundary={mark}"})
                with urllib.request.urlopen(request, timeout=timeout) as r:
                    answer = json.load(r)
                layout = (answer.get("document") or {}).get("json_content")
                if answer.get("status") == "failure" or not layout:
                    raise RuntimeError(f"conversion of {doc} failed")
                out.append((doc, json.dumps(layout, ensure_ascii=False)))
            yield pd.DataFrame(out, columns=["doc_id", "layout"])

    return files.mapInPandas(run, "doc_id string, layout string")
