"""The block table and the tables around it, as DDL."""

from __future__ import annotations

BLOCK = (
    "doc_id string, page int, seq long, type string, content string, latex string, heading_level int, list_type string, "
    "items array<struct<content:string,bbox:array<double>>>, columns array<string>, number_of_rows int, number_of_columns int, "
    "rows array<struct<row_number:int,cells:array<struct<row_number:int,column_number:int,row_span:int,column_span:int,page:int,bbox:array<double>,block:array<struct<content:string>>>>>>, "
    "image_key string, temp_path string, bbox array<double>, is_enriched boolean, is_where boolean, is_rebuilt boolean"
)
PAGE_HTML = ("doc_id string, page int, html string")
PAGE_META = ("doc_id string, page int, width double, height double")
PDF_SPAN = (
    "doc_id string, page int, block_no int, line_no int, span_no int, text string, font string, size double, "
    "line_x0 double, line_y0 double, line_x1 double, line_y1 double, block_bbox array<double>"
)
PDF_IMAGE = ("doc_id string, page int, ord int, bbox array<double>, bytes binary")
#: Page size where no metadata gives one, in points.
DEFAULT_PAGE = (595.0, 842.0)
EMPTY_BOX = [0.0, 0.0, 0.0, 0.0]
