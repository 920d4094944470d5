"""Column types of the engine's tables and the values of its enumerated columns."""

from __future__ import annotations

from pyspark.sql import types as T

# The enumerated columns.
DOCUMENT_TYPES = ("pdf", "docx", "xlsx", "pptx", "txt", "unknown")
SEGMENT_TYPES = ("text", "visual", "table", "metadata")
HEADINGS = ("heading_1", "heading_2", "heading_3", "title", "subtitle")
TEXT_SUBTYPES = ("paragraph", *HEADINGS, "caption", "quote", "list", "footnote", "code", "link")
VISUAL_TYPES = ("image", "chart", "diagram", "graph", "table_image", "screenshot", "drawing", "map", "figure", "formula", "table", "unknown_visual")
CHUNK_TYPES = ("content", "visual_context", "metadata", "hybrid", "table_data", "code_block")
GROUP_TYPES = ("section", "topic", "visual_unit", "page_range", "slide_set", "sheet_group", "heading_hierarchy")
STATUSES = ("pending", "processing", "completed", "failed", "skipped")
FALLBACK_REASONS = ("low_confidence", "parsing_error", "incomplete_data", "hallucination_detected", "critical_document", "diagram_type")

# What a type name of older data means as (type, subtype); other names are text with the name as subtype.
LEGACY_TYPES = {
    "text": ("text", "paragraph"), "paragraph": ("text", "paragraph"), "heading": ("text", "heading_1"), "heading_1": ("text", "heading_1"), "heading_2": ("text", "heading_2"), "heading_3": ("text", "heading_3"),
    "header_1": ("text", "heading_1"), "header_2": ("text", "heading_2"), "header_3": ("text", "heading_3"), "title": ("text", "title"), "subtitle": ("text", "subtitle"), "caption": ("text", "caption"),
    "quote": ("text", "quote"), "list": ("text", "list"), "footnote": ("text", "footnote"), "code": ("text", "code"), "table": ("table", "data"), "data_row": ("table", "data"), "header_row": ("table", "header"),
    "data_range": ("table", "data"), "sheet_header": ("metadata", "sheet"), "slide": ("metadata", "slide"), "slide_notes": ("text", "footnote"), "image": ("visual", "image"), "chart": ("visual", "chart"),
    "diagram": ("visual", "diagram"), "formula": ("visual", "formula"),
}

SEGMENTS = T.StructType(
    [
        T.StructField("document_id", T.StringType()),
        T.StructField("segment_index", T.IntegerType()),
        T.StructField("page_number", T.IntegerType()),
        T.StructField("segment_type", T.StringType()),
        T.StructField("segment_subtype", T.StringType()),
        T.StructField("content", T.StringType()),
    ]
)
TRIPLES = T.StructType([T.StructField(n, T.StringType()) for n in ("subject", "predicate", "object")] + [T.StructField("confidence", T.DoubleType())])
