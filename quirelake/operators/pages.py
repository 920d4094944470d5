"""Pages that a document model or a text extractor read: their tables, texts and images as segments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quirelake.functions import text as fx
from quirelake.operators import visuals as vis
from quirelake.operators.intervals import merge_spans, outside

#: Pages of a document that are read at most, where a limit is asked for.
MAX_PAGES = 20
# The type and subtype of each element tag of a page; other tags are paragraphs.
TAG_TYPES = {
    "text": ("text", "paragraph"), "paragraph": ("text", "paragraph"), "heading": ("text", "heading_1"), "title": ("text", "title"), "subtitle": ("text", "subtitle"), "caption": ("text", "caption"), "list": ("text", "list"),
    "footnote": ("text", "footnote"), "code": ("text", "code"), "table": ("table", "data"), "figure": ("visual", "image"), "image": ("visual", "image"), "chart": ("visual", "chart"), "diagram": ("visual", "diagram"), "formula": ("visual", "formula"),
}


def tag_type(tag: Column) -> tuple[Column, Column]:
    """``(type, subtype)`` of an element tag in any case."""
    low = F.lower(tag)
    kinds, subtypes = (F.create_map(*(F.lit(x) for k, v in TAG_TYPES.items() for x in (k, v[n]))) for n in (0, 1))
    return F.coalesce(F.try_element_at(kinds, low), F.lit("text")), F.coalesce(F.try_element_at(subtypes, low), F.lit("paragraph"))


def grid(content: Column) -> Column:
    """The cells of a table written in lines with bars, as an array of rows; blank lines give rows of one empty cell."""
    return F.transform(F.split(content, "\n"), lambda line: F.split(line, r"\|"))


def table_text(rows: Column) -> Column:
    """``struct(headers, data_rows, row_count, formatted)`` of an extracted table; null with fewer than two rows that are not empty.

    Cells lose white space around and doubled inside, null cells are empty, rows
    of empty cells go. The first row is the header; the formatted text has a
    rule of hyphens below it.
    """
    clean = F.transform(F.coalesce(rows, F.array().cast("array<array<string>>")), lambda r: F.transform(F.coalesce(r, F.array().cast("array<string>")), lambda c: F.coalesce(fx.clean_value(c), F.lit(""))))
    kept = F.filter(clean, lambda r: F.exists(r, lambda c: c != ""))
    lines = F.transform(kept, lambda r: F.array_join(r, " | "))
    head = F.try_element_at(lines, F.lit(1))
    formatted = F.array_join(F.concat(F.slice(lines, 1, 1), F.array(F.repeat(F.lit("-"), F.length(head))), F.slice(lines, F.lit(2), F.greatest(F.size(lines), F.lit(1)))), "\n")
    out = F.struct(F.try_element_at(kept, F.lit(1)).alias("headers"), F.slice(kept, F.lit(2), F.greatest(F.size(kept), F.lit(1))).alias("data_rows"), (F.size(kept) - 1).alias("row_count"), formatted.alias("formatted"))
    return F.when((F.size(rows) >= 2) & (F.size(kept) >= 2), out)


def page_tables(pages: DataFrame) -> DataFrame:
    """``(page_id, table_no, headers, data_rows, row_count, formatted)`` of the tables of all pages that are tables indeed."""
    rows = pages.select("page_id", F.posexplode("tables").alias("table_no", "t")).withColumn("g", grid(F.col("t.content")))
    return rows.select("page_id", "table_no", table_text(F.col("g")).alias("t")).where("t IS NOT NULL").select("page_id", "table_no", "t.*")


def row_position(text: Column, cells: Column) -> Column:
    """The 1-based place in ``text`` of the first two neighbouring cells of a row that stand there with only white space between; 0 if none do."""
    filled = F.filter(F.transform(cells, fx.strip), lambda c: F.coalesce(c, F.lit("")) != "")
    quoted = F.transform(filled, lambda c: F.concat(F.lit("\\Q"), F.replace(c, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E")))
    pairs = F.zip_with(F.slice(quoted, F.lit(1), F.greatest(F.size(quoted) - 1, F.lit(0))), F.slice(quoted, F.lit(2), F.greatest(F.size(quoted) - 1, F.lit(0))), lambda a, b: F.concat(a, F.lit(r"\s*"), b))
    # Where the pair is found is what stands before it; the pattern of a pair is one of the row's own, so it is made for each row.
    found = F.filter(F.transform(pairs, lambda p: F.regexp_instr(text, p)), lambda at: at > 0)
    return F.coalesce(F.try_element_at(found, F.lit(1)), F.lit(0))


def table_spans(texts: DataFrame, tables: DataFrame, key: str, text_col: str) -> DataFrame:
    """``(key, start_pos, end_pos)``: where tables ``(key, rows)`` stand in the raw texts, overlapping ones made one; 0-based, end exclusive.

    A table reaches from its first row to the end of the line in which its last
    row begins. Tables of which either row is not found are left out.
    """
    rows = tables.where(F.size("rows") > 0).select(key, F.element_at("rows", 1).alias("_a"), F.element_at("rows", -1).alias("_b")).join(texts.select(key, F.col(text_col).alias("_t")), key)
    first = rows.withColumn("_s", row_position(F.col("_t"), F.col("_a"))).where("_s > 0")
    last = first.withColumn("_l", row_position(F.substring(F.col("_t"), F.col("_s"), F.length("_t")), F.col("_b"))).where("_l > 0").withColumn("_e", F.col("_s") + F.col("_l") - 1)
    end = F.expr("locate('\\n', _t, _e)")
    spans = last.select(key, (F.col("_s") - 1).alias("start_pos"), F.when(end > 0, end - 1).otherwise(F.col("_e") - 1).cast("int").alias("end_pos"))
    return merge_spans(spans, key)


def separated_segments(texts: DataFrame, tables: DataFrame, key: str, text_col: str, least: int = 50) -> DataFrame:
    """``(key, segment_no, segment_type, content, row_count)``: the text outside of tables, if longer than ``least``, then each table.

    ``tables`` has ``key``, ``table_no`` and ``rows``; a table's content is its
    rows as text.
    """
    parts = outside(texts, table_spans(texts, tables, key, text_col), key, text_col).withColumn("content", fx.strip(F.col("content"))).where("content <> ''")
    # The parts of one text, which is a row of its own.
    pure = parts.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start_pos", "content"))), lambda x: x["content"]), "\n\n").alias("content")).where(F.length("content") > least)
    lines = F.array_join(F.transform("rows", lambda r: F.array_join(r, " | ")), "\n")
    listed = tables.select(key, (F.col("table_no") + 1).alias("segment_no"), F.lit("table").alias("segment_type"), lines.alias("content"), F.size("rows").alias("row_count"))
    return pure.select(key, F.lit(0).alias("segment_no"), F.lit("text").alias("segment_type"), "content", F.lit(0).alias("row_count")).unionByName(listed)


def page_segments(pages: DataFrame, max_pages: int | None = None) -> DataFrame:
    """The segments of extracted pages: ``(page_id, document_id, page_number, part_no, segment_type, segment_subtype, content)``.

    Texts are cut at blank lines, then come tables, then a placeholder for each
    image with its caption, then formulas. Empty parts give none. With
    ``max_pages`` only pages up to that number.
    """
    rows = pages if max_pages is None else pages.where(F.col("page_number") <= max_pages)
    none = F.array().cast("array<struct<tag:string,content:string>>")
    texts = F.transform(F.split(F.coalesce("text", F.lit("")), r"\n[ \t]*\n\s*"), lambda t: F.struct(F.lit("text").alias("tag"), fx.strip(t).alias("content")))
    tables = F.transform("tables", lambda t: F.struct(F.lit("table").alias("tag"), fx.strip(t["content"]).alias("content")))
    images = F.transform("images", lambda i: F.struct(F.when(i["image_type"] == "picture", "image").otherwise(i["image_type"]).alias("tag"), F.concat(F.lit("["), F.upper(i["image_type"]), F.lit("] "), F.coalesce(i["caption"], F.lit(""))).alias("content")))
    formulas = F.transform("formulas", lambda x: F.struct(F.lit("formula").alias("tag"), fx.strip(x["latex"]).alias("content")))
    listed = F.filter(F.concat(texts, *(F.coalesce(c, none) for c in (tables, images, formulas))), lambda x: F.coalesce(x["content"], F.lit("")) != "")
    out = rows.select("page_id", "document_id", "page_number", F.posexplode(listed).alias("part_no", "e"))
    kind, subtype = tag_type(F.col("e.tag"))
    return out.select("page_id", "document_id", "page_number", "part_no", kind.alias("segment_type"), F.when(F.col("e.tag") == "text", fx.pdf_subtype(F.col("e.content"))).otherwise(subtype).alias("segment_subtype"), F.col("e.content").alias("content"))


def hybrid_pages(model: DataFrame, fallback: DataFrame, mode: int = 1, sure: float = 0.8) -> DataFrame:
    """``(document_id, page_number, text, origin, needs_review)`` of pages that a model and a plain extractor read.

    ``model`` has ``document_id, page_number, text, confidence``, ``fallback``
    ``document_id, page_number, ord, text``. Mode 0 takes the model alone; mode
    1 replaces pages below ``sure`` by a fallback that is clearly longer; mode 2
    merges the pages of both. A document without any page of the model has its
    fallback's in modes 1 and 2. Other modes raise ValueError.
    """
    if mode not in (0, 1, 2):
        raise ValueError(f"unknown mode {mode!r}")
    weak = F.coalesce(F.col("confidence"), F.lit(0.0)) < sure
    if mode == 0:
        return model.select("document_id", "page_number", "text", F.lit("model").alias("origin"), weak.alias("needs_review"))
    if mode == 2:
        merged = vis.merge_pages(model, fallback, sure)
        return merged.withColumn("needs_review", F.lit(False))
    replaced = vis.replace_weak_pages(model.where(weak), fallback)
    changed = ~F.col("merged").eqNullSafe(F.coalesce("text", F.lit("")))
    out = model.where(~weak).select("document_id", "page_number", "text", F.lit("model").alias("origin"), F.lit(False).alias("needs_review"))
    out = out.unionByName(replaced.select("document_id", "page_number", F.col("merged").alias("text"), F.when(changed, "fallback").otherwise("model").alias("origin"), F.lit(True).alias("needs_review")))
    rest = fallback.join(model.select("document_id").distinct(), "document_id", "left_anti").groupBy("document_id", "page_number").agg(F.min_by("text", "ord").alias("text"))
    return out.unionByName(rest.select("document_id", "page_number", "text", F.lit("fallback").alias("origin"), F.lit(False).alias("needs_review")))


def with_page_payload(segments: DataFrame, pages: DataFrame) -> DataFrame:
    """``segments`` with the raw page they stand on, of a page delivered twice the first: ``raw_page_id``, ``raw_text``, ``raw_tables``; null without page."""
    first = pages.where("document_id IS NOT NULL AND page_number IS NOT NULL").groupBy("document_id", "page_number").agg(F.min_by(F.struct("page_id", "text", F.coalesce(F.size("tables"), F.lit(0)).alias("n")), "page_id").alias("p"))
    joined = segments.where("page_number IS NOT NULL").join(first, ["document_id", "page_number"], "left")
    # Segments without page go round the join, where a null key would bring them all to one place.
    bare = segments.where("page_number IS NULL").withColumn("p", F.lit(None).cast(first.schema["p"].dataType))
    return joined.unionByName(bare).withColumns({"raw_page_id": F.col("p.page_id"), "raw_text": F.col("p.text"), "raw_tables": F.when(F.col("p.n") >= 0, F.col("p.n"))}).drop("p")


def first_of_each(rows: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """The first ``n`` rows of each group, such as images of a document or elements that are compared."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("_n") <= n).drop("_n")
