"""Reading office files: what their XML holds as flat rows, and segments from those.

Only the unpacking of a file runs in Python; a file that cannot be read gives
one row with its error and no segments.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ROWS = "document_id string, kind string, part int, part_name string, row_no int, col_no int, style string, content string, error string"
_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
_S = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_A = "{http://schemas.openxmlformats.org/drawingml/2006/main}"
_P = "{http://schemas.openxmlformats.org/presentationml/2006/main}"
_R = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"


def _xml(archive: zipfile.ZipFile, name: str) -> ElementTree.Element | None:
    return ElementTree.fromstring(archive.read(name)) if name in archive.namelist() else None


def _docx(archive: zipfile.ZipFile) -> Iterator[tuple]:
    body = _xml(archive, "word/document.xml").find(f"{_W}body")
    paragraphs = tables = 0
    for element in body:
        if element.tag == f"{_W}p":
            style = element.find(f"{_W}pPr/{_W}pStyle")
            text = "".join(t.text or "" for t in element.iter(f"{_W}t"))
            yield "paragraph", 0, "", paragraphs, 0, style.get(f"{_W}val") if style is not None else "", text
            paragraphs += 1
        elif element.tag == f"{_W}tbl":
            for r, row in enumerate(element.iter(f"{_W}tr")):
                for c, cell in enumerate(row.iter(f"{_W}tc")):
                    yield "cell", tables, "", r, c, "", "".join(t.text or "" for t in cell.iter(f"{_W}t")).strip()
            tables += 1


def _column(reference: str) -> int:
    n = 0
    for letter in re.match(r"[A-Z]*", reference).group():
        n = n * 26 + ord(letter) - 64
    return n


def _xlsx(archive: zipfile.ZipFile) -> Iterator[tuple]:
    strings = _xml(archive, "xl/sharedStrings.xml")
    shared = ["".join(t.text or "" for t in item.iter(f"{_S}t")) for item in strings] if strings is not None else []
    relations = _xml(archive, "xl/_rels/workbook.xml.rels")
    targets = {r.get("Id"): r.get("Target") for r in relations} if relations is not None else {}
    for number, sheet in enumerate(_xml(archive, "xl/workbook.xml").iter(f"{_S}sheet"), 1):
        target = targets.get(sheet.get(f"{_R}id"), f"worksheets/sheet{number}.xml")
        root = _xml(archive, target.lstrip("/") if target.startswith("/") else f"xl/{target}")
        yield "sheet", number, sheet.get("name"), 0, 0, "", sheet.get("name")
        for cell in root.iter(f"{_S}c") if root is not None else ():
            formula, value, inline = cell.find(f"{_S}f"), cell.find(f"{_S}v"), cell.find(f"{_S}is")
            if formula is not None and formula.text:
                text = f"={formula.text}"
            elif inline is not None:
                text = "".join(t.text or "" for t in inline.iter(f"{_S}t"))
            elif value is None or value.text is None:
                continue
            else:
                text = shared[int(value.text)] if cell.get("t") == "s" else value.text
            reference = cell.get("r", "A1")
            yield "cell", number, sheet.get("name"), int(re.search(r"\d+$", reference).group()), _column(reference), "", text


def _pptx(archive: zipfile.ZipFile) -> Iterator[tuple]:
    slides = sorted((int(m.group(1)), n) for n in archive.namelist() if (m := re.fullmatch(r"ppt/slides/slide(\d+)\.xml", n)))
    for number, (file_number, name) in enumerate(slides, 1):
        shape_no = 0
        for shape in _xml(archive, name).iter():
            if shape.tag == f"{_P}sp":
                holder = shape.find(f"{_P}nvSpPr/{_P}nvPr/{_P}ph")
                named = shape.find(f"{_P}nvSpPr/{_P}cNvPr")
                kind = holder.get("type", "body") if holder is not None else ""
                title = kind in ("title", "ctrTitle") or re.search(r"title|titel|heading", (named.get("name") or "") if named is not None else "", re.I)
                text = "\n".join("".join(t.text or "" for t in p.iter(f"{_A}t")) for p in shape.iter(f"{_A}p")).strip()
                yield "title" if title else "shape", number, "", shape_no, 0, kind, text
                shape_no += 1
            elif shape.tag == f"{_A}tbl":
                for r, row in enumerate(shape.iter(f"{_A}tr")):
                    for c, cell in enumerate(row.iter(f"{_A}tc")):
                        yield "cell", number, str(shape_no), r, c, "", "".join(t.text or "" for t in cell.iter(f"{_A}t")).strip()
                shape_no += 1
        notes = _xml(archive, f"ppt/notesSlides/notesSlide{file_number}.xml")
        if notes is not None:
            yield "notes", number, "", 0, 0, "", "\n".join(t for p in notes.iter(f"{_A}p") if (t := "".join(x.text or "" for x in p.iter(f"{_A}t")).strip()))


_READERS = {"docx": _docx, "xlsx": _xlsx, "pptx": _pptx}


def unpack(files: DataFrame, kind: str) -> DataFrame:
    """The rows ``ROWS`` of all files of one kind; a file that cannot be read gives a row with its error."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in ROWS.split(", ")]
        for pdf in batches:
            rows = []
            for key, content in zip(pdf.document_id, pdf.content, strict=True):
                try:
                    with zipfile.ZipFile(io.BytesIO(content)) as archive:
                        found = [(key, *row, None) for row in _READERS[kind](archive)]
                except Exception as error:
                    found = [(key, "error", 0, "", 0, 0, "", None, f"{type(error).__name__}: {error}")]
                rows += found
            yield pd.DataFrame(rows, columns=names)

    return files.select("document_id", "content").mapInPandas(run, ROWS)


def _ordered(rows: DataFrame) -> DataFrame:
    order = Window.partitionBy("document_id").orderBy("page_order", "rank", "place")
    out = rows.withColumn("segment_index", F.row_number().over(order) - 1)
    return out.select("document_id", "segment_index", "page_number", "segment_type", "segment_subtype", "content")


def _joined(rows: DataFrame, *keys: str, skip_empty: bool = True) -> DataFrame:
    """Cells as lines of their row, joined with bars, empty rows left out; empty cells too, or else kept up to the widest row of the table."""
    cells = rows.where("kind = 'cell' AND content <> ''").withColumn("content", F.when(F.startswith("content", F.lit("=")), F.concat(F.lit("[Formula: "), F.col("content"), F.lit("]"))).otherwise(F.col("content")))
    if not skip_empty:
        width = cells.groupBy(*keys).agg(F.min("col_no").alias("_from"), F.max("col_no").alias("_to"))
        by_place = cells.groupBy(*keys, "row_no").agg(F.map_from_entries(F.collect_list(F.struct("col_no", "content"))).alias("_m"), F.count("*").alias("n_cells")).join(width, list(keys))
        line = F.array_join(F.transform(F.sequence("_from", "_to"), lambda c: F.coalesce(F.try_element_at("_m", c), F.lit(""))), " | ")
        return by_place.select(*keys, "row_no", line.alias("content"), "n_cells")
    return cells.groupBy(*keys, "row_no").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("col_no", "content"))), lambda x: x["content"]), " | ").alias("content"), F.count("*").alias("n_cells"))


def style_subtype(style) -> object:
    """Subtype of a paragraph by the name of its style."""
    low = F.lower(style)
    has = lambda t: F.contains(low, F.lit(t))
    return (
        F.when(has("heading") & has("2"), "heading_2").when(has("heading") & has("3"), "heading_3").when(has("heading"), "heading_1").when(has("subtitle"), "subtitle").when(has("title"), "title")
        .when(has("caption"), "caption").when(has("quote"), "quote").when(has("list"), "list").otherwise("paragraph")
    )


def parse_docx(files: DataFrame) -> DataFrame:
    """Paragraphs, then tables. Empty paragraphs stay as a blank."""
    rows = unpack(files, "docx")
    text = rows.where("kind = 'paragraph'").select(
        "document_id", F.lit(0).alias("page_order"), F.lit(0).alias("rank"), F.col("row_no").alias("place"), F.lit(None).cast("int").alias("page_number"), F.lit("text").alias("segment_type"), style_subtype(F.col("style")).alias("segment_subtype"),
        F.when(F.trim("content") == "", " ").otherwise(F.trim("content")).alias("content"),
    )
    lines = _joined(rows, "document_id", "part").groupBy("document_id", "part").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("row_no", "content"))), lambda x: x["content"]), "\n").alias("content"))
    tables = lines.select("document_id", F.lit(0).alias("page_order"), F.lit(1).alias("rank"), F.col("part").alias("place"), F.lit(None).cast("int").alias("page_number"), F.lit("table").alias("segment_type"), F.lit("data").alias("segment_subtype"), "content")
    return _ordered(text.unionByName(tables))


def parse_xlsx(files: DataFrame, rows_per_segment: int = 1, skip_empty: bool = True) -> DataFrame:
    """A segment for each sheet, then its rows in blocks; the header is the first of rows 1 to 9 with more than one value."""
    rows = unpack(files, "xlsx")
    sheets = rows.where("kind = 'sheet'").select(
        "document_id", F.col("part").alias("page_order"), F.lit(0).alias("rank"), F.lit(0).alias("place"), F.col("part").alias("page_number"), F.lit("metadata").alias("segment_type"), F.lit("sheet").alias("segment_subtype"),
        F.concat(F.lit("Sheet: "), F.col("content")).alias("content"),
    )
    lines = _joined(rows, "document_id", "part", skip_empty=skip_empty)
    heads = lines.where("row_no <= 9 AND n_cells > 1").groupBy("document_id", "part").agg(F.min("row_no").alias("head"))
    block = F.floor((F.col("row_no") - 1) / rows_per_segment).cast("int")
    cut = lines.join(heads, ["document_id", "part"], "left").groupBy("document_id", "part", block.alias("block")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("row_no", "content"))), lambda x: x["content"]), "\n").alias("content"), F.bool_or(F.col("row_no") == F.col("head")).alias("is_head")
    )
    data = cut.select(
        "document_id", F.col("part").alias("page_order"), F.lit(1).alias("rank"), F.col("block").alias("place"), F.col("part").alias("page_number"), F.lit("table").alias("segment_type"), F.when(F.col("is_head"), "header").otherwise("data").alias("segment_subtype"), "content"
    )
    return _ordered(sheets.unionByName(data))


def parse_pptx(files: DataFrame) -> DataFrame:
    """A segment for each slide, its title first, then other texts and tables, and one for its notes."""
    rows = unpack(files, "pptx")
    texts = rows.where("kind IN ('title', 'shape') AND content <> ''").select(
        "document_id", "part", (F.col("kind") != "title").cast("int").alias("rank"), F.col("row_no").alias("place"), F.when(F.col("kind") == "title", F.concat(F.lit("TITLE: "), F.col("content"))).otherwise(F.col("content")).alias("content")
    )
    lines = _joined(rows, "document_id", "part", "part_name").groupBy("document_id", "part", "part_name").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("row_no", "content"))), lambda x: x["content"]), "\n").alias("content"))
    tables = lines.select("document_id", "part", F.lit(1).alias("rank"), F.col("part_name").cast("int").alias("place"), F.concat(F.lit("TABLE:\n"), F.col("content")).alias("content"))
    slides = texts.unionByName(tables).groupBy("document_id", "part").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "place", "content"))), lambda x: x["content"]), "\n").alias("content"))
    shape = lambda df, rank, kind, sub: df.select(
        "document_id", F.col("part").alias("page_order"), F.lit(rank).alias("rank"), F.lit(0).alias("place"), F.col("part").alias("page_number"), F.lit(kind).alias("segment_type"), F.lit(sub).alias("segment_subtype"), "content"
    )
    notes = rows.where("kind = 'notes' AND content <> ''").select("document_id", "part", "content")
    return _ordered(shape(slides, 0, "metadata", "slide").unionByName(shape(notes, 1, "text", "footnote")))
