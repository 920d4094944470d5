"""Segments: cutting texts, subtypes, and the context around a segment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quirelake.functions import text as fx
from quirelake.operators.running import before, running
from quirelake.schema import HEADINGS


def text_segments(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", separator: str = "\n\n+", least: int = 20) -> DataFrame:
    """Paragraphs of text or Markdown documents.

    ``(id, segment_index, segment_subtype, content, start_pos, end_pos, length)``.
    Parts shorter than ``least`` are dropped unless they are headings; positions
    count the kept parts with two characters between them. Null and empty texts
    give no segments.
    """
    parts = F.filter(F.transform(F.split(F.col(text_col), separator), fx.strip), lambda x: (F.length(x) >= least) | F.startswith(x, F.lit("#")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start_pos:int,end_pos:int,content:string>>").alias("out"))
    placed = F.aggregate(
        F.coalesce(parts, F.array().cast("array<string>")),
        start,
        lambda acc, x: F.struct(
            (acc.at + F.length(x) + 2).alias("at"), F.concat(acc.out, F.array(F.struct(acc.at.alias("start_pos"), (acc.at + F.length(x)).alias("end_pos"), x.alias("content")))).alias("out")
        ),
    ).out
    rows = documents.select(F.col(id_col), F.posexplode(placed).alias("segment_index", "part"))
    return rows.select(id_col, "segment_index", fx.txt_subtype(F.col("part.content")).alias("segment_subtype"), "part.content", "part.start_pos", "part.end_pos", F.length("part.content").alias("length"))


def keep_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in a total order; ties cannot be."""
    columns = [c for c in df.columns if c not in keys]
    first = df.groupBy(*keys).agg(F.min_by(F.struct(*columns), F.struct(*order)).alias("_row"))
    return first.select(*keys, "_row.*").select(*df.columns)


def nearest_heading(segments: DataFrame) -> DataFrame:
    """``segments`` with ``nearest_heading``: the last heading of the document before the segment; null if there is none."""
    heading = F.when(F.col("segment_subtype").isin(*HEADINGS), F.col("content"))
    return running(segments, ["document_id"], "segment_index", [F.col("segment_index"), F.col("segment_id")], heading, "nearest_heading", "last")


def relative_position(segments: DataFrame) -> DataFrame:
    """``segments`` with ``relative_position`` on the page: top, middle, bottom, or unknown without page."""
    page, paged = ["document_id", "page_number"], segments.where("page_number IS NOT NULL")
    placed = running(paged, page, "segment_index", [F.col("segment_index"), F.col("segment_id")], F.lit(1), "_rank", "sum")
    sizes = paged.groupBy(*page).agg(F.count("*").alias("_size")).alias("z")
    same = F.col("p.document_id").eqNullSafe(F.col("z.document_id")) & (F.col("p.page_number") == F.col("z.page_number"))
    share = F.col("_rank") / F.col("_size")
    where = F.when(share < 0.33, "top").when(share < 0.67, "middle").otherwise("bottom")
    out = placed.alias("p").join(sizes, same).select("p.*", "z._size").withColumn("relative_position", where).drop("_rank", "_size")
    # Segments without page go round the window, which would bring all of a document to one place.
    return out.unionByName(segments.where("page_number IS NULL").withColumn("relative_position", F.lit("unknown")))


def preceding(segments: DataFrame) -> DataFrame:
    """``segments`` with ``table_reference`` of the three segments before it and ``list_introduction`` of the one before it."""
    found = F.struct(fx.table_reference(F.col("content")).alias("ref"), fx.list_introduction(F.col("content")).alias("intro"))
    rows = before(segments, ["document_id"], "segment_index", [F.col("segment_index"), F.col("segment_id")], found, "_near", 3)
    refs = F.filter(F.transform("_near", lambda x: x["ref"]), lambda x: x.isNotNull())
    return rows.withColumn("table_reference", F.try_element_at(refs, F.lit(1))).withColumn("list_introduction", F.try_element_at(F.col("_near"), F.lit(-1))["intro"]).drop("_near")


def document_kinds(segments: DataFrame, titles: DataFrame) -> DataFrame:
    """``(document_id, document_kind)`` by the title and the headings among the first 20 segments."""
    heads = segments.where(F.col("segment_subtype").isin(*HEADINGS) & (F.col("segment_index") < 20))
    joined = heads.groupBy("document_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("segment_index", "segment_id", "content"))), lambda x: x["content"]), " ").alias("heads"))
    return titles.join(joined, "document_id", "left").select("document_id", fx.document_kind(F.col("title"), F.col("heads")).alias("document_kind"))


def reindexed(segments: DataFrame, first: str, order: list[Column]) -> DataFrame:
    """``segments`` numbered anew from 0 in each document, by ``first`` (a whole number, nulls first) and then ``order``.

    Each value of ``first``, such as a page, is numbered by itself.
    """
    return running(segments, ["document_id"], first, [F.col(first), *order], F.lit(1), "_place", "sum", bucket=1).drop("segment_index").withColumnRenamed("_place", "segment_index")


def _is_heading() -> Column:
    return F.coalesce(F.col("segment_subtype").isin("heading_1", "heading_2", "heading_3", "title"), F.lit(False))


def markers(segments: DataFrame) -> DataFrame:
    """The segments that open a section, with ``is_heading``; a row each, however many a document has."""
    return segments.withColumn("is_heading", _is_heading()).where(F.coalesce(fx.section_marker(F.col("segment_subtype"), fx.strip(F.col("content"))), F.lit(False)))


def structure(segments: DataFrame, visuals: DataFrame) -> DataFrame:
    """What each document holds: numbers of segments, headings and section markers, pages, and whether there are tables, images and charts."""
    marker = F.coalesce(fx.section_marker(F.col("segment_subtype"), fx.strip(F.col("content"))), F.lit(False))
    s = segments.groupBy("document_id").agg(F.count("*").alias("n_segments"), F.bool_or(F.col("segment_type") == "table").alias("has_tables"), F.max("page_number").alias("total_pages"), F.count_if(_is_heading()).alias("n_headings"), F.count_if(marker).alias("n_section_markers"))
    v = visuals.groupBy("document_id").agg(F.lit(True).alias("has_images"), F.bool_or(F.col("element_type").isin("chart", "graph")).alias("has_charts"))
    return s.join(v, "document_id", "left").na.fill(False, ["has_images", "has_charts"])
