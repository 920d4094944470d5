"""Writing documents, reports and graphs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirelake.operators import tables

FORMATS = ("turtle", "ntriples", "rdf", "json-ld", "json", "csv")
#: Positions of segments, and ids of visuals, that one row of an exported document holds.
PART = 1024


def _json(*columns: str | Column) -> Column:
    """Columns as a JSON object, nulls included."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def parsed_documents(documents: DataFrame, segments: DataFrame, visuals: DataFrame) -> DataFrame:
    """``(document_id, section, part_no, json)``: each document as JSON texts of bounded size.

    Section ``metadata`` has one row with what describes the document and how
    much it holds, ``segments`` and ``visual_elements`` a row for every ``PART``
    positions or ids.
    """
    s = segments.groupBy("document_id", F.floor(F.col("segment_index") / PART).alias("part_no")).agg(F.array_sort(F.collect_list(F.struct("segment_index", "segment_id", "page_number", "segment_type", "segment_subtype", "content"))).alias("segments"))
    v = visuals.groupBy("document_id", F.floor(F.col("visual_id") / PART).alias("part_no")).agg(F.array_sort(F.collect_list(F.struct("visual_id", "content_hash", "element_type", "page_number", "vlm_description"))).alias("visual_elements"))
    sizes = segments.groupBy("document_id").agg(F.count("*").alias("total_segments")).join(visuals.groupBy("document_id").agg(F.count("*").alias("total_visuals")), "document_id", "full_outer")
    rows = documents.join(sizes, "document_id", "left")
    summary = F.struct(F.coalesce("total_segments", F.lit(0)).alias("total_segments"), F.coalesce("total_visuals", F.lit(0)).alias("total_visuals"))
    head = rows.select("document_id", F.lit("metadata").alias("section"), F.lit(0).cast("bigint").alias("part_no"), _json("document_id", "source_path", "document_type", summary.alias("summary")).alias("json"))
    body = [df.select("document_id", F.lit(name).alias("section"), "part_no", _json("document_id", name).alias("json")) for df, name in ((s, "segments"), (v, "visual_elements"))]
    return head.unionByName(body[0]).unionByName(body[1])


def note(visual_type: str = "element_type") -> Column:
    """A visual's description in a line, with its type and page."""
    return F.concat(F.lit("["), F.upper(visual_type), F.lit("]: "), F.col("vlm_description"), F.coalesce(F.concat(F.lit(" (Page "), F.col("page_number").cast("string"), F.lit(")")), F.lit("")))


def full_text(segments: DataFrame, visuals: DataFrame) -> DataFrame:
    """``(document_id, section, part_no, content)``: the text of each document, then the descriptions of its visuals, in parts of bounded size.

    Names of sheets and slides are headings. A part holds ``PART`` positions or
    ids; parts in order are the whole document.
    """
    shown = F.when((F.col("segment_type") == "metadata") & F.col("segment_subtype").isin("sheet", "slide"), F.concat(F.lit("## "), F.col("content"))).otherwise(F.col("content"))
    listed = F.array_sort(F.collect_list(F.struct("segment_index", "segment_id", shown.alias("content"))))
    s = segments.where("content IS NOT NULL").groupBy("document_id", F.floor(F.col("segment_index") / PART).alias("part_no")).agg(F.array_join(F.transform(listed, lambda x: x["content"]), "\n\n").alias("content"))
    lines = F.array_sort(F.collect_list(F.struct(F.col("visual_id"), note().alias("line"))))
    v = visuals.where("vlm_description <> '' AND element_type IS NOT NULL").groupBy("document_id", F.floor(F.col("visual_id") / PART).alias("part_no")).agg(F.array_join(F.transform(lines, lambda x: x["line"]), "\n").alias("content"))
    return s.withColumn("section", F.lit("text")).unionByName(v.withColumn("section", F.lit("visuals"))).select("document_id", "section", "part_no", "content")


def enhanced_content(segments: DataFrame, visuals: DataFrame) -> DataFrame:
    """``(segment_id, content)`` of segments that refer to described visuals of their document: their content, then a line for each."""
    refs = segments.where("content IS NOT NULL").select("segment_id", "document_id", "content", F.posexplode("visual_references").alias("pos", "content_hash"))
    known = visuals.where("vlm_description <> '' AND element_type IS NOT NULL").select("document_id", "content_hash", "visual_id", note().alias("line"))
    lines = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "visual_id", "line"))), lambda x: x["line"]), "\n")
    return refs.join(known, ["document_id", "content_hash"]).groupBy("segment_id", "content").agg(lines.alias("_n")).select("segment_id", F.concat("content", F.lit("\n\n"), "_n").alias("content"))


def write_graph(triples: DataFrame, path: str, kind: str = "ntriples") -> None:
    """Triples as files of one of ``FORMATS``; ValueError for others."""
    if kind not in FORMATS:
        raise ValueError(f"unknown format {kind!r}; known are {', '.join(FORMATS)}")
    if kind == "turtle":
        tables.turtle(triples).select("block").write.mode("overwrite").text(path)
    elif kind == "ntriples":
        tables.n_triples(triples).write.mode("overwrite").text(path)
    elif kind in ("rdf", "json-ld"):
        (tables.rdf_xml if kind == "rdf" else tables.json_ld)(triples).select("block").write.mode("overwrite").text(path)
    else:
        triples.write.mode("overwrite").option("header", True).format(kind).save(path)


def write_report(report: DataFrame, path: str) -> None:
    """A report of few rows as one file of JSON lines."""
    report.coalesce(1).write.mode("overwrite").json(path)
