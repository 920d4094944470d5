"""Visual elements: their joins with segments, chunks and pages, and the judging of model results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirelake.functions import text as fx

# Patterns and terms by which descriptions are judged.
GENERIC = (r"image of a \w+", "picture showing", "photo of", "illustration of", r"generic \w+", r"various \w+", "some kind of", "appears to be", "possibly a")
VAGUE = ("something", "stuff", "things", "various", "some", "certain")
SPECIFIC = ("diagram", "table", "chart", "graph", "specifications")
STRUCTURE = ("rows", "columns", "cells", "headers", "labels")
DIAGRAM_TERMS = ("flow", "connection", "relationship", "arrow", "box", "node", "process", "step", "component", "system", "architecture", "input", "output", "link", "branch")
RELATIONS = ("connects", "links", "flows", "leads", "between", "from", "to")
BASE, DIAGRAM, CRITICAL = 0.85, 0.90, 0.95


def hallucination(description: Column, ocr: Column) -> Column:
    """From 0 to 1, how generic and vague a description is; 0.5 for null and empty."""
    low = F.lower(description)
    generic = sum((low.rlike(p).cast("int") for p in GENERIC), F.lit(0))
    tenths = generic * 2 + fx.count_contains(low, VAGUE)
    tenths = tenths + F.when((F.length(F.coalesce(ocr, F.lit(""))) > 20) & (tenths > 3), 2).otherwise(0)
    return F.when(F.coalesce(description, F.lit("")) == "", 0.5).otherwise(F.least(tenths, F.lit(10)) / 10)


def text_quality(description: Column, ocr: Column) -> Column:
    """From 0 to 1, by terms, length, structure words and recognised text; 0 for null and empty."""
    low, n = F.lower(description), fx.word_count(description)
    tenths = F.least(fx.count_contains(low, SPECIFIC), F.lit(3)) + F.when(n.between(20, 200), 3).when(n >= 10, 2).otherwise(0) + F.when(fx.any_contains(low, STRUCTURE), 2).otherwise(0)
    tenths = tenths + F.when(F.length(F.coalesce(ocr, F.lit(""))) > 10, 2).otherwise(0)
    return F.when(F.coalesce(description, F.lit("")) == "", 0.0).otherwise(F.least(tenths, F.lit(10)) / 10)


def completeness(data: Column) -> Column:
    """From 0 to 1 how much extracted data (JSON) holds: by keys, nesting and digits in values; a list that is not empty has 0.5; 0 for none."""
    is_list = F.coalesce(F.size(F.when(fx.strip(data).startswith("["), F.from_json(data, "array<string>"))) > 0, F.lit(False))
    keys = F.size(F.coalesce(F.json_object_keys(data), F.array().cast("array<string>")))
    # Without its strings, an object has a bracket after a colon exactly if one of its values is nested.
    nested = F.regexp_replace(data, r'"(?:[^"\\]|\\.)*"', '""').rlike(r":\s*[\[{]")
    digits = F.exists(F.coalesce(F.map_values(F.from_json(data, "map<string,string>")), F.array().cast("array<string>")), lambda v: F.coalesce(v.rlike("[0-9]"), F.lit(False)))
    tenths = F.least(keys, F.lit(5)) + F.when(nested, 3).otherwise(0) + F.when(digits, 2).otherwise(0)
    return F.when(is_list, 0.5).when(keys > 0, F.least(tenths, F.lit(10)) / 10).otherwise(0.0)


def diagram_analysed(description: Column) -> Column:
    low = F.lower(F.coalesce(description, F.lit("")))
    return (fx.count_contains(low, DIAGRAM_TERMS) >= 2) & fx.any_contains(low, RELATIONS)


def evaluate(results: DataFrame) -> DataFrame:
    """``results`` with the judgement of each model result and the reasons for a second try.

    Failed results have confidence 0, hallucination 1 and the reason parsing_error.
    """
    ok, critical = F.coalesce(F.col("success"), F.lit(False)), F.coalesce(F.col("is_critical"), F.lit(False))
    diagram = F.coalesce(F.col("element_type") == "diagram", F.lit(False))
    rows = results.withColumns({"text_quality": text_quality(F.col("description"), F.col("ocr_text")), "completeness": completeness(F.col("extracted_data")), "hallucination": hallucination(F.col("description"), F.col("ocr_text"))})
    overall = F.coalesce(F.col("confidence"), F.lit(0.0)) * 0.4 + F.col("text_quality") * 0.3 + F.col("completeness") * 0.2 + (1 - F.col("hallucination")) * 0.1
    rows = rows.withColumn("overall", F.round(F.when(ok, overall).otherwise(0.0), 6))
    limit = F.when(critical, CRITICAL).when(diagram, DIAGRAM).otherwise(BASE)
    reasons = F.array_compact(
        F.array(
            F.when(F.col("overall") < limit, "low_confidence"), F.when(F.col("hallucination") > 0.5, "hallucination_detected"),
            F.when((F.col("completeness") < 0.5) & F.col("element_type").isin("table", "diagram"), "incomplete_data"), F.when(critical & (F.col("overall") < CRITICAL), "critical_document"),
            F.when(diagram & ~diagram_analysed(F.col("description")), "diagram_type"),
        )
    )
    rows = rows.withColumn("reasons", F.when(ok, reasons).otherwise(F.array(F.lit("parsing_error"))))
    failed = {c: F.when(ok, F.col(c)).otherwise(v) for c, v in (("text_quality", 0.0), ("completeness", 0.0), ("hallucination", 1.0))}
    return rows.withColumns(failed).withColumn("needs_fallback", F.size("reasons") > 0)


def fallback_settings(reasons: Column) -> tuple[Column, Column, Column]:
    """Temperature, token limit and focus of a second try; later reasons override earlier ones."""
    has = lambda r: F.array_contains(reasons, r)
    temperature = F.when(has("critical_document"), 0.1).when(has("diagram_type"), 0.2).when(has("hallucination_detected"), 0.1).otherwise(0.3)
    tokens = F.when(has("critical_document") | has("incomplete_data"), 1024).otherwise(512)
    focus = (
        F.when(has("critical_document"), "exhaustive_analysis").when(has("diagram_type"), "diagram_analysis").when(has("incomplete_data"), "detailed_analysis")
        .when(has("hallucination_detected"), "precise_extraction").otherwise("comprehensive")
    )
    return temperature, tokens, focus


def consensus(results: DataFrame) -> DataFrame:
    """For each content_hash: mean confidence, most common element type, model with the highest confidence, number of models, summed seconds; ties by value."""
    counts = results.where("element_type IS NOT NULL").groupBy("content_hash", "element_type").agg(F.count("*").alias("n")).groupBy("content_hash").agg(F.min_by("element_type", F.struct(-F.col("n"), F.col("element_type"))).alias("element_type"))
    best = results.groupBy("content_hash").agg(
        F.round(F.avg("confidence"), 6).alias("confidence"), F.min_by("model_used", F.struct(-F.coalesce("confidence", F.lit(-1.0)), F.col("model_used"))).alias("best_model"), F.countDistinct("model_used").alias("n_models"),
        F.round(F.coalesce(F.sum("processing_time_seconds"), F.lit(0.0)), 4).alias("total_seconds"),
    )
    return best.join(counts, "content_hash", "left")


def visuals_in_pages(chunks: DataFrame, visuals: DataFrame) -> DataFrame:
    """``(chunk_row_id, visual_id)``: the visuals on a chunk's pages. Pages are exploded, so the join is on equality."""
    pages = chunks.where("page_range.start_page IS NOT NULL AND page_range.end_page >= page_range.start_page").select("chunk_row_id", "document_id", F.explode(F.sequence("page_range.start_page", "page_range.end_page")).alias("page_number"))
    return pages.join(visuals.where("page_number > 0").select("visual_id", "document_id", "page_number"), ["document_id", "page_number"]).select("chunk_row_id", "visual_id")


def describe_segments(segments: DataFrame, visuals: DataFrame) -> DataFrame:
    """``(segment_id, content)``: content replaced by the description of the first reference that has one."""
    refs = segments.select("segment_id", F.posexplode("visual_references").alias("pos", "content_hash"))
    described = visuals.where("vlm_description IS NOT NULL").groupBy("content_hash").agg(F.min_by("vlm_description", "visual_id").alias("description"))
    first = refs.join(described, "content_hash").groupBy("segment_id").agg(F.min_by("description", "pos").alias("description"))
    return segments.join(first, "segment_id", "left").select("segment_id", F.coalesce("description", "content").alias("content"), F.col("description").isNotNull().alias("replaced"))


def known_references(segments: DataFrame, visuals: DataFrame) -> DataFrame:
    """``(segment_id, refs)``: only the references that are visuals, in order; segments without any are left out."""
    refs = segments.select("segment_id", F.posexplode("visual_references").alias("pos", "content_hash")).join(visuals.select("content_hash").distinct(), "content_hash", "left_semi")
    return refs.groupBy("segment_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "content_hash"))), lambda x: x["content_hash"]).alias("refs"))


def replace_weak_pages(pages: DataFrame, fallback: DataFrame, ratio: float = 1.2) -> DataFrame:
    """``pages`` with text replaced by a fallback that is over ``ratio`` times as long, one fallback after the other."""
    listed = fallback.groupBy("document_id", "page_number").agg(F.array_sort(F.collect_list(F.struct("ord", "text"))).alias("_f"))
    step = lambda acc, x: F.when(F.length(x["text"]) > F.length(acc) * ratio, x["text"]).otherwise(acc)
    joined = pages.join(listed, ["document_id", "page_number"], "left")
    final = F.aggregate(F.coalesce("_f", F.array().cast(listed.schema["_f"].dataType)), F.coalesce("text", F.lit("")), step)
    return joined.withColumn("merged", final).drop("_f")


def merge_pages(model: DataFrame, fallback: DataFrame, sure: float = 0.8) -> DataFrame:
    """Pages of both: the model's where sure enough, else the first fallback, else the model's."""
    first = fallback.groupBy("document_id", "page_number").agg(F.min_by("text", "ord").alias("fallback_text"))
    joined = model.join(first, ["document_id", "page_number"], "full_outer")
    text = F.when(F.col("confidence") >= sure, F.col("text")).otherwise(F.coalesce("fallback_text", "text"))
    return joined.select("document_id", "page_number", text.alias("text"), F.when(F.col("confidence") >= sure, "model").when(F.col("fallback_text").isNotNull(), "fallback").otherwise("model").alias("origin"))


def merge_stages(general: DataFrame, precise: DataFrame) -> DataFrame:
    """``(content_hash, description, confidence, stage)``: precise results over general ones, then precise ones without."""
    p = precise.select("content_hash", F.col("description").alias("_d"), F.col("confidence").alias("_c"), F.lit(True).alias("_hit"))
    hit = F.col("_hit").isNotNull()
    over = general.join(p, "content_hash", "left").select(
        "content_hash", F.when(hit, F.col("_d")).otherwise(F.col("description")).alias("description"), F.when(hit, F.col("_c")).otherwise(F.col("confidence")).alias("confidence"), F.when(hit, "precise").otherwise("general").alias("stage")
    )
    rest = precise.join(general.select("content_hash"), "content_hash", "left_anti").select("content_hash", "description", "confidence", F.lit("precise").alias("stage"))
    return over.unionByName(rest)


def best_results(visuals: DataFrame, results: DataFrame) -> DataFrame:
    """``(visual_id, n_results, best_analysis)``: results of the visual's hash, the surest one by id where equal.

    Results are brought down to one row a hash first, since one logo may be in
    a great part of all documents.
    """
    best = results.groupBy("content_hash").agg(F.count("*").alias("n_results"), F.min_by("analysis_id", F.struct(-F.coalesce("confidence", F.lit(-1.0)), F.col("analysis_id"))).alias("best_analysis"))
    return visuals.select("visual_id", "content_hash").join(best, "content_hash", "left").select("visual_id", "n_results", "best_analysis")


def image_context(segments: DataFrame, visuals: DataFrame) -> DataFrame:
    """``(visual_id, segment_id)``: the first segment of the page that needs context, else the first that refers to the image."""
    needs = segments.where(fx.needs_context(F.col("segment_type"), F.col("segment_subtype"), F.col("content")))
    order = F.struct("segment_index", "segment_id")
    by_page = needs.where("page_number IS NOT NULL").groupBy("document_id", "page_number").agg(F.min_by("segment_id", order).alias("on_page"))
    by_ref = segments.select("document_id", "segment_index", "segment_id", F.explode("visual_references").alias("content_hash")).groupBy("document_id", "content_hash").agg(F.min_by("segment_id", order).alias("by_ref"))
    joined = visuals.select("visual_id", "document_id", "page_number", "content_hash").join(by_page, ["document_id", "page_number"], "left").join(by_ref, ["document_id", "content_hash"], "left")
    return joined.select("visual_id", F.coalesce("on_page", "by_ref").alias("segment_id"))


def boxes_of(text: Column) -> Column:
    """The four numbers of a place written as ``<loc_a><loc_b><loc_c><loc_d>`` or as ``a>b>c>d>``; null for other texts."""
    tagged, plain = r"<loc_(\d+)><loc_(\d+)><loc_(\d+)><loc_(\d+)>", r"(\d+)>(\d+)>(\d+)>(\d+)>"
    numbers = lambda p: F.array(*(F.regexp_extract(text, p, g).try_cast("int") for g in range(1, 5)))
    return F.when(text.rlike(tagged), numbers(tagged)).when(text.rlike(plain), numbers(plain))


def by_reference(segments: DataFrame, key: Column, visuals: DataFrame, visual_key: Column) -> DataFrame:
    """``(segment_id, refs)``: the hashes of the visuals of a document whose place, such as ``paragraph_3``, ``sheet_Costs`` or a slide number, is the segment's, by visual id.

    Visuals are brought to one row a place first; segments and visuals without
    place or document join nothing and are left out.
    """
    placed = visuals.withColumn("_k", visual_key.cast("string")).where("_k IS NOT NULL AND document_id IS NOT NULL AND content_hash IS NOT NULL")
    listed = placed.groupBy("document_id", "_k").agg(F.transform(F.array_sort(F.collect_list(F.struct("visual_id", "content_hash"))), lambda x: x["content_hash"]).alias("refs"))
    rows = segments.select("segment_id", "document_id", key.cast("string").alias("_k")).where("_k IS NOT NULL AND document_id IS NOT NULL")
    return rows.join(listed, ["document_id", "_k"]).select("segment_id", "refs")


def table_kind(page_kind: Column, element: Column, data: Column) -> Column:
    """``motorization`` for tables on specification pages whose data speaks of engines; null for others."""
    # Words by which data speaks of engines.
    terms = ("motor", "modell", "leistung", "power")
    return F.when((page_kind == "technical_specification") & (element == "table") & F.coalesce(fx.any_contains(F.lower(data), terms), F.lit(False)), "motorization")


def chart_text(title: Column, kind: Column, series: Column, most: int = 10) -> Column:
    """A chart in words: its title if it has one, its type, and the first ``most`` values of each series (``array<struct<title, values>>``)."""
    line = lambda s, n: F.concat(F.lit("  "), F.coalesce(s["title"], F.concat(F.lit("Series "), (n + 1).cast("string"))), F.lit(": "), F.when(F.coalesce(F.size(s["values"]), F.lit(0)) > 0, F.array_join(F.slice(s["values"], 1, most), ", ")).otherwise("No data"))
    lines = F.transform(series, line)
    body = F.when(F.size(series) > 0, F.concat(F.array(F.lit("Data Series:")), lines)).otherwise(F.array().cast("array<string>"))
    head = F.array(F.when(F.coalesce(title, F.lit("")) != "", F.concat(F.lit("Chart Title: "), title)), F.concat(F.lit("Chart Type: "), F.coalesce(kind, F.lit("Unknown"))))
    return F.array_join(F.concat(F.array_compact(head), F.coalesce(body, F.array().cast("array<string>"))), "\n")


def scaled_box(bbox: Column, width: float, height: float) -> Column:
    """A box of four numbers in 0 to 500 as x, y, width and height in page units; null for others."""
    x, y = width / 500, height / 500
    box = F.struct((bbox[0] * x).alias("x"), (bbox[1] * y).alias("y"), ((bbox[2] - bbox[0]) * x).alias("width"), ((bbox[3] - bbox[1]) * y).alias("height"))
    return F.when(F.size(bbox) == 4, box)


def aspect_type(width: Column, height: Column, office: str = "slides") -> Column:
    """Element type by the sides of an image in ``slides`` (and sheets) or ``text`` documents."""
    ratio = F.try_divide(width, height)
    if office == "text":
        return F.when(ratio > 2.5, "chart").when(ratio.between(0.8, 1.2), "diagram").when((width > 300) & (height > 200), "chart").when(ratio.isNotNull(), "image").otherwise("unknown_visual")
    return F.when(ratio > 2.0, "chart").when(ratio.between(0.8, 1.2), "diagram").when(ratio.isNotNull(), "image").otherwise("unknown_visual")


def merge_results(pairs: DataFrame, strategy: str = "replace") -> DataFrame:
    """``pairs`` of a first and a second result (columns ``first`` and ``second``, structs) with ``merged``.

    ``replace`` takes the second, ``best`` the one with the higher ``overall``
    (the first where equal), ``combine`` joins descriptions and recognised texts
    and takes the higher confidence. Other strategies raise ValueError.
    """
    first, second = F.col("first"), F.col("second")
    if strategy == "replace":
        merged = second
    elif strategy == "best":
        merged = F.when(second["overall"] > first["overall"], second).otherwise(first)
    elif strategy == "combine":
        text = F.concat(F.coalesce(first["description"], F.lit("")), F.lit("\n\nAdditional details: "), F.coalesce(second["description"], F.lit("")))
        ocr = fx.strip(F.concat(F.coalesce(first["ocr_text"], F.lit("")), F.lit("\n"), F.coalesce(second["ocr_text"], F.lit(""))))
        merged = F.struct(text.alias("description"), ocr.alias("ocr_text"), F.greatest(first["confidence"], second["confidence"]).alias("confidence"), F.greatest(first["overall"], second["overall"]).alias("overall"))
    else:
        raise ValueError(f"unknown strategy {strategy!r}")
    return pairs.withColumn("merged", merged)


def outside_boxes(points: DataFrame, boxes: DataFrame) -> DataFrame:
    """Points ``(document_id, page_number, x, y, ...)`` in no box ``(document_id, page_number, x0, y0, x1, y1)`` of their page."""
    p, b = points.alias("p"), boxes.alias("b")
    inside = (F.col("p.document_id") == F.col("b.document_id")) & (F.col("p.page_number") == F.col("b.page_number")) & F.col("p.x").between(F.col("b.x0"), F.col("b.x1")) & F.col("p.y").between(F.col("b.y0"), F.col("b.y1"))
    return p.join(b, inside, "left_anti")


def visuals_by_page(visuals: DataFrame) -> DataFrame:
    """``(document_id, page_number, visual_ids)``: the visuals of each page in order; of visuals without page, those of a null page."""
    return visuals.groupBy("document_id", "page_number").agg(F.array_sort(F.collect_list("visual_id")).alias("visual_ids"))
