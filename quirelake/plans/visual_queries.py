"""Queries on visual elements, pages and model results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quirelake.common import table
from quirelake.operators import intervals
from quirelake.operators import visuals as ops
from quirelake.operators.pages import first_of_each
from quirelake.plans.registry import Registry
from quirelake.plans.text_queries import WS, words

registry = Registry()
query = registry.add


def _count(terms: tuple[str, ...], x: str) -> str:
    return "(" + " + ".join(f"CAST(contains({x}, '{t}') AS INTEGER)" for t in terms) + ")"


def _any(terms: tuple[str, ...], x: str) -> str:
    return "(" + " OR ".join(f"contains({x}, '{t}')" for t in terms) + ")"


_GENERIC = "(" + " + ".join(f"CAST(regexp_matches(low, '{p}') AS INTEGER)" for p in ops.GENERIC) + ")"
JUDGED = f"""
WITH a AS (SELECT *, lower(description) AS low, coalesce(ocr_text, '') AS ocr, coalesce(description, '') = '' AS none, coalesce(success, false) AS ok, coalesce(is_critical, false) AS critical, coalesce(element_type = 'diagram', false) AS is_diagram FROM analysis_results),
b AS (SELECT *, {_GENERIC} * 2 + {_count(ops.VAGUE, "low")} AS g,
    least({_count(ops.SPECIFIC, "low")}, 3) + CASE WHEN {words("description")} BETWEEN 20 AND 200 THEN 3 WHEN {words("description")} >= 10 THEN 2 ELSE 0 END + CASE WHEN {_any(ops.STRUCTURE, "low")} THEN 2 ELSE 0 END + CASE WHEN length(ocr) > 10 THEN 2 ELSE 0 END AS q,
    coalesce(len(json_keys(CASE WHEN json_valid(extracted_data) THEN extracted_data END)), 0) AS keys FROM a),
c AS (SELECT *, CASE WHEN none THEN 0.5 ELSE least(g + CASE WHEN length(ocr) > 20 AND g > 3 THEN 2 ELSE 0 END, 10) / 10 END AS h, CASE WHEN none THEN 0.0 ELSE least(q, 10) / 10 END AS t,
    CASE WHEN json_valid(extracted_data) AND json_type(extracted_data) = 'ARRAY' AND json_array_length(extracted_data) > 0 THEN 0.5
      WHEN keys > 0 THEN least(least(keys, 5) + CASE WHEN len(list_filter(json_keys(extracted_data), lambda k: json_type(json_extract(extracted_data, '$."' || k || '"')) IN ('OBJECT', 'ARRAY'))) > 0 THEN 3 ELSE 0 END
        + CASE WHEN len(list_filter(json_keys(extracted_data), lambda k: regexp_matches(CAST(json_extract(extracted_data, '$."' || k || '"') AS VARCHAR), '[0-9]'))) > 0 THEN 2 ELSE 0 END, 10) / 10 ELSE 0.0 END AS e FROM b),
j AS (SELECT *, round(CASE WHEN ok THEN coalesce(confidence, 0.0) * 0.4 + t * 0.3 + e * 0.2 + (1 - h) * 0.1 ELSE 0.0 END, 6) AS overall FROM c),
r AS (SELECT *, CASE WHEN NOT ok THEN ['parsing_error'] ELSE list_filter([CASE WHEN overall < CASE WHEN critical THEN 0.95 WHEN is_diagram THEN 0.9 ELSE 0.85 END THEN 'low_confidence' END, CASE WHEN h > 0.5 THEN 'hallucination_detected' END,
    CASE WHEN e < 0.5 AND element_type IN ('table', 'diagram') THEN 'incomplete_data' END, CASE WHEN critical AND overall < 0.95 THEN 'critical_document' END,
    CASE WHEN is_diagram AND NOT ({_count(ops.DIAGRAM_TERMS, "coalesce(low, '')")} >= 2 AND {_any(ops.RELATIONS, "coalesce(low, '')")}) THEN 'diagram_type' END], lambda x: x IS NOT NULL) END AS reasons FROM j)
"""


@query(
    JUDGED + "SELECT analysis_id, CAST(overall AS DOUBLE) AS overall, CAST(CASE WHEN ok THEN t ELSE 0.0 END AS DOUBLE) AS text_quality, CAST(CASE WHEN ok THEN e ELSE 0.0 END AS DOUBLE) AS completeness, CAST(CASE WHEN ok THEN h ELSE 1.0 END AS DOUBLE) AS hallucination, reasons, len(reasons) > 0 AS needs_fallback FROM r"
)
def confidence_eval(spark: SparkSession, d: str) -> DataFrame:
    return ops.evaluate(table(spark, d, "analysis_results")).select("analysis_id", "overall", "text_quality", "completeness", "hallucination", "reasons", "needs_fallback")


@query(
    JUDGED + """SELECT analysis_id, CAST(CASE WHEN list_contains(reasons, 'critical_document') THEN 0.1 WHEN list_contains(reasons, 'diagram_type') THEN 0.2 WHEN list_contains(reasons, 'hallucination_detected') THEN 0.1 ELSE 0.3 END AS DOUBLE) AS temperature,
      CASE WHEN list_contains(reasons, 'critical_document') OR list_contains(reasons, 'incomplete_data') THEN 1024 ELSE 512 END AS max_tokens,
      CASE WHEN list_contains(reasons, 'critical_document') THEN 'exhaustive_analysis' WHEN list_contains(reasons, 'diagram_type') THEN 'diagram_analysis' WHEN list_contains(reasons, 'incomplete_data') THEN 'detailed_analysis' WHEN list_contains(reasons, 'hallucination_detected') THEN 'precise_extraction' ELSE 'comprehensive' END AS focus FROM r"""
)
def fallback_config(spark: SparkSession, d: str) -> DataFrame:
    temperature, tokens, focus = ops.fallback_settings(F.col("reasons"))
    return ops.evaluate(table(spark, d, "analysis_results")).select("analysis_id", temperature.alias("temperature"), tokens.alias("max_tokens"), focus.alias("focus"))


@query(
    """SELECT content_hash, round(avg(confidence), 6) AS confidence, arg_min(model_used, (-coalesce(confidence, -1.0), model_used)) AS best_model, count(DISTINCT model_used) AS n_models, round(coalesce(sum(processing_time_seconds), 0.0), 4) AS total_seconds,
       (SELECT e FROM (SELECT element_type AS e, count(*) AS n FROM analysis_results x WHERE x.content_hash = a.content_hash AND element_type IS NOT NULL GROUP BY element_type) ORDER BY n DESC, e LIMIT 1) AS element_type FROM analysis_results a GROUP BY content_hash"""
)
def consensus(spark: SparkSession, d: str) -> DataFrame:
    return ops.consensus(table(spark, d, "analysis_results"))


@query("SELECT chunk_row_id, visual_id FROM chunks c JOIN visuals v ON v.document_id = c.document_id AND v.page_number BETWEEN c.page_range.start_page AND c.page_range.end_page WHERE v.page_number > 0")
def range_join_visuals(spark: SparkSession, d: str) -> DataFrame:
    return ops.visuals_in_pages(table(spark, d, "chunks"), table(spark, d, "visuals"))


@query(
    """WITH v AS (SELECT content_hash, arg_min(vlm_description, visual_id) AS description FROM visuals WHERE vlm_description IS NOT NULL GROUP BY content_hash),
    r AS (SELECT segment_id, unnest(visual_references) AS h, generate_subscripts(visual_references, 1) AS pos FROM segments),
    f AS (SELECT segment_id, arg_min(description, pos) AS description FROM r JOIN v ON v.content_hash = r.h GROUP BY segment_id)
    SELECT segment_id, coalesce(description, content) AS content, description IS NOT NULL AS replaced FROM segments LEFT JOIN f USING (segment_id)"""
)
def vlm_into_segments(spark: SparkSession, d: str) -> DataFrame:
    return ops.describe_segments(table(spark, d, "segments"), table(spark, d, "visuals"))


@query(
    "SELECT segment_id, list(h ORDER BY pos, h) AS refs FROM (SELECT segment_id, unnest(visual_references) AS h, generate_subscripts(visual_references, 1) AS pos FROM segments) WHERE h IN (SELECT content_hash FROM visuals) GROUP BY segment_id"
)
def semi_refs(spark: SparkSession, d: str) -> DataFrame:
    return ops.known_references(table(spark, d, "segments"), table(spark, d, "visuals"))


def _pages(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    pages = table(spark, d, "page_extractions")
    model = pages.groupBy("document_id", "page_number").agg(F.min_by(F.struct("text", "confidence"), "page_id").alias("r")).select("document_id", "page_number", "r.*")
    fallback = table(spark, d, "segments").where("page_number IS NOT NULL").select("document_id", "page_number", F.col("segment_id").alias("ord"), F.col("content").alias("text"))
    return model, fallback


_MODEL = "model AS (SELECT document_id, page_number, arg_min(r, page_id).text AS text, arg_min(r, page_id).confidence AS confidence FROM (SELECT document_id, page_number, page_id, {'text': text, 'confidence': confidence} AS r FROM page_extractions) GROUP BY document_id, page_number)"


@query(
    f"""WITH {_MODEL}, first AS (SELECT document_id, page_number, arg_min(content, segment_id) AS f FROM segments WHERE page_number IS NOT NULL GROUP BY document_id, page_number)
    SELECT document_id, page_number, CASE WHEN confidence >= 0.8 THEN text ELSE coalesce(f, text) END AS text, CASE WHEN confidence >= 0.8 THEN 'model' WHEN f IS NOT NULL THEN 'fallback' ELSE 'model' END AS origin FROM model FULL JOIN first USING (document_id, page_number)"""
)
def page_merge_outer(spark: SparkSession, d: str) -> DataFrame:
    return ops.merge_pages(*_pages(spark, d))


@query(
    f"""WITH RECURSIVE {_MODEL}, f AS (SELECT document_id, page_number, content AS x, row_number() OVER (PARTITION BY document_id, page_number ORDER BY segment_id) AS k FROM segments WHERE page_number IS NOT NULL),
    w AS (SELECT document_id, page_number, coalesce(text, '') AS merged, 0 AS k FROM model UNION ALL SELECT w.document_id, w.page_number, CASE WHEN length(f.x) > length(w.merged) * 1.2 THEN f.x ELSE w.merged END, f.k FROM w JOIN f ON f.document_id = w.document_id AND f.page_number = w.page_number AND f.k = w.k + 1)
    SELECT document_id, page_number, arg_max(merged, k) AS merged FROM w GROUP BY document_id, page_number"""
)
def fallback_replace(spark: SparkSession, d: str) -> DataFrame:
    model, fallback = _pages(spark, d)
    return ops.replace_weak_pages(model, fallback).select("document_id", "page_number", "merged")


_STAGES = """general AS (SELECT content_hash, arg_min(description, analysis_id) AS description, arg_min(confidence, analysis_id) AS confidence FROM (SELECT content_hash, analysis_id, coalesce(description, '') AS description, coalesce(confidence, 0.0) AS confidence FROM analysis_results WHERE model_used IN ('llava', 'smoldocling', 'ocr_bridge', 'llama32_vision')) GROUP BY content_hash),
precise AS (SELECT content_hash, arg_min(description, analysis_id) AS description, arg_min(confidence, analysis_id) AS confidence FROM (SELECT content_hash, analysis_id, coalesce(description, '') AS description, coalesce(confidence, 0.0) AS confidence FROM analysis_results WHERE model_used IN ('pixtral', 'qwen25_vl')) GROUP BY content_hash)"""


@query(
    f"""WITH {_STAGES} SELECT g.content_hash, CASE WHEN p.content_hash IS NOT NULL THEN p.description ELSE g.description END AS description, CASE WHEN p.content_hash IS NOT NULL THEN p.confidence ELSE g.confidence END AS confidence,
    CASE WHEN p.content_hash IS NOT NULL THEN 'precise' ELSE 'general' END AS stage FROM general g LEFT JOIN precise p USING (content_hash)
    UNION ALL SELECT content_hash, description, confidence, 'precise' FROM precise WHERE content_hash NOT IN (SELECT content_hash FROM general)"""
)
def two_stage_merge(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "analysis_results").withColumns({"description": F.coalesce("description", F.lit("")), "confidence": F.coalesce("confidence", F.lit(0.0))})
    one = lambda precise: (
        rows.where(F.col("model_used").isin("pixtral", "qwen25_vl") == precise).groupBy("content_hash").agg(F.min_by(F.struct("description", "confidence"), "analysis_id").alias("r")).select("content_hash", "r.*")
    )
    return ops.merge_stages(one(False), one(True))


@query(
    """WITH n AS (SELECT * FROM segments WHERE segment_type IN ('table','visual') OR (segment_type = 'text' AND (segment_subtype = 'list' OR contains(content, '•') OR contains(content, '●') OR contains(content, '- ') OR contains(content, '* ')
        OR contains(content, '1.') OR contains(content, '2.') OR contains(content, 'a)') OR contains(content, 'b)')))),
    p AS (SELECT document_id, page_number, arg_min(segment_id, (segment_index, segment_id)) AS s FROM n WHERE page_number IS NOT NULL GROUP BY ALL),
    r AS (SELECT document_id, h, arg_min(segment_id, (segment_index, segment_id)) AS s FROM (SELECT document_id, segment_index, segment_id, unnest(visual_references) AS h FROM segments) GROUP BY ALL)
    SELECT visual_id, coalesce(p.s, r.s) AS segment_id FROM visuals v LEFT JOIN p ON p.document_id = v.document_id AND p.page_number = v.page_number LEFT JOIN r ON r.document_id = v.document_id AND r.h = v.content_hash"""
)
def image_context(spark: SparkSession, d: str) -> DataFrame:
    return ops.image_context(table(spark, d, "segments"), table(spark, d, "visuals"))


@query("SELECT s.segment_id, p.n_pages, p.confidence FROM segments s LEFT JOIN (SELECT document_id, page_number, count(*) AS n_pages, max(confidence) AS confidence FROM page_extractions GROUP BY ALL) p ON p.document_id = s.document_id AND p.page_number = s.page_number")
def page_context(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "page_extractions").groupBy("document_id", "page_number").agg(F.count("*").alias("n_pages"), F.max("confidence").alias("confidence"))
    return table(spark, d, "segments").select("segment_id", "document_id", "page_number").join(pages, ["document_id", "page_number"], "left").select("segment_id", "n_pages", "confidence")


@query(
    """SELECT visual_id, n_results, best_analysis FROM visuals LEFT JOIN (SELECT content_hash, count(*) AS n_results, arg_min(analysis_id, (-coalesce(confidence, -1.0), analysis_id)) AS best_analysis FROM analysis_results GROUP BY content_hash) USING (content_hash)"""
)
def results_by_hash(spark: SparkSession, d: str) -> DataFrame:
    return ops.best_results(table(spark, d, "visuals"), table(spark, d, "analysis_results"))


@query(
    """SELECT visual_id, bbox[1] * 1.2 AS x, bbox[2] * 1.6 AS y, (bbox[3] - bbox[1]) * 1.2 AS width, (bbox[4] - bbox[2]) * 1.6 AS height FROM (SELECT visual_id, CAST(bbox AS DOUBLE[]) AS bbox FROM visuals WHERE len(bbox) = 4)"""
)
def scaled_boxes(spark: SparkSession, d: str) -> DataFrame:
    box = ops.scaled_box(F.col("bbox").cast("array<double>"), 600.0, 800.0)
    return table(spark, d, "visuals").where(F.size("bbox") == 4).select("visual_id", box.alias("b")).select("visual_id", "b.x", "b.y", "b.width", "b.height")


@query(
    """SELECT visual_id, CASE WHEN h = 0 THEN 'unknown_visual' WHEN w / h > 2.0 THEN 'chart' WHEN w / h BETWEEN 0.8 AND 1.2 THEN 'diagram' ELSE 'image' END AS kind FROM (SELECT visual_id, CAST(bbox[3] - bbox[1] AS DOUBLE) AS w, CAST(bbox[4] - bbox[2] AS DOUBLE) AS h FROM visuals WHERE len(bbox) = 4)"""
)
def aspect_types(spark: SparkSession, d: str) -> DataFrame:
    b = F.col("bbox")
    return table(spark, d, "visuals").where(F.size(b) == 4).select("visual_id", ops.aspect_type(b[2] - b[0], b[3] - b[1]).alias("kind"))


@query(
    "SELECT visual_id, CASE WHEN element_type IN ('diagram', 'table', 'chart') THEN 'precise' ELSE 'general' END AS route FROM visuals"
)
def image_routing(spark: SparkSession, d: str) -> DataFrame:
    route = F.when(F.col("element_type").isin("diagram", "table", "chart"), "precise").otherwise("general")
    return table(spark, d, "visuals").select("visual_id", route.alias("route"))


@query("SELECT document_id, visual_id FROM visuals QUALIFY row_number() OVER (PARTITION BY document_id ORDER BY page_number NULLS LAST, visual_id) <= 3")
def images_per_document(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("document_id").orderBy(F.asc_nulls_last("page_number"), "visual_id")
    return table(spark, d, "visuals").withColumn("n", F.row_number().over(w)).where("n <= 3").select("document_id", "visual_id")


_SPANS = "spans AS (SELECT doc_id, CAST(k * 40 AS INTEGER) AS start_pos, CAST(k * 40 + 20 + (doc_id * (k + 3)) % 45 AS INTEGER) AS end_pos FROM (SELECT doc_id, unnest(range(0, 6)) AS k, length(text) AS n FROM documents WHERE text IS NOT NULL) WHERE k * 40 + 20 + (doc_id * (k + 3)) % 45 <= n)"
_MERGED = f"""WITH {_SPANS}, b AS (SELECT *, max(end_pos) OVER (PARTITION BY doc_id ORDER BY start_pos, end_pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM spans),
o AS (SELECT *, sum(CASE WHEN before IS NULL OR start_pos > before THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY start_pos, end_pos) AS n FROM b),
merged AS (SELECT doc_id, min(start_pos) AS start_pos, max(end_pos) AS end_pos FROM o GROUP BY doc_id, n)"""


def _spans(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").where("text IS NOT NULL").select("doc_id", F.length("text").alias("n"), F.explode(F.sequence(F.lit(0), F.lit(5))).alias("k"))
    rows = rows.withColumn("end_pos", (F.col("k") * 40 + 20 + (F.col("doc_id") * (F.col("k") + 3)) % 45).cast("int")).where("end_pos <= n")
    return rows.select("doc_id", (F.col("k") * 40).cast("int").alias("start_pos"), "end_pos")


@query(_MERGED + " SELECT doc_id, start_pos, end_pos FROM merged")
def interval_merge(spark: SparkSession, d: str) -> DataFrame:
    return intervals.merge_spans(_spans(spark, d), "doc_id")


@query(
    _MERGED + """, e AS (SELECT doc_id, coalesce(lag(end_pos) OVER w, 0) AS a, start_pos AS b FROM merged WINDOW w AS (PARTITION BY doc_id ORDER BY start_pos)
      UNION ALL SELECT d.doc_id, coalesce(m.e, 0), CAST(length(d.text) AS INTEGER) FROM documents d LEFT JOIN (SELECT doc_id, max(end_pos) AS e FROM merged GROUP BY doc_id) m USING (doc_id) WHERE d.text IS NOT NULL)
    SELECT doc_id, a AS start_pos, substr(text, a + 1, b - a) AS content FROM e JOIN documents USING (doc_id) WHERE b > a"""
)
def interval_complement(spark: SparkSession, d: str) -> DataFrame:
    documents = table(spark, d, "documents").where("text IS NOT NULL")
    return intervals.outside(documents, intervals.merge_spans(_spans(spark, d), "doc_id"), "doc_id", "text")


_PAIRS = """m AS (SELECT content_hash, arg_min(description, analysis_id) AS d1, arg_max(description, analysis_id) AS d2, arg_min(confidence, analysis_id) AS c1, arg_max(confidence, analysis_id) AS c2 FROM (
  SELECT content_hash, analysis_id, coalesce(description, '') AS description, coalesce(confidence, 0.0) AS confidence FROM analysis_results) GROUP BY content_hash)"""


def _result_pairs(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "analysis_results").select("content_hash", "analysis_id", F.coalesce("description", F.lit("")).alias("description"), F.lit(None).cast("string").alias("ocr_text"), F.coalesce("confidence", F.lit(0.0)).alias("confidence"))
    result = F.struct("description", "ocr_text", "confidence", F.col("confidence").alias("overall"))
    return rows.groupBy("content_hash").agg(F.min_by(result, "analysis_id").alias("first"), F.max_by(result, "analysis_id").alias("second"))


@query(f"WITH {_PAIRS} SELECT content_hash, CASE WHEN c2 > c1 THEN d2 ELSE d1 END AS description, greatest(c1, c2) AS confidence FROM m")
def merge_best(spark: SparkSession, d: str) -> DataFrame:
    return ops.merge_results(_result_pairs(spark, d), "best").select("content_hash", "merged.description", "merged.confidence")


@query(f"WITH {_PAIRS} SELECT content_hash, d1 || chr(10) || chr(10) || 'Additional details: ' || d2 AS description, greatest(c1, c2) AS confidence FROM m")
def merge_combine(spark: SparkSession, d: str) -> DataFrame:
    return ops.merge_results(_result_pairs(spark, d), "combine").select("content_hash", "merged.description", "merged.confidence")


_RESULTS = "r AS (SELECT content_hash, analysis_id, coalesce(description, '') AS description, coalesce(confidence, 0.0) AS confidence FROM analysis_results)"


def _results(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "analysis_results").select("content_hash", "analysis_id", F.coalesce("description", F.lit("")).alias("description"), F.coalesce("confidence", F.lit(0.0)).alias("confidence"))


@query(f"WITH {_RESULTS} SELECT content_hash, arg_min(description, (-confidence, analysis_id)) AS description, max(confidence) AS confidence FROM r GROUP BY content_hash")
def merge_best_all(spark: SparkSession, d: str) -> DataFrame:
    """The best of all results of a hash, the first where equal."""
    best = F.min_by(F.struct("description", "confidence"), F.struct(-F.col("confidence"), F.col("analysis_id")))
    return _results(spark, d).groupBy("content_hash").agg(best.alias("r")).select("content_hash", "r.*")


@query(f"WITH {_RESULTS} SELECT content_hash, string_agg(description, chr(10) || chr(10) || 'Additional details: ' ORDER BY analysis_id) AS description, max(confidence) AS confidence FROM r GROUP BY content_hash")
def merge_combine_all(spark: SparkSession, d: str) -> DataFrame:
    """The descriptions of all results of a hash in order, and the highest confidence."""
    listed = F.transform(F.array_sort(F.collect_list(F.struct("analysis_id", "description"))), lambda r: r["description"])
    return _results(spark, d).groupBy("content_hash").agg(F.array_join(listed, "\n\nAdditional details: ").alias("description"), F.max("confidence").alias("confidence"))


@query(
    """SELECT v.visual_id FROM visuals v WHERE len(v.bbox) = 4 AND v.page_number IS NOT NULL AND NOT EXISTS (SELECT 1 FROM visuals b WHERE b.document_id = v.document_id AND b.page_number = v.page_number AND b.visual_id <> v.visual_id AND b.element_type = 'table_image'
       AND len(b.bbox) = 4 AND v.bbox[1] BETWEEN b.bbox[1] AND b.bbox[3] AND v.bbox[2] BETWEEN b.bbox[2] AND b.bbox[4]) AND v.element_type <> 'table_image'"""
)
def outside_tables(spark: SparkSession, d: str) -> DataFrame:
    b = F.col("bbox")
    rows = table(spark, d, "visuals").where(F.size(b) == 4)
    points = rows.where("page_number IS NOT NULL AND element_type <> 'table_image'").select("visual_id", "document_id", "page_number", b[0].alias("x"), b[1].alias("y"))
    boxes = rows.where("element_type = 'table_image'").select("document_id", "page_number", b[0].alias("x0"), b[1].alias("y0"), b[2].alias("x1"), b[3].alias("y1"))
    return ops.outside_boxes(points, boxes).select("visual_id")


@query("SELECT document_id, page_number, list(visual_id ORDER BY visual_id) AS visual_ids FROM visuals GROUP BY document_id, page_number")
def visuals_by_page(spark: SparkSession, d: str) -> DataFrame:
    return ops.visuals_by_page(table(spark, d, "visuals"))


@query(
    "SELECT segment_id, debug_id FROM segments s JOIN segment_debug USING (document_id, segment_index) UNION SELECT DISTINCT s.segment_id, g.debug_id FROM (SELECT segment_id, document_id, unnest(visual_references) AS h FROM segments) s JOIN visuals v ON v.document_id = s.document_id AND v.content_hash = s.h JOIN segment_debug g ON g.document_id = v.document_id AND 'segment_' || g.segment_index = v.segment_reference"
)
def debug_events(spark: SparkSession, d: str) -> DataFrame:
    s, g = table(spark, d, "segments"), table(spark, d, "segment_debug").select("document_id", "segment_index", "debug_id")
    by_index = s.select("segment_id", "document_id", "segment_index").join(g, ["document_id", "segment_index"]).select("segment_id", "debug_id")
    refs = s.select("segment_id", "document_id", F.explode("visual_references").alias("content_hash")).join(table(spark, d, "visuals").select("document_id", "content_hash", "segment_reference"), ["document_id", "content_hash"])
    named = g.withColumn("segment_reference", F.concat(F.lit("segment_"), F.col("segment_index").cast("string"))).drop("segment_index")
    return by_index.unionByName(refs.join(named, ["document_id", "segment_reference"]).select("segment_id", "debug_id")).distinct()


@query("SELECT segment_id, list(content_hash ORDER BY visual_id) AS refs FROM segments s JOIN visuals v ON v.document_id = s.document_id AND v.segment_reference = 'segment_' || s.segment_index WHERE content_hash IS NOT NULL GROUP BY segment_id")
def refs_by_place(spark: SparkSession, d: str) -> DataFrame:
    return ops.by_reference(table(spark, d, "segments"), F.concat(F.lit("segment_"), F.col("segment_index").cast("string")), table(spark, d, "visuals"), F.col("segment_reference"))


@query("SELECT segment_id, list(content_hash ORDER BY visual_id) AS refs FROM segments s JOIN visuals v ON v.document_id = s.document_id AND v.page_number = s.page_number WHERE content_hash IS NOT NULL GROUP BY segment_id")
def refs_by_slide(spark: SparkSession, d: str) -> DataFrame:
    return ops.by_reference(table(spark, d, "segments"), F.col("page_number"), table(spark, d, "visuals"), F.col("page_number"))


_TEN = "SELECT o_orderpriority, o_orderstatus, string_agg(CAST(o_orderkey AS VARCHAR), ', ' ORDER BY o_orderkey) AS v FROM (SELECT *, row_number() OVER (PARTITION BY o_orderpriority, o_orderstatus ORDER BY o_orderkey) AS k FROM orders) WHERE k <= 10 GROUP BY ALL"


@query(f"SELECT o_orderpriority, 'Chart Title: ' || o_orderpriority || chr(10) || 'Chart Type: BarChart' || chr(10) || 'Data Series:' || chr(10) || string_agg('  ' || o_orderstatus || ': ' || v, chr(10) ORDER BY o_orderstatus) AS chart FROM ({_TEN}) GROUP BY o_orderpriority")
def chart_texts(spark: SparkSession, d: str) -> DataFrame:
    """A chart for each priority, a series for each status; of a series only the values that are shown are brought together."""
    first = first_of_each(table(spark, d, "orders"), ["o_orderpriority", "o_orderstatus"], [F.col("o_orderkey")], 10)
    series = first.groupBy("o_orderpriority", F.col("o_orderstatus").alias("title")).agg(F.transform(F.array_sort(F.collect_list("o_orderkey")), lambda x: x.cast("string")).alias("values"))
    charts = series.groupBy("o_orderpriority").agg(F.array_sort(F.collect_list(F.struct("title", "values"))).alias("series"))
    return charts.select("o_orderpriority", ops.chart_text(F.col("o_orderpriority"), F.lit("BarChart"), F.col("series")).alias("chart"))


@query("SELECT visual_id, CASE WHEN h = 0 THEN 'unknown_visual' WHEN w / h > 2.5 THEN 'chart' WHEN w / h BETWEEN 0.8 AND 1.2 THEN 'diagram' WHEN w > 300 AND h > 200 THEN 'chart' ELSE 'image' END AS kind FROM (SELECT visual_id, CAST(bbox[3] - bbox[1] AS DOUBLE) AS w, CAST(bbox[4] - bbox[2] AS DOUBLE) AS h FROM visuals WHERE len(bbox) = 4)")
def aspect_types_text(spark: SparkSession, d: str) -> DataFrame:
    b = F.col("bbox")
    return table(spark, d, "visuals").where(F.size(b) == 4).select("visual_id", ops.aspect_type(b[2] - b[0], b[3] - b[1], "text").alias("kind"))


@query("SELECT visual_id, list_transform(bbox, lambda x: CAST(x AS INTEGER)) AS tagged, list_transform(bbox, lambda x: CAST(x AS INTEGER)) AS plain FROM visuals WHERE len(bbox) = 4 AND list_min(bbox) >= 0")
def boxes_in_text(spark: SparkSession, d: str) -> DataFrame:
    """Every box written in both ways and read back."""
    rows = table(spark, d, "visuals").where((F.size("bbox") == 4) & (F.array_min("bbox") >= 0))
    tagged = F.array_join(F.transform("bbox", lambda x: F.concat(F.lit("<loc_"), x.cast("string"), F.lit(">"))), "")
    plain = F.array_join(F.transform("bbox", lambda x: F.concat(x.cast("string"), F.lit(">"))), "")
    return rows.select("visual_id", ops.boxes_of(tagged).alias("tagged"), ops.boxes_of(plain).alias("plain"))


@query("SELECT visual_id, CASE WHEN element_type IN ('table', 'table_image') AND regexp_matches(lower(extracted_data), 'motor|modell|leistung|power') THEN 'motorization' END AS kind FROM visuals")
def table_kinds(spark: SparkSession, d: str) -> DataFrame:
    element = F.when(F.col("element_type") == "table_image", "table").otherwise(F.col("element_type"))
    return table(spark, d, "visuals").select("visual_id", ops.table_kind(F.lit("technical_specification"), element, F.col("extracted_data")).alias("kind"))


@query("SELECT visual_id FROM visuals WHERE element_type = 'chart' AND page_number = 2")
def visuals_of_type(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "visuals").where("element_type = 'chart' AND page_number = 2").select("visual_id")


@query("SELECT document_id, visual_id FROM visuals WHERE element_type IN ('chart', 'diagram') QUALIFY row_number() OVER (PARTITION BY document_id, element_type ORDER BY visual_id) <= 5")
def compared_elements(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "visuals").where("element_type IN ('chart', 'diagram')")
    return first_of_each(rows, ["document_id", "element_type"], [F.col("visual_id")], 5).select("document_id", "visual_id")
