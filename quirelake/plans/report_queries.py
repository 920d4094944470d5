"""Queries on runs, documents and models."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirelake.common import table
from quirelake.operators import reports as ops
from quirelake.operators.packing import pack
from quirelake.operators.segments import nearest_heading, reindexed
from quirelake.plans.registry import Registry
from quirelake.streaming.ingest import windowed_counts

registry = Registry()
query = registry.add

_RUN = """count(*) AS total, count(*) FILTER (coalesce(success, false)) AS processed, count(*) FILTER (NOT coalesce(success, false)) AS failed, round(sum(processing_time_seconds), 4) AS seconds,
    round(avg(processing_time_seconds) FILTER (coalesce(success, false)), 6) AS mean_seconds, round(coalesce(count(*) FILTER (coalesce(success, false)) / count(*), 0.0), 6) AS success_rate"""


@query(f"SELECT {_RUN} FROM parse_results")
def batch_report(spark: SparkSession, d: str) -> DataFrame:
    return ops.run_report(table(spark, d, "parse_results"), [], F.col("success"), F.col("processing_time_seconds"))


@query(f"SELECT model_used, {_RUN} FROM analysis_results GROUP BY model_used")
def model_stats(spark: SparkSession, d: str) -> DataFrame:
    return ops.run_report(table(spark, d, "analysis_results"), ["model_used"], F.col("success"), F.col("processing_time_seconds"))


@query("SELECT model_version, arg_max(error_message, (created_at, result_id)) FILTER (error_message IS NOT NULL) AS last_error, count(*) AS n FROM parse_results GROUP BY model_version")
def client_metrics(spark: SparkSession, d: str) -> DataFrame:
    key = F.when(F.col("error_message").isNotNull(), F.struct("created_at", "result_id"))
    return table(spark, d, "parse_results").groupBy("model_version").agg(F.max_by("error_message", key).alias("last_error"), F.count("*").alias("n"))


@query("SELECT element_type, count(*) AS triple_count, round(coalesce(avg(confidence), 0.0), 6) AS average, coalesce(min(confidence), 0.0) AS least, coalesce(max(confidence), 0.0) AS most FROM analysis_results GROUP BY element_type")
def confidence_stats(spark: SparkSession, d: str) -> DataFrame:
    return ops.extraction_confidence(table(spark, d, "analysis_results"), ["element_type"])


@query(
    """SELECT *, round(coalesce(successful_files * 100.0 / total_files, 0.0), 6) AS success_rate, round(coalesce(total_seconds / nullif(successful_files, 0), 0.0), 6) AS average_seconds, CASE WHEN successful_files > 1 THEN 30.0 * (successful_files - 1) ELSE 0.0 END AS seconds_saved
    FROM (SELECT model_version, count(*) AS total_files, count(*) FILTER (success) AS successful_files, count(*) FILTER (NOT coalesce(success, false)) AS failed_files, round(sum(processing_time_seconds), 4) AS total_seconds FROM parse_results GROUP BY model_version)"""
)
def batch_stats(spark: SparkSession, d: str) -> DataFrame:
    return ops.batch_statistics(table(spark, d, "parse_results"), ["model_version"], 30.0)


@query(
    """SELECT model_used, count(*) AS total_requests, count(*) FILTER (success) AS successful_requests, count(*) FILTER (NOT coalesce(success, false)) AS failed_requests, round(coalesce(sum(processing_time_seconds * 1000) FILTER (success), 0.0), 3) AS total_ms,
    round(coalesce(avg(processing_time_seconds * 1000) FILTER (success), 0.0), 6) AS average_ms, arg_max(error_message, (created_at, analysis_id)) FILTER (NOT coalesce(success, false) AND error_message IS NOT NULL) AS last_error,
    arg_max(created_at, (created_at, analysis_id)) FILTER (NOT coalesce(success, false) AND error_message IS NOT NULL) AS last_error_time FROM analysis_results GROUP BY model_used"""
)
def client_stats(spark: SparkSession, d: str) -> DataFrame:
    return ops.client_statistics(table(spark, d, "analysis_results"), ["model_used"], "created_at", "analysis_id")


@query(
    """SELECT *, round(coalesce(successful_operations / total_operations, 0.0), 6) AS success_rate FROM (SELECT extraction_method, count(*) AS total_operations, count(*) FILTER (success) AS successful_operations, count(*) FILTER (NOT coalesce(success, false)) AS failed_operations,
    round(coalesce(avg(processing_time_seconds) FILTER (success), 0.0), 6) AS average_seconds, round(coalesce(avg(coalesce(total_pages / nullif(processing_time_seconds, 0), 0.0)) FILTER (success), 0.0), 6) AS average_throughput FROM parse_results GROUP BY extraction_method)"""
)
def inference_stats(spark: SparkSession, d: str) -> DataFrame:
    return ops.inference_summary(table(spark, d, "parse_results"), ["extraction_method"], F.col("total_pages"), F.col("processing_time_seconds"))


@query(
    """SELECT *, round(coalesce(total_seconds / nullif(total_elements, 0), 0.0), 6) AS average_seconds FROM (SELECT count(*) AS total_elements, count(*) FILTER (error_message IS NULL) AS successful, count(*) FILTER (error_message IS NOT NULL) AS failed, count(*) FILTER (NOT s) AS stage1, count(*) FILTER (s) AS stage2,
    round(coalesce(avg(c) FILTER (error_message IS NULL), 0.0), 6) AS average_confidence, count(*) FILTER (c >= 0.8) AS high, count(*) FILTER (c >= 0.5 AND c < 0.8) AS medium, count(*) FILTER (c < 0.5) AS low, round(coalesce(sum(t), 0.0), 3) AS total_seconds,
    round(coalesce(sum(t) FILTER (NOT s), 0.0), 3) AS stage1_seconds, round(coalesce(sum(t) FILTER (s), 0.0), 3) AS stage2_seconds FROM (SELECT error_message, coalesce(confidence, 0.0) AS c, coalesce(processing_time_seconds, 0.0) AS t, coalesce(model_used = 'pixtral', false) AS s FROM analysis_results))"""
)
def stage_stats(spark: SparkSession, d: str) -> DataFrame:
    return ops.stage_statistics(table(spark, d, "analysis_results"), ("pixtral",))


@query(
    """WITH e AS (SELECT segment_type, segment_subtype, last_value(CASE WHEN segment_subtype IN ('heading_1','heading_2','heading_3','title','subtitle') THEN content END IGNORE NULLS) OVER (PARTITION BY document_id ORDER BY segment_index, segment_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS context FROM segments)
    SELECT count(*) AS total_segments, count(*) FILTER (context <> '') AS enhanced_segments, count(*) FILTER (context <> '' AND segment_type = 'table') AS tables_with_context, count(*) FILTER (context <> '' AND segment_subtype = 'list') AS lists_with_context,
    count(*) FILTER (context <> '' AND segment_type = 'visual') AS visuals_with_context FROM e"""
)
def context_stats(spark: SparkSession, d: str) -> DataFrame:
    return ops.context_statistics(nearest_heading(table(spark, d, "segments")).withColumnRenamed("nearest_heading", "context"))


@query(
    """WITH o AS (SELECT *, row_number() OVER (PARTITION BY content_hash ORDER BY analysis_id) AS k FROM analysis_results), f AS (SELECT content_hash, confidence, description FROM o WHERE k = 1),
    s AS (SELECT content_hash, arg_max(struct_pack(c := confidence, t := description), (coalesce(confidence, -1.0), description)) AS r FROM o WHERE k > 1 AND description IS NOT NULL GROUP BY content_hash)
    SELECT content_hash, coalesce(f.confidence, 0.0) < 0.7 AND s.content_hash IS NOT NULL AS was_retried, CASE WHEN coalesce(f.confidence, 0.0) < 0.7 AND coalesce(r.c, 0.0) > coalesce(f.confidence, 0.0) THEN r.c ELSE f.confidence END AS confidence,
      CASE WHEN coalesce(f.confidence, 0.0) < 0.7 AND coalesce(r.c, 0.0) > coalesce(f.confidence, 0.0) THEN r.t ELSE f.description END AS description FROM f LEFT JOIN s USING (content_hash)"""
)
def retried_results(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "analysis_results")
    first = rows.groupBy("content_hash").agg(F.min_by(F.struct("analysis_id", "confidence", "description"), "analysis_id").alias("r")).select("content_hash", "r.*")
    later = rows.where("description IS NOT NULL").join(first.select("analysis_id"), "analysis_id", "left_anti")
    return ops.retried(first.drop("analysis_id"), later, "content_hash")


_LAST = "SELECT document_id, arg_max(struct_pack(s := success, p := total_pages, m := extraction_method, v := model_version, e := error_message), (created_at, result_id)) AS r FROM parse_results WHERE document_id IS NOT NULL GROUP BY document_id"
_STRING = "'\"' || replace(replace(replace(replace({}, '\\', '\\\\'), '\"', '\\\"'), chr(10), '\\n'), '/', '/') || '\"'"


@query(
    f"""WITH l AS ({_LAST}) SELECT CASE WHEN r.s THEN 'processed' ELSE 'error' END AS kind, document_id, '{{"document_id":' || {_STRING.format("document_id")} || CASE WHEN r.s THEN ',"status":"completed"' || coalesce(',"total_pages":' || r.p, '') || coalesce(',"extraction_method":' || {_STRING.format("r.m")}, '')
      || coalesce(',"model_version":' || {_STRING.format("r.v")}, '') ELSE ',"status":"failed"' || coalesce(',"error_message":' || {_STRING.format("r.e")}, '') END || '}}' AS json FROM l"""
)
def run_json(spark: SparkSession, d: str) -> DataFrame:
    return ops.run_records(table(spark, d, "parse_results"))


@query(f"""WITH l AS ({_LAST}) SELECT '{{"total_documents":' || count(*) || ',"processed":' || count(*) FILTER (r.s) || ',"failed":' || count(*) FILTER (NOT coalesce(r.s, false)) || '}}' AS json FROM l""")
def run_summary_json(spark: SparkSession, d: str) -> DataFrame:
    return ops.run_summary(ops.run_records(table(spark, d, "parse_results")))


@query(
    f"""WITH h AS (SELECT *, last_value(CASE WHEN segment_subtype IN ('heading_1','heading_2','heading_3','title','subtitle') THEN content END IGNORE NULLS) OVER (PARTITION BY document_id ORDER BY segment_index, segment_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS c FROM segments),
    k AS (SELECT content_hash, arg_min(struct_pack(i := visual_id, t := element_type), visual_id) AS v FROM visuals GROUP BY content_hash),
    r AS (SELECT segment_id, '[' || string_agg('{{"visual_id":' || v.i || coalesce(',"element_type":' || {_STRING.format("v.t")}, '') || '}}', ',' ORDER BY pos) || ']' AS visuals FROM (SELECT segment_id, unnest(visual_references) AS content_hash, generate_subscripts(visual_references, 1) AS pos FROM segments) JOIN k USING (content_hash) GROUP BY segment_id)
    SELECT segment_id, '{{"segment_id":' || segment_id || coalesce(',"document_id":' || {_STRING.format("document_id")}, '') || coalesce(',"segment_index":' || segment_index, '') || coalesce(',"segment_type":' || {_STRING.format("segment_type")}, '') || coalesce(',"segment_subtype":' || {_STRING.format("segment_subtype")}, '')
      || coalesce(',"content_length":' || length(content), '') || coalesce(',"context":' || {_STRING.format("c")}, '') || coalesce(',"visuals":' || visuals, '') || '}}' AS json FROM h LEFT JOIN r USING (segment_id)"""
)
def debug_json(spark: SparkSession, d: str) -> DataFrame:
    return ops.debug_records(nearest_heading(table(spark, d, "segments")), F.col("nearest_heading"), table(spark, d, "visuals"))


@query(
    """WITH s AS (SELECT document_id, count(*) AS n_segments, count(DISTINCT segment_type) AS n_segment_types FROM segments GROUP BY document_id),
    v AS (SELECT document_id, count(*) AS n_visuals, count(DISTINCT element_type) AS n_visual_types, count(DISTINCT CASE WHEN page_number > 0 THEN page_number END) AS pages_with_visuals,
        count(*) FILTER (coalesce(vlm_description, '') <> '') AS n_described, round(coalesce(avg(confidence), 0.0), 6) AS mean_confidence FROM visuals GROUP BY document_id)
    SELECT document_id, coalesce(n_segments, 0) AS n_segments, coalesce(n_segment_types, 0) AS n_segment_types, coalesce(n_visuals, 0) AS n_visuals, coalesce(n_visual_types, 0) AS n_visual_types,
        coalesce(pages_with_visuals, 0) AS pages_with_visuals, coalesce(n_described, 0) AS n_described, coalesce(mean_confidence, 0.0) AS mean_confidence FROM s FULL JOIN v USING (document_id)"""
)
def document_summary(spark: SparkSession, d: str) -> DataFrame:
    return ops.document_summary(table(spark, d, "segments"), table(spark, d, "visuals"))


@query("SELECT document_type, CASE WHEN success THEN 'completed' WHEN success IS NULL THEN 'pending' ELSE 'failed' END AS status, count(*) AS n, grouping_id(document_type, CASE WHEN success THEN 'completed' WHEN success IS NULL THEN 'pending' ELSE 'failed' END) AS level FROM documents LEFT JOIN parse_results USING (document_id) GROUP BY ROLLUP (document_type, CASE WHEN success THEN 'completed' WHEN success IS NULL THEN 'pending' ELSE 'failed' END)")
def pipeline_stats(spark: SparkSession, d: str) -> DataFrame:
    status = F.when(F.col("success"), "completed").when(F.col("success").isNull(), "pending").otherwise("failed")
    rows = table(spark, d, "documents").select("document_id", "document_type").join(table(spark, d, "parse_results").select("document_id", "success"), "document_id", "left").withColumn("status", status)
    return rows.rollup("document_type", "status").agg(F.count("*").alias("n"), F.grouping_id().alias("level"))


@query("SELECT document_id, processed_at FROM documents WHERE document_type = 'pdf' ORDER BY processed_at DESC, document_id LIMIT 20")
def doc_listing(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").where("document_type = 'pdf'").select("document_id", "processed_at").orderBy(F.desc("processed_at"), "document_id").limit(20)


@query(
    """SELECT document_id, document_type, coalesce(CASE WHEN s THEN 'completed' WHEN NOT s THEN 'failed' END, 'pending') AS status FROM documents LEFT JOIN (SELECT document_id, arg_max(success, (created_at, result_id)) AS s FROM parse_results GROUP BY document_id) USING (document_id)"""
)
def doc_status(spark: SparkSession, d: str) -> DataFrame:
    last = ops.latest(table(spark, d, "parse_results"), "document_id", "created_at", "result_id", ["success"])
    status = F.when(F.col("success"), "completed").when(~F.col("success"), "failed").otherwise("pending")
    return table(spark, d, "documents").select("document_id", "document_type").join(last, "document_id", "left").select("document_id", "document_type", status.alias("status"))


@query("SELECT segment_id FROM segments WHERE document_id NOT IN (SELECT document_id FROM documents WHERE document_type = 'unknown')")
def delete_documents(spark: SparkSession, d: str) -> DataFrame:
    gone = table(spark, d, "documents").where("document_type = 'unknown'").select("document_id")
    return table(spark, d, "segments").join(gone, "document_id", "left_anti").select("segment_id")


@query("SELECT content_hash, min(visual_id) AS visual_id, count(*) AS copies, count(DISTINCT document_id) AS n_documents FROM visuals WHERE content_hash IS NOT NULL GROUP BY content_hash")
def visual_dedup(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "visuals").where("content_hash IS NOT NULL").groupBy("content_hash").agg(F.min("visual_id").alias("visual_id"), F.count("*").alias("copies"), F.countDistinct("document_id").alias("n_documents"))


@query(
    """SELECT segment_id, CAST(row_number() OVER (PARTITION BY document_id ORDER BY page_number NULLS FIRST, CASE segment_type WHEN 'metadata' THEN 0 WHEN 'visual' THEN 1 ELSE 2 END, segment_index, segment_id) - 1 AS INTEGER) AS segment_index FROM segments"""
)
def reindex_segments(spark: SparkSession, d: str) -> DataFrame:
    rank = F.when(F.col("segment_type") == "metadata", 0).when(F.col("segment_type") == "visual", 1).otherwise(2)
    rows = reindexed(table(spark, d, "segments").withColumn("_old", F.col("segment_index")), "page_number", [rank, F.col("_old"), F.col("segment_id")])
    return rows.select("segment_id", F.col("segment_index").cast("int").alias("segment_index"))


@query(
    """WITH v AS (SELECT visual_id, document_id, row_number() OVER (PARTITION BY document_id ORDER BY visual_id) - 1 AS n FROM visuals) SELECT visual_id, CAST(floor(n / 8) AS INTEGER) AS batch FROM v"""
)
def visual_batches(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "visuals").select("visual_id", "document_id").withColumn("one", F.lit(1))
    return pack(rows, ["document_id"], "visual_id", "one", 8, "batch").select("visual_id", "batch")


@query(
    """SELECT event_type, date_trunc('day', ts) AS day, count(*) AS n, round(sum(value), 4) AS value FROM events GROUP BY ALL"""
)
def event_windows(spark: SparkSession, d: str) -> DataFrame:
    counted = windowed_counts(table(spark, d, "events"), "1 day")
    return counted.select("event_type", F.col("start").alias("day"), "n", F.round("value", 4).alias("value"))
