"""Reports on runs, documents and models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# Tag contents that say nothing.
TRIVIAL = ("", "-", "n.a.", "n.a", "N/A", "0", "1")
# From which confidence on a result counts as high or medium, and below which it is tried again.
HIGH, MEDIUM, RETRY = 0.8, 0.5, 0.7


def share(a: Column, b: Column) -> Column:
    """A ratio that is 0 where there is nothing to divide by."""
    return F.round(F.coalesce(F.try_divide(a, b), F.lit(0.0)), 6)


def run_report(runs: DataFrame, by: list[str], success: Column, seconds: Column) -> DataFrame:
    """Runs by outcome with times: totals, success rate, mean time of successes."""
    ok = F.coalesce(success, F.lit(False))
    out = runs.groupBy(*by).agg(F.count("*").alias("total"), F.count_if(ok).alias("processed"), F.count_if(~ok).alias("failed"), F.round(F.sum(seconds), 4).alias("seconds"), F.round(F.avg(F.when(ok, seconds)), 6).alias("mean_seconds"))
    return out.withColumn("success_rate", share(F.col("processed"), F.col("total")))


def document_summary(segments: DataFrame, visuals: DataFrame) -> DataFrame:
    """For each document of either table: segments, visuals, distinct types, pages with visuals, described visuals, mean confidence."""
    s = segments.groupBy("document_id").agg(F.count("*").alias("n_segments"), F.countDistinct("segment_type").alias("n_segment_types"))
    v = visuals.groupBy("document_id").agg(
        F.count("*").alias("n_visuals"), F.countDistinct("element_type").alias("n_visual_types"), F.countDistinct(F.when(F.col("page_number") > 0, F.col("page_number"))).alias("pages_with_visuals"),
        F.count_if(F.coalesce("vlm_description", F.lit("")) != "").alias("n_described"), F.round(F.coalesce(F.avg("confidence"), F.lit(0.0)), 6).alias("mean_confidence"),
    )
    return s.join(v, "document_id", "full_outer").na.fill(0, ["n_segments", "n_segment_types", "n_visuals", "n_visual_types", "pages_with_visuals", "n_described", "mean_confidence"])


def latest(rows: DataFrame, key: str, time: str, tie: str, columns: list[str]) -> DataFrame:
    """The newest row of each key, ties by ``tie``."""
    return rows.groupBy(key).agg(F.max_by(F.struct(*columns), F.struct(time, tie)).alias("r")).select(key, "r.*")


def repeated_tags(pages: DataFrame, text_col: str, more_than: int = 20) -> DataFrame:
    """``(tag, content, n)``: tag contents that occur suspiciously often; trivial contents are left out."""
    pattern = r"<(\w+)>(?:<loc_\d+>)*([^<]+)</\1>"
    pairs = F.arrays_zip(F.regexp_extract_all(text_col, F.lit(pattern), 1).alias("tag"), F.regexp_extract_all(text_col, F.lit(pattern), 2).alias("content"))
    rows = pages.select(F.explode(pairs).alias("p")).select("p.tag", F.trim("p.content").alias("content"))
    return rows.where(~F.col("content").isin(*TRIVIAL)).groupBy("tag", "content").agg(F.count("*").alias("n")).where(F.col("n") > more_than)


def batch_statistics(runs: DataFrame, by: list[str], load_seconds: float) -> DataFrame:
    """Batches of files with a success rate in percent, seconds for each success, and the seconds saved by loading the model once."""
    ok = F.coalesce("success", F.lit(False))
    out = runs.groupBy(*by).agg(F.count("*").alias("total_files"), F.count_if(ok).alias("successful_files"), F.count_if(~ok).alias("failed_files"), F.round(F.sum("processing_time_seconds"), 4).alias("total_seconds"))
    good = F.col("successful_files")
    return out.withColumns({
        "success_rate": share(good * 100.0, F.col("total_files")), "average_seconds": share(F.col("total_seconds"), F.nullif(good, F.lit(0))), "seconds_saved": F.when(good > 1, F.lit(load_seconds) * (good - 1)).otherwise(0.0),
    })


def client_statistics(calls: DataFrame, by: list[str], time: str, tie: str) -> DataFrame:
    """Calls of each client: totals, summed and mean milliseconds of successes, last error and its time."""
    ok = F.coalesce("success", F.lit(False))
    millis = F.when(ok, F.col("processing_time_seconds") * 1000)
    failed = F.when(~ok & F.col("error_message").isNotNull(), F.struct(time, tie))
    return calls.groupBy(*by).agg(
        F.count("*").alias("total_requests"), F.count_if(ok).alias("successful_requests"), F.count_if(~ok).alias("failed_requests"), F.round(F.coalesce(F.sum(millis), F.lit(0.0)), 3).alias("total_ms"),
        F.round(F.coalesce(F.avg(millis), F.lit(0.0)), 6).alias("average_ms"), F.max_by("error_message", failed).alias("last_error"), F.max_by(time, failed).alias("last_error_time"),
    )


def inference_summary(runs: DataFrame, by: list[str], size: Column, seconds: Column) -> DataFrame:
    """Operations by outcome, with the mean seconds and mean throughput (size a second, 0 in no time) of successes."""
    ok = F.coalesce("success", F.lit(False))
    through = F.when(ok, F.coalesce(F.try_divide(size, F.nullif(seconds, F.lit(0.0))), F.lit(0.0)))
    out = runs.groupBy(*by).agg(
        F.count("*").alias("total_operations"), F.count_if(ok).alias("successful_operations"), F.count_if(~ok).alias("failed_operations"),
        F.round(F.coalesce(F.avg(F.when(ok, seconds)), F.lit(0.0)), 6).alias("average_seconds"), F.round(F.coalesce(F.avg(through), F.lit(0.0)), 6).alias("average_throughput"),
    )
    return out.withColumn("success_rate", share(F.col("successful_operations"), F.col("total_operations")))


def extraction_confidence(results: DataFrame, by: list[str], confidence: str = "confidence") -> DataFrame:
    """``triple_count`` and mean, least and greatest confidence, 0 where there is none."""
    none = lambda c: F.coalesce(c, F.lit(0.0))
    return results.groupBy(*by).agg(F.count("*").alias("triple_count"), F.round(none(F.avg(confidence)), 6).alias("average"), none(F.min(confidence)).alias("least"), none(F.max(confidence)).alias("most"))


def stage_statistics(results: DataFrame, second_stage: tuple[str, ...]) -> DataFrame:
    """One row on a two-stage run: elements, outcomes, stages, confidence bands and seconds; models in ``second_stage`` are the second stage."""
    ok, c = F.col("error_message").isNull(), F.coalesce("confidence", F.lit(0.0))
    second, seconds = F.coalesce(F.col("model_used").isin(*second_stage), F.lit(False)), F.coalesce("processing_time_seconds", F.lit(0.0))
    out = results.agg(
        F.count("*").alias("total_elements"), F.count_if(ok).alias("successful"), F.count_if(~ok).alias("failed"), F.count_if(~second).alias("stage1"), F.count_if(second).alias("stage2"),
        F.round(F.coalesce(F.avg(F.when(ok, c)), F.lit(0.0)), 6).alias("average_confidence"), F.count_if(c >= HIGH).alias("high"), F.count_if((c >= MEDIUM) & (c < HIGH)).alias("medium"), F.count_if(c < MEDIUM).alias("low"),
        F.round(F.coalesce(F.sum(seconds), F.lit(0.0)), 3).alias("total_seconds"), F.round(F.coalesce(F.sum(F.when(~second, seconds)), F.lit(0.0)), 3).alias("stage1_seconds"), F.round(F.coalesce(F.sum(F.when(second, seconds)), F.lit(0.0)), 3).alias("stage2_seconds"),
    )
    return out.withColumn("average_seconds", share(F.col("total_seconds"), F.col("total_elements")))


def context_statistics(enhanced: DataFrame) -> DataFrame:
    """One row on segments with ``context`` (null where none was found): how many have one, by kind."""
    has = F.coalesce("context", F.lit("")) != ""
    return enhanced.agg(
        F.count("*").alias("total_segments"), F.count_if(has).alias("enhanced_segments"), F.count_if(has & (F.col("segment_type") == "table")).alias("tables_with_context"),
        F.count_if(has & (F.col("segment_subtype") == "list")).alias("lists_with_context"), F.count_if(has & (F.col("segment_type") == "visual")).alias("visuals_with_context"),
    )


def retried(first: DataFrame, second: DataFrame, key: str, limit: float = RETRY) -> DataFrame:
    """``first`` results (``key``, ``confidence``, ``description``; one a key) after a second try of those below ``limit``, whose result is kept where it is surer."""
    again = second.groupBy(key).agg(F.max_by(F.struct("confidence", "description"), F.struct(F.coalesce("confidence", F.lit(-1.0)), "description")).alias("_r"))
    weak = F.coalesce("confidence", F.lit(0.0)) < limit
    better = weak & F.col("_r").isNotNull() & (F.coalesce("_r.confidence", F.lit(0.0)) > F.coalesce("confidence", F.lit(0.0)))
    joined = first.join(again, key, "left").withColumn("was_retried", weak & F.col("_r").isNotNull())
    return joined.withColumns({"confidence": F.when(better, F.col("_r.confidence")).otherwise(F.col("confidence")), "description": F.when(better, F.col("_r.description")).otherwise(F.col("description"))}).drop("_r")


def run_records(runs: DataFrame) -> DataFrame:
    """``(kind, document_id, json)``: what a run leaves for each document, a ``processed`` or an ``error`` record, the latest run by time.

    Runs without document are left out; values that are null are not in the JSON.
    """
    last = latest(runs.where("document_id IS NOT NULL"), "document_id", "created_at", "result_id", ["success", "total_pages", "extraction_method", "model_version", "error_message"])
    ok = F.coalesce("success", F.lit(False))
    done = F.to_json(F.struct("document_id", F.lit("completed").alias("status"), "total_pages", "extraction_method", "model_version"))
    failed = F.to_json(F.struct("document_id", F.lit("failed").alias("status"), "error_message"))
    return last.select(F.when(ok, "processed").otherwise("error").alias("kind"), "document_id", F.when(ok, done).otherwise(failed).alias("json"))


def run_summary(records: DataFrame) -> DataFrame:
    """``(json)``: one record that counts ``run_records``."""
    counted = records.agg(F.count("*").alias("total_documents"), F.count_if(F.col("kind") == "processed").alias("processed"), F.count_if(F.col("kind") == "error").alias("failed"))
    return counted.select(F.to_json(F.struct("total_documents", "processed", "failed")).alias("json"))


def debug_records(segments: DataFrame, context: Column, visuals: DataFrame) -> DataFrame:
    """``(segment_id, json)``: the audit record of each segment: place, type, size, context and the visuals it refers to."""
    refs = segments.select("segment_id", F.posexplode("visual_references").alias("pos", "content_hash"))
    known = visuals.groupBy("content_hash").agg(F.min_by(F.struct("visual_id", "element_type"), "visual_id").alias("v"))
    listed = refs.join(known, "content_hash").groupBy("segment_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "v"))), lambda x: F.struct(x["v"]["visual_id"].alias("visual_id"), x["v"]["element_type"].alias("element_type"))).alias("visuals"))
    rows = segments.withColumn("_c", context).join(listed, "segment_id", "left")
    return rows.select("segment_id", F.to_json(F.struct("segment_id", "document_id", "segment_index", "segment_type", "segment_subtype", F.length("content").alias("content_length"), F.col("_c").alias("context"), "visuals")).alias("json"))
