"""Unions and complements of spans in a text."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def merge_spans(spans: DataFrame, key: str) -> DataFrame:
    """``(key, start_pos, end_pos)``: spans that touch or overlap made one. Null and reversed spans are left out."""
    rows = spans.where("start_pos <= end_pos").select(key, "start_pos", "end_pos")
    w = Window.partitionBy(key).orderBy("start_pos", "end_pos")
    before = F.max("end_pos").over(w.rowsBetween(Window.unboundedPreceding, -1))
    opened = rows.withColumn("_opens", (before.isNull() | (F.col("start_pos") > before)).cast("int")).withColumn("_n", F.sum("_opens").over(w))
    return opened.groupBy(key, "_n").agg(F.min("start_pos").alias("start_pos"), F.max("end_pos").alias("end_pos")).drop("_n")


def outside(texts: DataFrame, merged: DataFrame, key: str, text_col: str) -> DataFrame:
    """``(key, start_pos, content)``: what lies between and around merged spans (0-based, end exclusive); empty parts are left out."""
    listed = merged.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("start_pos", "end_pos"))).alias("_s"))
    rows = texts.select(key, F.coalesce(text_col, F.lit("")).alias("_t")).join(listed, key, "left")
    spans = F.coalesce("_s", F.array().cast(listed.schema["_s"].dataType))
    begins = F.concat(F.array(F.lit(0)), F.transform(spans, lambda s: s["end_pos"]))
    ends = F.concat(F.transform(spans, lambda s: s["start_pos"]), F.array(F.length("_t")))
    parts = rows.select(key, "_t", F.explode(F.arrays_zip(begins.alias("a"), ends.alias("b"))).alias("p"))
    return parts.where("p.b > p.a").select(key, F.col("p.a").alias("start_pos"), F.substring(F.col("_t"), F.col("p.a") + 1, F.col("p.b") - F.col("p.a")).alias("content"))
