"""All registered queries of the core."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirelake.common import table
from quirelake.operators import shredding
from quirelake.plans import chunk_queries, graph_queries, io_queries, page_queries, report_queries, text_queries, visual_queries
from quirelake.plans.registry import Query, Registry

NODE_COLUMNS = [c.split()[0] for c in shredding.NODE_SCHEMA.split(", ")]

registry = Registry()
query = registry.add


SOURCES = (("parse_results", "result_id"), ("segment_debug", "debug_id"))


@query()
def p3_found(spark: SparkSession, d: str) -> DataFrame:
    runs, debug = (shredding.found_members(shredding.shredded(table(spark, d, s), s, i), s) for s, i in SOURCES)
    return runs.unionByName(debug)


@query()
def p3_pages(spark: SparkSession, d: str) -> DataFrame:
    return shredding.shredded(table(spark, d, "parse_results"), *SOURCES[0])["page"].drop("payload_id")


@query()
def p3_visual_elements(spark: SparkSession, d: str) -> DataFrame:
    return shredding.shredded(table(spark, d, "parse_results"), *SOURCES[0])["visual_element"].drop("payload_id")


@query()
def p3_vlm_results(spark: SparkSession, d: str) -> DataFrame:
    return shredding.shredded(table(spark, d, "segment_debug"), *SOURCES[1])["vlm_result"].drop("payload_id")


@query()
def p3_nodes(spark: SparkSession, d: str) -> DataFrame:
    """All nodes of all payloads, for whatever the entity tables have no column for; these have the same ``row_id`` and ``node_id``."""
    runs, debug = (shredding.adjacency(table(spark, d, s), s, i).select(F.lit(s).alias("source_table"), F.col("row_id").cast("string").alias("row_id"), *(c for c in NODE_COLUMNS if c not in ("row_id", "payload_id"))) for s, i in SOURCES)
    return runs.unionByName(debug)


def queries() -> dict[str, Query]:
    out = dict(registry.queries)
    for module in MODULES:
        out |= module.registry.queries
    return out


def oracle_sql() -> dict[str, str]:
    out = dict(registry.sql)
    for module in MODULES:
        out |= module.registry.sql
    return out


MODULES = (text_queries, chunk_queries, graph_queries, visual_queries, report_queries, io_queries, page_queries)
