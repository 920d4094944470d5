"""Queries on what models wrote and on exports."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirelake.common import table
from quirelake.functions import prompts
from quirelake.functions.text import strip as stripped
from quirelake.operators import extraction, reports
from quirelake.operators.tables import bracketed
from quirelake.plans.registry import Registry
from quirelake.plans.text_queries import strip
from quirelake.sinks import export
from quirelake.sources import doctags

registry = Registry()
query = registry.add

_LOC = "<loc_1><loc_2><loc_3><loc_4>"
_PLAIN = rf"SELECT page_id, {strip("regexp_replace(text, '[<>]', '', 'g')")} AS t, coalesce(len(images), 0) AS n_images FROM page_extractions WHERE text IS NOT NULL"


def _tagged(spark: SparkSession, d: str) -> DataFrame:
    """Pages written as tags: a page number, the text, a formula and a picture for each image."""
    rows = table(spark, d, "page_extractions").where("text IS NOT NULL").select("page_id", stripped(F.regexp_replace("text", "[<>]", "")).alias("t"), F.coalesce(F.size("images"), F.lit(0)).alias("n")).where("t <> ''")
    pictures = F.repeat(F.lit(f"<picture>{_LOC}</picture>"), F.greatest("n", F.lit(0)))
    return rows.select("page_id", F.concat(F.lit(f"<page_header>{_LOC}12</page_header><text>{_LOC}"), F.col("t"), F.lit(f"</text><formula>{_LOC}x^2</formula>"), pictures).alias("doctags"))


@query(f"SELECT page_id, t AS text, 1 AS n_formulas, CAST(n_images AS INTEGER) AS n_images FROM ({_PLAIN}) WHERE t <> ''")
def doctags_parse(spark: SparkSession, d: str) -> DataFrame:
    return doctags.parse_pages(_tagged(spark, d)).select("page_id", "text", F.size("formulas").alias("n_formulas"), F.size("images").alias("n_images"))


@query(
    f"""WITH p AS ({_PLAIN}), l AS (SELECT page_id, t, repeat('<text>again</text>' || chr(10), CAST(8 + page_id % 6 AS INTEGER)) AS tail, 8 + page_id % 6 AS n FROM p WHERE t <> '')
    SELECT page_id, n >= 11 AS was_cut, n >= 11 AS cut_failed FROM l"""
)
def doctags_repetitions(spark: SparkSession, d: str) -> DataFrame:
    tail = F.repeat(F.lit("<text>again</text>\n"), (8 + F.col("page_id") % 6).cast("int"))
    rows = _tagged(spark, d).select("page_id", F.concat(F.lit("<title>first</title>\n"), tail).alias("doctags"))
    out = doctags.cut_repetitions(rows, "page_id")
    return out.select("page_id", (F.col("cut") != F.col("doctags")).alias("was_cut"), "cut_failed")


@query("SELECT result_id, json_valid(payload) AND payload[1] = '{' AS found FROM parse_results WHERE payload IS NOT NULL AND json_valid(payload) AND payload[1] = '{' AND NOT contains(payload, '```') AND NOT contains(payload, 'NaN')")
def json_ladder(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "parse_results").where(F.try_parse_json("payload").isNotNull() & F.startswith("payload", F.lit("{")) & ~F.contains("payload", F.lit("```")) & ~F.contains("payload", F.lit("NaN")))
    response = F.concat(F.lit("The result:\n```json\n"), F.col("payload"), F.lit("\n```\ndone"))
    return rows.select("result_id", (doctags.json_of(response) == F.trim("payload")).alias("found"))


@query()
def json_ladder_all(spark: SparkSession, d: str) -> DataFrame:
    """The JSON in every payload as it stands, and what is made of those that hold none; the tests compare the ladder with a loop over its rungs."""
    rows = table(spark, d, "parse_results").where("payload IS NOT NULL")
    return rows.select("result_id", doctags.json_of(F.col("payload")).alias("json"), doctags.json_or_default(F.col("payload")).alias("json_or_default"))


def _fields(c: str) -> str:
    return "[" + ", ".join(f"CASE WHEN len(regexp_extract_all({c}, '{p}', 1)) > 0 THEN struct_pack(key := '{k}', value := regexp_extract_all({c}, '{p}', 1)) END" for k, p in doctags.FIELDS) + "]"


@query(f"SELECT visual_id, list_transform(list_filter({_fields('vlm_description')}, lambda x: x IS NOT NULL), lambda x: x.key || '=' || array_to_string(x.value, ';')) AS fields FROM visuals WHERE vlm_description <> '' AND len(list_filter({_fields('vlm_description')}, lambda x: x IS NOT NULL)) > 0")
def response_fields(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "visuals").where("vlm_description <> ''").select("visual_id", doctags.structured_response(F.col("vlm_description")).alias("r")).where("r.format = 'text_extracted'")
    return rows.select("visual_id", F.transform(F.map_entries("r.fields"), lambda x: F.concat(x["key"], F.lit("="), F.array_join(x["value"], ";"))).alias("fields"))


_KIND = "CASE WHEN regexp_matches(lower(vlm_description), 'title|deckblatt') THEN 'title' WHEN regexp_matches(lower(vlm_description), 'content|inhalt') THEN 'table_of_contents' WHEN regexp_matches(lower(vlm_description), 'technical|technisch') THEN 'technical_specification' ELSE 'content' END"


@query(f"SELECT visual_id, {_KIND} AS page_type, NULL AS main_topic, 0 AS n FROM visuals WHERE vlm_description IS NOT NULL UNION ALL SELECT visual_id, {_KIND}, element_type, 2 FROM visuals WHERE vlm_description IS NOT NULL AND element_type IS NOT NULL")
def page_contexts(spark: SparkSession, d: str) -> DataFrame:
    """Every description read as it stands, and as a response that has its page type, a topic and two points as JSON."""
    rows = table(spark, d, "visuals").where("vlm_description IS NOT NULL")
    written = F.to_json(F.struct(doctags.page_type(F.col("vlm_description")).alias("page_type"), F.col("element_type").alias("main_topic"), F.array(F.lit("a"), F.lit("b")).alias("key_information")))
    both = rows.select("visual_id", F.col("vlm_description").alias("r")).unionByName(rows.where("element_type IS NOT NULL").select("visual_id", F.concat(F.lit("Here it is:\n```json\n"), written, F.lit("\n```")).alias("r")))
    return both.select("visual_id", doctags.page_context(F.col("r")).alias("c")).select("visual_id", "c.page_type", "c.main_topic", F.size("c.key_information").alias("n"))


_NOTE = "'[' || upper(element_type) || ']: ' || vlm_description || coalesce(' (Page ' || page_number || ')', '')"


@query(
    f"""SELECT document_id, 'text' AS section, segment_index // 1024 AS part_no, string_agg(CASE WHEN segment_type = 'metadata' AND segment_subtype IN ('sheet', 'slide') THEN '## ' || content ELSE content END, chr(10) || chr(10) ORDER BY segment_index, segment_id) AS content FROM segments WHERE content IS NOT NULL GROUP BY ALL
    UNION ALL SELECT document_id, 'visuals', visual_id // 1024, string_agg({_NOTE}, chr(10) ORDER BY visual_id) FROM visuals WHERE vlm_description <> '' AND element_type IS NOT NULL GROUP BY ALL"""
)
def full_text(spark: SparkSession, d: str) -> DataFrame:
    return export.full_text(table(spark, d, "segments"), table(spark, d, "visuals"))


@query(f"SELECT segment_id, content || chr(10) || chr(10) || string_agg({_NOTE}, chr(10) ORDER BY pos, visual_id) AS content FROM (SELECT segment_id, document_id, content, unnest(visual_references) AS content_hash, generate_subscripts(visual_references, 1) AS pos FROM segments WHERE content IS NOT NULL) s JOIN visuals v USING (document_id, content_hash) WHERE vlm_description <> '' AND element_type IS NOT NULL GROUP BY segment_id, content")
def enhanced_content(spark: SparkSession, d: str) -> DataFrame:
    return export.enhanced_content(table(spark, d, "segments"), table(spark, d, "visuals"))


@query(
    """WITH s AS (SELECT document_id, count(*) AS n FROM segments GROUP BY document_id), v AS (SELECT document_id, count(*) AS n FROM visuals GROUP BY document_id)
    SELECT d.document_id, 'metadata' AS section, 0 AS part_no, to_json(struct_pack(document_id := d.document_id, source_path := source_path, document_type := document_type, summary := struct_pack(total_segments := coalesce(s.n, 0), total_visuals := coalesce(v.n, 0)))) AS json
      FROM documents d LEFT JOIN s ON s.document_id = d.document_id LEFT JOIN v ON v.document_id = d.document_id
    UNION ALL SELECT document_id, 'segments', segment_index // 1024, to_json(struct_pack(document_id := document_id, segments := list(struct_pack(segment_index := segment_index, segment_id := segment_id, page_number := page_number, segment_type := segment_type, segment_subtype := segment_subtype, content := content) ORDER BY segment_index, segment_id))) FROM segments GROUP BY document_id, segment_index // 1024
    UNION ALL SELECT document_id, 'visual_elements', visual_id // 1024, to_json(struct_pack(document_id := document_id, visual_elements := list(struct_pack(visual_id := visual_id, content_hash := content_hash, element_type := element_type, page_number := page_number, vlm_description := vlm_description) ORDER BY visual_id))) FROM visuals GROUP BY document_id, visual_id // 1024"""
)
def parsed_json(spark: SparkSession, d: str) -> DataFrame:
    return export.parsed_documents(table(spark, d, "documents"), table(spark, d, "segments"), table(spark, d, "visuals"))


@query(f"SELECT chunk_row_id, CASE WHEN inherited_context <> '' THEN 'VORHERIGER KONTEXT:' || chr(10) || inherited_context || chr(10) || chr(10) ELSE '' END || 'AUFGABE:' || chr(10) || 'Summarise.' || chr(10) || chr(10) || 'TEXT:' || chr(10) || coalesce(content, '') AS prompt FROM chunks")
def task_prompts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "chunks").select("chunk_row_id", prompts.with_context("Summarise.", F.col("content"), F.col("inherited_context")).alias("prompt"))


@query("SELECT chunk_row_id, 'T: ' || coalesce(content, '') || ' / ' || coalesce(inherited_context, '') || ' {other}' AS prompt FROM chunks")
def template_prompts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "chunks").select("chunk_row_id", prompts.from_template("T: {chunk_content} / {inherited_context} {other}", {"chunk_content": F.col("content"), "inherited_context": F.col("inherited_context")}).alias("prompt"))


@query(
    "SELECT visual_id, CASE element_type WHEN 'chart' THEN 'chart_data' WHEN 'formula' THEN 'ocr' WHEN 'table' THEN 'ocr' WHEN 'table_image' THEN 'ocr' WHEN 'diagram' THEN 'comprehensive' WHEN 'screenshot' THEN 'comprehensive' ELSE 'description' END AS focus, 5 AS n_instructions FROM visuals"
)
def adaptive_prompts(spark: SparkSession, d: str) -> DataFrame:
    focus, lines = prompts.adaptive(F.col("element_type"))
    return table(spark, d, "visuals").select("visual_id", focus.alias("focus"), F.size(lines).alias("n_instructions"))


@query("SELECT segment_id, len(string_split(content, '|')) > 1 AS has_table FROM segments WHERE segment_type = 'table' AND content IS NOT NULL")
def bracketed_tables(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "segments").where("segment_type = 'table' AND content IS NOT NULL")
    _, found = bracketed(F.concat(F.lit("before\n[TABLE]\n"), stripped(F.col("content")), F.lit("\n[/TABLE]\nafter")))
    return rows.select("segment_id", (F.size(found) == 1).alias("has_table"))


@query(
    "SELECT 'text' AS tag, trim(content) AS content, count(*) AS n FROM (SELECT regexp_replace(content, '[<>]', '', 'g') AS content FROM segments WHERE segment_subtype LIKE 'heading%') WHERE trim(content) <> '' GROUP BY ALL HAVING count(*) > 3"
)
def tag_repetitions(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "segments").where("segment_subtype LIKE 'heading%'").select(F.concat(F.lit("<text>"), F.regexp_replace("content", "[<>]", ""), F.lit("</text>")).alias("tags"))
    return reports.repeated_tags(rows, "tags", 3)


@query("SELECT visual_id, CASE WHEN regexp_matches(l, 'title|deckblatt') THEN 'title' WHEN regexp_matches(l, 'content|inhalt') THEN 'table_of_contents' WHEN regexp_matches(l, 'technical|technisch') THEN 'technical_specification' ELSE 'content' END AS page_type FROM (SELECT visual_id, lower(vlm_description) AS l FROM visuals WHERE vlm_description IS NOT NULL)")
def page_types(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "visuals").where("vlm_description IS NOT NULL").select("visual_id", doctags.page_type(F.col("vlm_description")).alias("page_type"))


def _bar_triples(prompt: str) -> str:
    """Stands for an outside model: the cells of the first row of a table in the text as triples, and an error where there is no table."""
    lines = [line for line in prompt.rpartition("Text:\n")[2].splitlines() if " | " in line]
    if len(lines) < 2:
        raise ValueError("no table")
    head, row = ([c.strip() for c in line.split("|")] for line in lines[:2])
    triples = [{"subject": row[0], "predicate": p, "object": o} | ({"confidence": 0.9} if o.isdigit() else {}) for p, o in zip(head[1:], row[1:], strict=False)]
    return f"Here they are:\n```json\n{json.dumps({'triples': triples})}\n```"


@query("SELECT segment_id, position(' | ' IN content) > 0 AND len(list_filter(string_split(content, chr(10)), lambda l: contains(l, ' | '))) >= 2 AS success FROM segments WHERE content IS NOT NULL")
def extract_texts(spark: SparkSession, d: str) -> DataFrame:
    return extraction.extract_triples(table(spark, d, "segments").where("content IS NOT NULL"), "segment_id", "content", _bar_triples, attempts=1)[1].select("segment_id", "success")


@query(
    """WITH l AS (SELECT segment_id, list_filter(string_split(content, chr(10)), lambda x: contains(x, ' | ')) AS l, left(content, 200) AS source_chunk FROM segments WHERE content IS NOT NULL), c AS (SELECT segment_id, source_chunk, list_transform(string_split(l[1], '|'), lambda x: trim(x)) AS h, list_transform(string_split(l[2], '|'), lambda x: trim(x)) AS r FROM l WHERE len(l) >= 2),
    k AS (SELECT *, unnest(range(2, least(len(h), len(r)) + 1)) AS k FROM c) SELECT segment_id, r[1] AS subject, h[k] AS predicate, r[k] AS object, CASE WHEN regexp_full_match(r[k], '[0-9]+') THEN 0.9 ELSE 0.8 END::DOUBLE AS confidence, source_chunk FROM k"""
)
def extract_batch(spark: SparkSession, d: str) -> DataFrame:
    return extraction.extract_triples(table(spark, d, "segments").where("content IS NOT NULL"), "segment_id", "content", _bar_triples, attempts=1)[0]
