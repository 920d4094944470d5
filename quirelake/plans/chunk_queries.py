"""Queries on chunks and their groups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirelake.common import table
from quirelake.functions import text as fx
from quirelake.operators import chunking
from quirelake.operators import chunks as ops
from quirelake.operators import segments as seg
from quirelake.plans.registry import Registry
from quirelake.plans.text_queries import strip, upper, words

registry = Registry()
query = registry.add

# Segments once each: of repeated deliveries the first is kept.
FIRST = "SELECT * FROM segments QUALIFY row_number() OVER (PARTITION BY document_id, segment_index ORDER BY segment_id) = 1"

PACKED = f"""
WITH RECURSIVE s AS (SELECT document_id, segment_id, segment_index, segment_type, page_number, content, {words("content")} AS n_words,
    row_number() OVER (PARTITION BY document_id ORDER BY segment_index) AS k FROM ({FIRST})),
p AS (SELECT document_id, k, n_words * 13 AS used, 0 AS chunk_ordinal FROM s WHERE k = 1
  UNION ALL SELECT s.document_id, s.k, CASE WHEN p.used + s.n_words * 13 > 2000 THEN s.n_words * 13 ELSE p.used + s.n_words * 13 END,
    CASE WHEN p.used + s.n_words * 13 > 2000 THEN p.chunk_ordinal + 1 ELSE p.chunk_ordinal END FROM p JOIN s ON s.document_id = p.document_id AND s.k = p.k + 1),
packed AS (SELECT s.*, CAST(p.chunk_ordinal AS INTEGER) AS chunk_ordinal FROM s JOIN p USING (document_id, k))
"""

CHUNKS = f"""
{PACKED}, made AS (SELECT document_id, chunk_ordinal, string_agg(content, chr(10) || chr(10) ORDER BY segment_index) AS content, count(*) AS n_segments, CAST(sum(n_words) AS BIGINT) AS n_words,
    min(page_number) AS start_page, max(page_number) AS end_page,
    CASE WHEN bool_or(segment_type = 'table') THEN 'table_data' WHEN bool_or(segment_type = 'visual') AND bool_or(segment_type = 'text') THEN 'hybrid' WHEN bool_or(segment_type = 'visual') THEN 'visual_context' ELSE 'content' END AS chunk_type
  FROM packed GROUP BY document_id, chunk_ordinal),
judged AS (SELECT *, n_words * 13 <= 2400 AND n_words * 13 >= 200 AND {strip("content")} <> '' AS is_valid FROM made)
"""


def _first(spark: SparkSession, d: str) -> DataFrame:
    return seg.keep_first(table(spark, d, "segments"), ["document_id", "segment_index"], [F.col("segment_id")])


def _composed(spark: SparkSession, d: str, **more: bool) -> DataFrame:
    columns = ["document_id", "segment_index", "segment_id", "segment_type", "page_number", "content", "visual_references", "metadata"]
    once = seg.keep_first(table(spark, d, "segments").select(*columns), columns[:2], [F.col("segment_id")])
    return chunking.chunk_documents(table(spark, d, "documents"), once, table(spark, d, "visuals"), 200, 20, **more)


def _chunks(spark: SparkSession, d: str) -> DataFrame:
    return ops.assemble(ops.pack_segments(_first(spark, d), 200))


@query(PACKED + "SELECT segment_id, chunk_ordinal FROM packed")
def chunk_pack(spark: SparkSession, d: str) -> DataFrame:
    return ops.pack_segments(_first(spark, d), 200).select("segment_id", "chunk_ordinal")


@query(CHUNKS + "SELECT document_id, chunk_ordinal, content, n_segments, n_words, start_page, end_page, chunk_type, is_valid FROM judged")
def chunk_document(spark: SparkSession, d: str) -> DataFrame:
    return _chunks(spark, d)


@query(CHUNKS + "SELECT document_id, chunk_ordinal, n_words FROM judged WHERE is_valid")
def chunk_validate(spark: SparkSession, d: str) -> DataFrame:
    return _chunks(spark, d).where("is_valid").select("document_id", "chunk_ordinal", "n_words")


_STATS = f"""count(*) AS n_chunks, round(sum(token_count), 1) AS tokens, count(*) FILTER (inherited_context IS NOT NULL) AS with_context, count(*) FILTER (chunk_type IN ('visual_context','hybrid')) AS with_visuals,
    count(*) FILTER (coalesce({strip("content")}, '') = '') AS empty_chunks, CAST(sum({words("inherited_context")} * 13) AS DOUBLE) / 10 AS context_tokens"""
_RATIOS = "round(coalesce(tokens / n_chunks, 0.0), 6) AS avg_tokens, round(coalesce(with_context / n_chunks, 0.0), 6) AS context_coverage, round(coalesce(with_visuals / n_chunks, 0.0), 6) AS visual_coverage"


def _statistics(spark: SparkSession, d: str, by: list[str]) -> DataFrame:
    rows = table(spark, d, "chunks").join(table(spark, d, "documents").select("document_id", "document_type"), "document_id", "left")
    return ops.chunk_statistics(rows, by, F.col("inherited_context").isNotNull(), F.coalesce(F.col("chunk_type").isin("visual_context", "hybrid"), F.lit(False)))


@query(f"SELECT * EXCLUDE (context_tokens), {_RATIOS}, round(coalesce(tokens / (tokens + context_tokens), 0.0), 6) AS efficiency FROM (SELECT document_type, {_STATS} FROM chunks LEFT JOIN documents USING (document_id) GROUP BY document_type)")
def chunk_stats(spark: SparkSession, d: str) -> DataFrame:
    return _statistics(spark, d, ["document_type"])


@query(
    f"SELECT n_documents, n_chunks, round(n_chunks / n_documents, 6) AS chunks_per_document, round(tokens / n_documents, 6) AS tokens_per_document, round(with_context / n_chunks, 6) AS context_coverage FROM (SELECT count(DISTINCT document_id) AS n_documents, {_STATS} FROM chunks)"
)
def chunk_corpus_stats(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "chunks").groupBy("document_id").agg(F.count("*").alias("n"), F.sum("token_count").alias("t"), F.count("inherited_context").alias("w"))
    out = c.agg(F.count("*").alias("n_documents"), F.sum("n").alias("n_chunks"), F.round(F.sum("t"), 1).alias("t"), F.sum("w").alias("w"))
    ratio = lambda a, b: F.round(F.col(a) / F.col(b), 6)
    return out.select("n_documents", "n_chunks", ratio("n_chunks", "n_documents").alias("chunks_per_document"), ratio("t", "n_documents").alias("tokens_per_document"), ratio("w", "n_chunks").alias("context_coverage"))


_MARKER = f"(coalesce(segment_subtype IN ('heading_1','heading_2','heading_3','title'), false) OR regexp_matches({strip('content')}, '^[0-9]+\\.?[0-9]*\\.?[ \\t]+[A-Z]') OR ({upper(strip('content'))} AND length({strip('content')}) < 100))"


@query(
    f"""WITH s AS (SELECT document_id, count(*) AS n_segments, bool_or(segment_type = 'table') AS has_tables, max(page_number) AS total_pages, count(*) FILTER (segment_subtype IN ('heading_1','heading_2','heading_3','title')) AS n_headings,
       count(*) FILTER ({_MARKER}) AS n_section_markers FROM segments GROUP BY document_id), v AS (SELECT document_id, bool_or(element_type IN ('chart', 'graph')) AS has_charts FROM visuals GROUP BY document_id)
    SELECT s.*, v.document_id IS NOT NULL AS has_images, coalesce(has_charts, false) AS has_charts FROM s LEFT JOIN v USING (document_id)"""
)
def structure_info(spark: SparkSession, d: str) -> DataFrame:
    return seg.structure(table(spark, d, "segments"), table(spark, d, "visuals"))


@query(f"SELECT document_id, segment_id, segment_index, content, coalesce(segment_subtype IN ('heading_1','heading_2','heading_3','title'), false) AS is_heading FROM segments WHERE {_MARKER}")
def structure_markers(spark: SparkSession, d: str) -> DataFrame:
    """Headings and section markers as rows, since one document may hold many."""
    return seg.markers(table(spark, d, "segments")).select("document_id", "segment_id", "segment_index", "content", "is_heading")


_SECTION = rf"""list_filter(list_transform(string_split(content, chr(10))[1:3], lambda l: {strip("l")}), lambda l: regexp_matches(l, '^[0-9]+\.?[0-9]*\.?[ \t]+[A-Z]') OR ({upper("l")} AND length(l) < 100) OR regexp_matches(l, '^[IVX]+\.[ \t]+[A-Z]'))[1]"""
_TOPIC = f"""{strip(f"list_filter(string_split(content, chr(10)), lambda l: {strip('l')} <> '' AND NOT starts_with(l, '['))[1]")}"""


def _groups_sql(expression: str) -> str:
    return f"""WITH c AS (SELECT chunk_row_id, document_id, chunk_ordinal, {expression} AS section FROM chunks),
    l AS (SELECT *, last_value(section IGNORE NULLS) OVER (PARTITION BY document_id ORDER BY chunk_ordinal, chunk_row_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS known,
        row_number() OVER (PARTITION BY document_id ORDER BY chunk_ordinal, chunk_row_id) AS k FROM c),
    o AS (SELECT *, CASE WHEN k = 1 OR (section IS NOT NULL AND section IS DISTINCT FROM known) THEN 1 ELSE 0 END AS opens FROM l)
    SELECT chunk_row_id, section, CAST(sum(opens) OVER (PARTITION BY document_id ORDER BY chunk_ordinal, chunk_row_id) - 1 AS INTEGER) AS group_ordinal FROM o"""


@query(_groups_sql(_SECTION))
def section_groups(spark: SparkSession, d: str) -> DataFrame:
    return ops.section_groups(table(spark, d, "chunks"), fx.pdf_section(F.col("content"))).select("chunk_row_id", "section", "group_ordinal")


@query(_groups_sql(_TOPIC))
def topic_groups(spark: SparkSession, d: str) -> DataFrame:
    return ops.section_groups(table(spark, d, "chunks"), fx.slide_topic(F.col("content"))).select("chunk_row_id", "section", "group_ordinal")


@query(
    """WITH c AS (SELECT chunk_row_id, document_id, chunk_ordinal, nullif(length(regexp_extract(content, '(?m)^(#{1,3}) ', 1)), 0) AS lv FROM chunks),
    m AS (SELECT *, min(lv) OVER (PARTITION BY document_id ORDER BY chunk_ordinal, chunk_row_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS least FROM c)
    SELECT chunk_row_id, CAST(sum(CASE WHEN lv <= coalesce(least, lv) THEN 1 ELSE 0 END) OVER (PARTITION BY document_id ORDER BY chunk_ordinal, chunk_row_id) AS INTEGER) AS group_ordinal FROM m"""
)
def heading_groups(spark: SparkSession, d: str) -> DataFrame:
    level = F.nullif(F.length(F.regexp_extract("content", r"(?m)^(#{1,3}) ", 1)), F.lit(0))
    return ops.heading_groups(table(spark, d, "chunks"), level).select("chunk_row_id", "group_ordinal")


@query("SELECT chunk_row_id, CAST(floor((row_number() OVER (PARTITION BY document_id ORDER BY chunk_ordinal, chunk_row_id) - 1) / 6) AS INTEGER) AS group_ordinal FROM chunks")
def seq_groups(spark: SparkSession, d: str) -> DataFrame:
    return ops.sequential_groups(table(spark, d, "chunks")).select("chunk_row_id", "group_ordinal")


def _merged_sql(groups: str, most: int, least: int) -> str:
    """Parts of groups ``(document_id, group_ordinal, group_type, n)`` with the group they end up in, as ``parts``."""
    return f"""{groups},
    p AS (SELECT document_id, group_ordinal, group_type, k, least({most}, n - k * {most}) AS c FROM (SELECT *, unnest(range(0, CAST(floor((n - 1) / {most}) AS BIGINT) + 1)) AS k FROM g)),
    r AS (SELECT *, CASE WHEN c < {least} THEN coalesce(group_type, '') END AS kind FROM p),
    q AS (SELECT *, CASE WHEN kind IS NULL OR kind IS DISTINCT FROM lag(kind) OVER w THEN 1 ELSE 0 END AS starts FROM r WINDOW w AS (PARTITION BY document_id ORDER BY group_ordinal, k)),
    u AS (SELECT *, sum(starts) OVER (PARTITION BY document_id ORDER BY group_ordinal, k) AS run FROM q),
    v AS (SELECT *, (row_number() OVER (PARTITION BY document_id, run ORDER BY group_ordinal, k) - 1) % 2 = 0 AS opens FROM u),
    parts AS (SELECT *, CAST(sum(CASE WHEN opens THEN 1 ELSE 0 END) OVER (PARTITION BY document_id ORDER BY group_ordinal, k) - 1 AS INTEGER) AS new_ordinal FROM v)"""


@query(_merged_sql("WITH g AS (SELECT document_id, group_ordinal, min(chunk_type) AS group_type, count(*) AS n FROM chunks GROUP BY ALL)", 3, 2) + " SELECT document_id, new_ordinal, CAST(sum(c) AS BIGINT) AS chunk_count, count(*) AS n_merged FROM parts GROUP BY ALL")
def group_split_merge(spark: SparkSession, d: str) -> DataFrame:
    groups = table(spark, d, "chunks").groupBy("document_id", "group_ordinal").agg(F.min("chunk_type").alias("group_type"), F.count("*").alias("chunk_count"))
    return ops.split_and_merge(groups, 3, 2)


def _typed(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "chunks").select("chunk_row_id", "document_id", "chunk_ordinal", "content").withColumn("sheet_name", F.lit("Sheet1"))
    return chunking.dispatch_groups(rows, table(spark, d, "documents"))


def _sections(expression: str, types: str) -> str:
    """Section groups of the chunks of some document types."""
    return f"""(WITH c AS (SELECT chunk_row_id, document_id, chunk_ordinal, document_type, {expression} AS section FROM typed WHERE document_type IN ({types})),
    l AS (SELECT *, last_value(section IGNORE NULLS) OVER (PARTITION BY document_id ORDER BY chunk_ordinal, chunk_row_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS known,
        row_number() OVER (PARTITION BY document_id ORDER BY chunk_ordinal, chunk_row_id) AS k FROM c),
    o AS (SELECT *, CASE WHEN k = 1 OR (section IS NOT NULL AND section IS DISTINCT FROM known) THEN 1 ELSE 0 END AS opens FROM l)
    SELECT chunk_row_id, document_id, chunk_ordinal, CASE document_type WHEN 'pdf' THEN 'section' ELSE 'slide_set' END AS group_type, CAST(sum(opens) OVER (PARTITION BY document_id ORDER BY chunk_ordinal, chunk_row_id) - 1 AS INTEGER) AS group_ordinal FROM o)"""


_DISPATCH = f"""WITH typed AS (SELECT c.chunk_row_id, c.document_id, c.chunk_ordinal, c.content, CASE WHEN d.document_id IS NOT NULL THEN coalesce(d.document_type, 'unknown') END AS document_type FROM chunks c LEFT JOIN documents d ON d.document_id = c.document_id),
  heads AS (SELECT *, nullif(length(regexp_extract(content, '(?m)^(#{{1,3}}) ', 1)), 0) AS lv FROM typed WHERE document_type = 'docx'),
  least_ AS (SELECT *, min(lv) OVER (PARTITION BY document_id ORDER BY chunk_ordinal, chunk_row_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS least FROM heads),
  dispatched AS (
    SELECT * FROM {_sections(_SECTION, "'pdf'")} UNION ALL SELECT * FROM {_sections(_TOPIC, "'pptx'")}
    UNION ALL SELECT chunk_row_id, document_id, chunk_ordinal, 'heading_hierarchy', CAST(sum(CASE WHEN lv <= coalesce(least, lv) THEN 1 ELSE 0 END) OVER (PARTITION BY document_id ORDER BY chunk_ordinal, chunk_row_id) AS INTEGER) FROM least_
    UNION ALL SELECT chunk_row_id, document_id, chunk_ordinal, 'sheet_group', 0 FROM typed WHERE document_type = 'xlsx'
    UNION ALL SELECT chunk_row_id, document_id, chunk_ordinal, 'page_range', CAST(floor((row_number() OVER (PARTITION BY document_id ORDER BY chunk_ordinal, chunk_row_id) - 1) / 6) AS INTEGER) FROM typed WHERE document_type NOT IN ('pdf', 'pptx', 'docx', 'xlsx')
    UNION ALL SELECT chunk_row_id, document_id, chunk_ordinal, 'page_range', 0 FROM typed WHERE document_type IS NULL)"""


@query(_DISPATCH + " SELECT chunk_row_id, group_type, group_ordinal FROM dispatched")
def group_dispatch(spark: SparkSession, d: str) -> DataFrame:
    return _typed(spark, d).select("chunk_row_id", "group_type", "group_ordinal")


@query(
    _merged_sql(_DISPATCH + ", ranked AS (SELECT *, row_number() OVER (PARTITION BY document_id, group_ordinal ORDER BY chunk_ordinal, chunk_row_id) - 1 AS rank FROM dispatched), g AS (SELECT document_id, group_ordinal, group_type, count(*) AS n FROM dispatched GROUP BY ALL)", 4, 2)
    + r""", final AS (SELECT x.chunk_row_id, x.document_id, x.chunk_ordinal, x.group_type, new_ordinal AS group_ordinal FROM ranked x JOIN parts ON parts.document_id = x.document_id AND parts.group_ordinal = x.group_ordinal AND parts.k = floor(x.rank / 4)),
    sized AS (SELECT *, row_number() OVER (PARTITION BY document_id, group_ordinal ORDER BY chunk_ordinal, chunk_row_id) - 1 AS place, count(*) OVER (PARTITION BY document_id, group_ordinal) AS n_in_group FROM final)
    SELECT chunk_row_id, group_ordinal, place, n_in_group, regexp_replace(document_id || '_' || group_type || '_' || n_in_group || 'chunks', '[^\p{L}\p{N}_-]', '_', 'g') AS group_id FROM sized"""
)
def group_bounds(spark: SparkSession, d: str) -> DataFrame:
    return chunking.bounded_groups(_typed(spark, d).drop("content", "sheet_name"), 4, 2).select("chunk_row_id", "group_ordinal", "place", "n_in_group", "group_id")


_MAKE = f"""
WITH RECURSIVE f AS ({FIRST}), v AS (SELECT document_id, content_hash, arg_min(struct_pack(d := vlm_description, x := extracted_data), visual_id) AS v FROM visuals WHERE document_id IS NOT NULL AND content_hash IS NOT NULL GROUP BY ALL),
n AS (SELECT segment_id, pos, v.v.d AS d, v.v.x AS x FROM (SELECT segment_id, document_id, unnest(visual_references) AS content_hash, generate_subscripts(visual_references, 1) AS pos FROM f) r JOIN v USING (document_id, content_hash)),
notes AS (SELECT segment_id, CAST(sum({words("d")}) AS BIGINT) AS note_words, count(*) AS n_visuals,
    string_agg(nullif(concat_ws(chr(10), CASE WHEN d <> '' THEN '[VISUAL: ' || d || ']' END, CASE WHEN x <> '' THEN '[DATA: ' || x || ']' END), ''), chr(10) ORDER BY pos) AS lines FROM n GROUP BY segment_id),
s AS (SELECT f.*, {words("content")} + coalesce(note_words, 0) AS w, n_visuals AS nv, lines, row_number() OVER (PARTITION BY document_id ORDER BY segment_index) AS k FROM f LEFT JOIN notes USING (segment_id)),
p AS (SELECT document_id, k, w * 13 AS used, 0 AS chunk_ordinal FROM s WHERE k = 1
  UNION ALL SELECT s.document_id, s.k, CASE WHEN p.used + s.w * 13 > 2000 THEN s.w * 13 ELSE p.used + s.w * 13 END, CASE WHEN p.used + s.w * 13 > 2000 THEN p.chunk_ordinal + 1 ELSE p.chunk_ordinal END FROM p JOIN s ON s.document_id = p.document_id AND s.k = p.k + 1),
made AS (SELECT document_id, chunk_ordinal, string_agg(coalesce(content, ''), chr(10) || chr(10) ORDER BY segment_index) AS body, string_agg(lines, chr(10) ORDER BY segment_index) AS lines, CAST(sum(coalesce(nv, 0)) AS BIGINT) AS n_visuals,
    list('segment_' || segment_index ORDER BY segment_index) AS segment_references, bool_or(segment_type = 'table') AS t, bool_or(segment_type = 'text') AS x FROM s JOIN p USING (document_id, k) GROUP BY document_id, chunk_ordinal),
full_ AS (SELECT *, body || coalesce(chr(10) || chr(10) || nullif(lines, ''), '') AS content FROM made)
SELECT document_id || '__chunk_' || CASE WHEN chunk_ordinal < 1000 THEN lpad(CAST(chunk_ordinal AS VARCHAR), 3, '0') ELSE CAST(chunk_ordinal AS VARCHAR) END AS chunk_id, content, n_visuals, segment_references,
  CASE WHEN t THEN 'table_data' WHEN n_visuals > 0 AND x THEN 'hybrid' WHEN n_visuals > 0 THEN 'visual_context' ELSE 'content' END AS chunk_type,
  {words("content")} * 13 <= 2400 AND {words("content")} * 13 >= 200 AND {strip("content")} <> '' AS is_valid FROM full_
"""


@query(_MAKE)
def chunk_make(spark: SparkSession, d: str) -> DataFrame:
    made = chunking.make_chunks(_first(spark, d), table(spark, d, "visuals"), 200, 20)
    return made.select("chunk_id", "content", "n_visuals", "segment_references", "chunk_type", "is_valid")


@query()
def chunk_pipeline(spark: SparkSession, d: str) -> DataFrame:
    """All steps at once; each is compared with SQL in a query of its own, their composition with a loop over documents in the tests."""
    return _composed(spark, d)


@query()
def chunk_groups(spark: SparkSession, d: str) -> DataFrame:
    """The groups of all composed chunks."""
    return chunking.group_summaries(_composed(spark, d, inherit=False))


_PLACED = """placed AS (SELECT *, row_number() OVER (PARTITION BY document_id, group_ordinal ORDER BY chunk_ordinal, chunk_row_id) - 1 AS place, count(*) OVER (PARTITION BY document_id, group_ordinal) AS n_in_group FROM chunks)"""


@query(
    f"""WITH {_PLACED} SELECT chunk_row_id, place, n_in_group, place = 0 AS is_first, place = n_in_group - 1 AS is_last, place > 0 AND place < n_in_group - 1 AS is_middle,
    round(CASE WHEN n_in_group <= 1 THEN 1.0 ELSE CAST(place AS DOUBLE) / (n_in_group - 1) END, 6) AS progress FROM placed"""
)
def chunk_positions(spark: SparkSession, d: str) -> DataFrame:
    return ops.positions(table(spark, d, "chunks")).select("chunk_row_id", "place", "n_in_group", "is_first", "is_last", "is_middle", "progress")


@query(
    f"""WITH {_PLACED}, heads AS (SELECT document_id, group_ordinal, chunk_row_id AS source_row_id, array_to_string(string_split(content, '. ')[1:2], '. ') AS context FROM placed WHERE place = 0 AND n_in_group > 1)
    SELECT p.chunk_row_id, h.source_row_id, coalesce(h.source_row_id = p.chunk_row_id, false) AS generates, CASE WHEN place > 0 THEN h.context END AS context, CASE WHEN place > 0 AND h.source_row_id IS NOT NULL THEN place END AS freshness,
      CASE WHEN place > 0 AND h.source_row_id IS NOT NULL THEN CAST(round(greatest(0.1, 1.0 - 0.1 * place), 6) AS DOUBLE) END AS relevance
    FROM placed p LEFT JOIN heads h ON h.document_id = p.document_id AND h.group_ordinal = p.group_ordinal"""
)
def context_inheritance(spark: SparkSession, d: str) -> DataFrame:
    placed = ops.positions(table(spark, d, "chunks"))
    return ops.inherit_context(placed).select("chunk_row_id", "source_row_id", "generates", "context", "freshness", "relevance")


@query(
    """SELECT document_id, group_ordinal, count(*) AS chunk_count, round(sum(token_count), 1) AS total_tokens, min(page_range.start_page) AS start_page, max(page_range.end_page) AS end_page, bool_or(chunk_type = 'table_data') AS has_tables,
       arg_min(chunk_row_id, (chunk_ordinal, chunk_row_id)) AS first_chunk, arg_max(chunk_row_id, (chunk_ordinal, chunk_row_id)) AS last_chunk FROM chunks GROUP BY document_id, group_ordinal"""
)
def group_rollup(spark: SparkSession, d: str) -> DataFrame:
    return ops.roll_up(table(spark, d, "chunks"))


@query("SELECT chunk_type, count(*) AS n, count(*) FILTER (generates_context) AS generating FROM chunks GROUP BY chunk_type")
def chunk_types(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "chunks").groupBy("chunk_type").agg(F.count("*").alias("n"), F.count_if(F.col("generates_context")).alias("generating"))


@query(
    """SELECT chunk_row_id, list(segment_id ORDER BY pos, segment_id) AS segment_ids FROM (SELECT chunk_row_id, document_id, unnest(segment_references) AS ref, generate_subscripts(segment_references, 1) AS pos FROM chunks) r
       JOIN segments s ON s.document_id = r.document_id AND 'segment_' || s.segment_index = r.ref GROUP BY chunk_row_id"""
)
def chunk_segments(spark: SparkSession, d: str) -> DataFrame:
    refs = table(spark, d, "chunks").select("chunk_row_id", "document_id", F.posexplode("segment_references").alias("pos", "ref"))
    s = table(spark, d, "segments").select("document_id", "segment_id", F.concat(F.lit("segment_"), F.col("segment_index").cast("string")).alias("ref"))
    listed = F.array_sort(F.collect_list(F.struct("pos", "segment_id")))
    return refs.join(s, ["document_id", "ref"]).groupBy("chunk_row_id").agg(F.transform(listed, lambda x: x["segment_id"]).alias("segment_ids"))
