"""Queries on texts, segments and what surrounds them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirelake.common import table
from quirelake.functions import text as fx
from quirelake.operators import segments as ops
from quirelake.operators import tables
from quirelake.plans.registry import Registry

registry = Registry()
query = registry.add

# White space and its stripping, as SQL.
WS = r"[ \t\r\n\f]"


def strip(x: str) -> str:
    return rf"regexp_replace({x}, '^{WS}+|{WS}+\z', '', 'g')"


def words(x: str) -> str:
    return f"len(list_filter(regexp_split_to_array(coalesce({x}, ''), '{WS}+'), lambda w: w <> ''))"


def upper(x: str) -> str:
    return f"(upper({x}) = {x} AND lower({x}) <> {x})"


SUBTYPE = r"""CASE length(regexp_extract(content, '^(#+)[ \t]', 1)) WHEN 0 THEN
      CASE WHEN regexp_matches(content, '^([-*+] |[0-9]+\.)') THEN 'list' WHEN starts_with(content, '```') THEN 'code' WHEN starts_with(content, '>') THEN 'quote' ELSE 'paragraph' END
    WHEN 1 THEN 'heading_1' WHEN 2 THEN 'heading_2' ELSE 'heading_3' END"""

SEGMENTED = rf"""
WITH parts AS (SELECT doc_id, regexp_split_to_array(text, '\n\n+') AS p FROM documents WHERE text IS NOT NULL),
flat AS (SELECT doc_id, unnest(p) AS raw, generate_subscripts(p, 1) AS n FROM parts),
kept AS (SELECT doc_id, n, {strip("raw")} AS content FROM flat),
segs AS (SELECT doc_id, content, n FROM kept WHERE length(content) >= 20 OR starts_with(content, '#')),
numbered AS (SELECT doc_id, content, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY n) - 1 AS INTEGER) AS segment_index,
  CAST(coalesce(sum(length(content) + 2) OVER (PARTITION BY doc_id ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS INTEGER) AS start_pos FROM segs)
SELECT doc_id, segment_index, {SUBTYPE} AS segment_subtype, content, start_pos, CAST(start_pos + length(content) AS INTEGER) AS end_pos, CAST(length(content) AS INTEGER) AS length FROM numbered
"""


@query(SEGMENTED)
def txt_segments(spark: SparkSession, d: str) -> DataFrame:
    return ops.text_segments(table(spark, d, "documents"))


@query(f"SELECT segment_subtype, count(*) AS n FROM ({SEGMENTED}) GROUP BY segment_subtype")
def segment_histogram(spark: SparkSession, d: str) -> DataFrame:
    return txt_segments(spark, d).groupBy("segment_subtype").agg(F.count("*").alias("n"))


@query(f"SELECT doc_id, CAST({words('text')} AS INTEGER) AS n_words, CAST({words('text')} * 13 AS INTEGER) AS token_tenths FROM documents")
def token_estimate(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", fx.word_count(F.col("text")).alias("n_words"), (fx.estimate_tokens(F.col("text")) * 10).cast("int").alias("token_tenths"))


@query(
    rf"""SELECT segment_id, (coalesce(segment_subtype IN ('heading_1','heading_2','heading_3','title'), false) OR regexp_matches(content, '^[0-9]+\.?[0-9]*\.?[ \t]+[A-Z]')
        OR ({upper("content")} AND length(content) < 100)) AS is_marker FROM segments WHERE content IS NOT NULL"""
)
def section_markers(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "segments").where("content IS NOT NULL").select("segment_id", fx.section_marker(F.col("segment_subtype"), F.col("content")).alias("is_marker"))


@query(
    rf"""WITH s AS (SELECT page_id, coalesce(text, '') AS c FROM page_extractions),
    l AS (SELECT page_id, c, (length(c) < 100 AND ({upper("c")} OR ({upper("c[1]")} AND {words("c")} < 10))) AS short FROM s)
    SELECT page_id, CASE WHEN short AND regexp_matches(c, '^(1[0-9]|[1-9])[.)]') THEN 'heading_2' WHEN short AND regexp_matches(lower({strip("c")}), '^(chapter|section|part)') THEN 'heading_1'
      WHEN short THEN 'title' WHEN contains(c, '[LIST]') OR regexp_matches(c, '^([•*○-] |(1[0-9]|[1-9])\.)') THEN 'list' WHEN regexp_matches(c, '^(    |\t)') THEN 'code' ELSE 'paragraph' END AS subtype FROM l"""
)
def text_subtype(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "page_extractions").select("page_id", fx.pdf_subtype(F.coalesce("text", F.lit(""))).alias("subtype"))


def _clean(x: str) -> str:
    lines = f"list_filter(list_transform(string_split({x}, chr(10)), lambda l: {strip(f'regexp_replace(l, {chr(39)}{WS}+{chr(39)}, {chr(39)} {chr(39)}, {chr(39)}g{chr(39)})')}), lambda l: l <> '')"
    out = f"array_to_string({lines}, chr(10))"
    for old, new in (("ﬁ", "fi"), ("ﬂ", "fl"), ("ﬀ", "ff"), ("ﬃ", "ffi"), ("ﬄ", "ffl"), ("…", "..."), ("–", "-"), ("—", "--")):
        out = f"replace({out}, '{old}', '{new}')"
    return f"coalesce({out}, '')"


@query(f"SELECT page_id, {_clean('text')} AS content FROM page_extractions")
def clean_content(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "page_extractions").select("page_id", fx.clean_page_content(F.col("text")).alias("content"))


@query(
    """SELECT segment_id, last_value(CASE WHEN segment_subtype IN ('heading_1','heading_2','heading_3','title','subtitle') THEN content END IGNORE NULLS)
       OVER (PARTITION BY document_id ORDER BY segment_index, segment_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS nearest_heading FROM segments"""
)
def nearest_heading(spark: SparkSession, d: str) -> DataFrame:
    return ops.nearest_heading(table(spark, d, "segments")).select("segment_id", "nearest_heading")


@query(
    """SELECT segment_id, CASE WHEN page_number IS NULL THEN 'unknown' WHEN r / n < 0.33 THEN 'top' WHEN r / n < 0.67 THEN 'middle' ELSE 'bottom' END AS relative_position FROM (
         SELECT segment_id, page_number, CAST(row_number() OVER (PARTITION BY document_id, page_number ORDER BY segment_index, segment_id) - 1 AS DOUBLE) AS r,
           count(*) OVER (PARTITION BY document_id, page_number) AS n FROM segments)"""
)
def relative_position(spark: SparkSession, d: str) -> DataFrame:
    return ops.relative_position(table(spark, d, "segments")).select("segment_id", "relative_position")


_REF = "coalesce(" + ", ".join(
    f"CASE WHEN regexp_matches(content, '{p}') THEN {strip(f'regexp_extract(content, {chr(39)}(?s)(.{{0,50}}?{p}.{{0,50}}){chr(39)}, 1)')} END"
    for p in ("[Tt]abelle? *[0-9]+", "[Tt]able *[0-9]+", "[Ff]olgende +[Tt]abelle", "[Ff]ollowing +[Tt]able", "[Nn]achstehende +[Tt]abelle")
) + ")"


@query(
    f"""WITH r AS (SELECT segment_id, document_id, segment_index, {_REF} AS ref FROM segments)
    SELECT segment_id, coalesce(lag(ref, 3) OVER w, lag(ref, 2) OVER w, lag(ref, 1) OVER w) AS table_reference FROM r WINDOW w AS (PARTITION BY document_id ORDER BY segment_index, segment_id)"""
)
def table_reference(spark: SparkSession, d: str) -> DataFrame:
    return ops.preceding(table(spark, d, "segments")).select("segment_id", "table_reference")


_INTRO = rf"""CASE WHEN regexp_matches({strip("content")}, '([Ff]olgende +[\p{{L}}0-9_]+:|[Ff]ollowing +[\p{{L}}0-9_]+:|[Dd]ie +[\p{{L}}0-9_]+ +umfassen:|[Ii]ncluding:|[Ww]ie +folgt:|:\z)')
    THEN {strip(f"string_split({strip('content')}, '.')[-1]")} END"""


@query(
    f"""WITH r AS (SELECT segment_id, document_id, segment_index, {_INTRO} AS intro FROM segments)
    SELECT segment_id, lag(intro) OVER (PARTITION BY document_id ORDER BY segment_index, segment_id) AS list_introduction FROM r"""
)
def list_introduction(spark: SparkSession, d: str) -> DataFrame:
    return ops.preceding(table(spark, d, "segments")).select("segment_id", "list_introduction")


@query(
    """SELECT segment_id, coalesce(segment_type IN ('table','visual') OR (segment_type = 'text' AND (segment_subtype = 'list' OR contains(content, '•') OR contains(content, '●') OR contains(content, '- ')
        OR contains(content, '* ') OR contains(content, '1.') OR contains(content, '2.') OR contains(content, 'a)') OR contains(content, 'b)'))), false) AS needs_context FROM segments"""
)
def context_needed(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "segments")
    return s.select("segment_id", fx.needs_context(F.col("segment_type"), F.col("segment_subtype"), F.col("content")).alias("needs_context"))


_HEADS = "('heading_1','heading_2','heading_3','title','subtitle')"
_KIND = """CASE WHEN contains(t,'specification') OR contains(t,'technical') OR contains(t,'datasheet') THEN 'Technical Specification' WHEN contains(t,'manual') OR contains(t,'guide') OR contains(t,'instruction') THEN 'Manual'
    WHEN contains(t,'report') OR contains(t,'analysis') OR contains(t,'study') THEN 'Report' WHEN contains(t,'presentation') OR contains(t,'slides') THEN 'Presentation'
    WHEN contains(h,'motor') OR contains(h,'engine') OR contains(h,'performance') OR contains(h,'specification') THEN 'Technical Specification'
    WHEN contains(h,'price') OR contains(h,'cost') OR contains(h,'model') OR contains(h,'variant') THEN 'Product Catalog' ELSE 'Document' END"""


@query(
    f"""WITH heads AS (SELECT document_id, string_agg(content, ' ' ORDER BY segment_index, segment_id) AS heads FROM segments WHERE segment_subtype IN {_HEADS} AND segment_index < 20 GROUP BY document_id),
    t AS (SELECT d.document_id, lower(coalesce(regexp_extract(source_path, '([^/]*)\\.[^./]*$', 1), '')) AS t, lower(coalesce(heads, '')) AS h FROM documents d LEFT JOIN heads USING (document_id))
    SELECT document_id, {_KIND} AS document_kind FROM t"""
)
def document_kind(spark: SparkSession, d: str) -> DataFrame:
    titles = table(spark, d, "documents").select("document_id", F.regexp_extract("source_path", r"([^/]*)\.[^./]*$", 1).alias("title"))
    return ops.document_kinds(table(spark, d, "segments"), titles)


def _structured(x: str) -> str:
    lines, filled = f"string_split({strip(x)}, chr(10))", f"list_filter(string_split({strip(x)}, chr(10)), lambda l: {strip('l')} <> '')"
    one = lambda m: (
        f"(len(list_filter(list_filter({lines}[1:3], lambda l: {strip('l')} <> ''), lambda l: NOT contains(l, {m}))) = 0"
        f" AND len(list_distinct(list_transform({filled}[1:5], lambda l: length(l) - length(replace(l, {m}, ''))))) = 1)"
    )
    return f"coalesce(len({lines}) >= 2 AND ({one(chr(39) + '|' + chr(39))} OR {one('chr(9)')} OR {one(chr(39) + ',' + chr(39))}), false)"


_TYPE = rf"""CASE WHEN regexp_matches(c, '(?im)(table\s+[0-9]+[:.]|tabelle\s+[0-9]+[:.]|\btable\s+[ivx]+[:.]|^\s*\|.*\|.*\||.*\t.*\t.*)') THEN 'table'
    WHEN regexp_matches(c, '(?i)((chart|figure|fig\.|diagram|graph|abbildung)\s+[0-9]+[:.])') THEN 'chart' WHEN {_structured("c")} THEN 'table' ELSE 'paragraph' END"""


@query(f"SELECT segment_id, {_TYPE} AS content_type FROM (SELECT segment_id, content AS c FROM segments WHERE content IS NOT NULL)")
def detect_content_type(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "segments").where("content IS NOT NULL").select("segment_id", fx.content_type(F.col("content")).alias("content_type"))


@query(f"SELECT page_id, {_structured('text')} AS is_table FROM page_extractions WHERE text IS NOT NULL")
def structured_table(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "page_extractions").where("text IS NOT NULL").select("page_id", fx.structured_table(F.col("text")).alias("is_table"))


@query(
    f"""WITH l AS (SELECT segment_id, string_split({strip("content")}, chr(10)) AS ls FROM segments WHERE content IS NOT NULL),
    z AS (SELECT segment_id, len(ls) AS n, list_transform(list_filter(ls[1:5], lambda x: {strip("x")} <> ''), lambda x: length(x)) AS sizes FROM l)
    SELECT segment_id, coalesce(n >= 3 AND len(list_filter(sizes, lambda x: NOT abs(x * len(sizes) - list_sum(sizes)) * 5 < list_sum(sizes))) = 0, false) AS is_fixed FROM z"""
)
def fixed_width(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "segments").where("content IS NOT NULL").select("segment_id", tables.fixed_width(F.col("content")).alias("is_fixed"))


@query(
    f"""WITH s AS (SELECT segment_id, list_filter(string_split({strip("content")}, chr(10)), lambda l: {strip("l")} <> '') AS ls FROM segments WHERE segment_type = 'table' AND content IS NOT NULL),
    r AS (SELECT segment_id, list_filter(list_transform(ls, lambda l: list_filter(list_transform(string_split(l, '|'), lambda c: {strip("c")}), lambda c: c <> '')), lambda r: len(r) > 0) AS rows FROM s WHERE len(ls) >= 2 AND contains(ls[1], '|')),
    f AS (SELECT segment_id, rows[1] AS h, unnest(rows[2:]) AS cells, generate_subscripts(rows[2:], 1) AS n FROM r)
    SELECT segment_id, 'row_' || n AS subject, h[k] AS predicate, cells[k] AS object FROM (SELECT *, unnest(range(1, least(len(h), len(cells)) + 1)) AS k FROM f)"""
)
def table_triples(spark: SparkSession, d: str) -> DataFrame:
    return tables.table_triples(table(spark, d, "segments").where("segment_type = 'table'"), "segment_id", "content")


@query(
    """SELECT name, coalesce(t.kind, 'text') AS kind, coalesce(t.sub, name) AS sub FROM (SELECT DISTINCT segment_subtype AS name FROM segments UNION SELECT DISTINCT element_type FROM visuals UNION SELECT 'slide_notes' UNION SELECT 'data_row') n
       LEFT JOIN (VALUES ('text','text','paragraph'),('paragraph','text','paragraph'),('heading','text','heading_1'),('heading_1','text','heading_1'),('heading_2','text','heading_2'),('heading_3','text','heading_3'),('title','text','title'),
        ('subtitle','text','subtitle'),('caption','text','caption'),('quote','text','quote'),('list','text','list'),('footnote','text','footnote'),('code','text','code'),('table','table','data'),('data_row','table','data'),
        ('slide_notes','text','footnote'),('image','visual','image'),('chart','visual','chart'),('diagram','visual','diagram'),('formula','visual','formula')) t(k, kind, sub) ON t.k = name WHERE name IS NOT NULL"""
)
def legacy_types(spark: SparkSession, d: str) -> DataFrame:
    names = table(spark, d, "segments").select(F.col("segment_subtype").alias("name")).union(table(spark, d, "visuals").select("element_type")).union(spark.createDataFrame([("slide_notes",), ("data_row",)], "name string")).where("name IS NOT NULL").distinct()
    kind, sub = fx.legacy_type(F.col("name"))
    return names.select("name", kind.alias("kind"), sub.alias("sub"))


@query("SELECT document_id, CAST(('0x' || substr(md5(document_id), 1, 8)) AS BIGINT) % 100 < 25 AS chosen FROM documents")
def rollout_route(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("document_id", fx.rollout(F.col("document_id"), 25).alias("chosen"))


@query(
    """SELECT text_hash, doc_id FROM (SELECT md5(text) AS text_hash, doc_id, row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) AS n FROM documents WHERE text IS NOT NULL) WHERE n = 1"""
)
def hash_dedup(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").where("text IS NOT NULL").groupBy(F.md5("text").alias("text_hash")).agg(F.min("doc_id").alias("doc_id"))


@query(
    rf"""WITH c AS (SELECT chunk_row_id, inherited_context AS c, lower(inherited_context) AS low FROM chunks)
    SELECT chunk_row_id, CASE WHEN coalesce(c, '') = '' THEN 0.0 ELSE round(least(CASE WHEN {words("c")} * 13 BETWEEN 500 AND 3000 THEN 0.3 ELSE 0.0 END
      + least(0.1 * ({" + ".join(f"CAST(contains(low, '{t}') AS INTEGER)" for t in ("konzept", "definition", "wichtig", "hauptthema", "kernpunkt", "concept", "definition", "important", "main", "key", "thema", "inhalt", "aspekt", "punkt", "element"))}), 0.3)
      + CASE WHEN len(list_filter(string_split(c, '.'), lambda s: {strip("s")} <> '')) BETWEEN 2 AND 5 THEN 0.2 ELSE 0.0 END
      + 0.2 * coalesce(len(list_distinct(list_filter(regexp_split_to_array(low, '{WS}+'), lambda w: w <> ''))) / nullif({words("low")}, 0), 0.0), 1.0), 6) END AS quality FROM c"""
)
def context_quality(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "chunks").select("chunk_row_id", F.round(fx.context_quality(F.col("inherited_context")), 6).alias("quality"))


@query(
    f"""SELECT chunk_row_id, {strip("CASE WHEN contains(r, 'MAIN TASK RESULT:') THEN string_split(r, 'MAIN TASK RESULT:')[1] ELSE r END")} AS context, content AS result
        FROM (SELECT chunk_row_id, {strip("content")} AS content, coalesce(inherited_context, '') || ' MAIN TASK RESULT: ' AS r FROM chunks WHERE coalesce({strip("inherited_context")}, '') <> '' AND content IS NOT NULL)"""
)
def response_split(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "chunks").where((F.coalesce(fx.strip(F.col("inherited_context")), F.lit("")) != "") & F.col("content").isNotNull())
    response = F.concat(F.lit("CONTEXT SUMMARY: "), F.col("inherited_context"), F.lit(" MAIN TASK RESULT: "), F.col("content"))
    return rows.select("chunk_row_id", fx.response_context(response).alias("context"), fx.response_result(response).alias("result"))


@query(
    f"""WITH v AS (SELECT visual_id, lower(vlm_description) AS l FROM visuals WHERE vlm_description IS NOT NULL)
    SELECT visual_id, CASE {" ".join("WHEN " + " OR ".join(f"contains(l, '{t}')" for t in terms) + f" THEN '{kind}'" for kind, terms in (("chart", ("chart", "graph", "plot", "visualization")), ("diagram", ("diagram", "flowchart", "schematic", "architecture")), ("table", ("table", "grid", "spreadsheet")), ("screenshot", ("screenshot", "screen capture", "interface")), ("formula", ("formula", "equation", "mathematical")), ("map", ("map", "geographic", "location")), ("drawing", ("drawing", "sketch", "illustration"))))} ELSE 'image' END AS element_type FROM v"""
)
def element_types(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "visuals").where("vlm_description IS NOT NULL").select("visual_id", fx.element_type(F.col("vlm_description")).alias("element_type"))


@query(
    f"""WITH r AS (SELECT segment_id, document_id, segment_index, {_REF} AS ref, {_INTRO} AS intro, CASE WHEN segment_subtype IN {_HEADS} THEN content END AS heading FROM segments),
    c AS (SELECT segment_id, last_value(heading IGNORE NULLS) OVER (PARTITION BY document_id ORDER BY segment_index, segment_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS heading,
      coalesce(lag(ref, 3) OVER w, lag(ref, 2) OVER w, lag(ref, 1) OVER w) AS ref, lag(intro) OVER w AS intro FROM r WINDOW w AS (PARTITION BY document_id ORDER BY segment_index, segment_id))
    SELECT segment_id, concat_ws(' | ', 'Document type: Report', 'Under section: ' || heading, CASE WHEN ref IS NOT NULL THEN 'Referenced as: ' || ref WHEN intro IS NOT NULL THEN 'Introduced by: ' || intro END) AS context FROM c"""
)
def context_prompts(spark: SparkSession, d: str) -> DataFrame:
    rows = ops.preceding(ops.nearest_heading(table(spark, d, "segments")))
    return rows.select("segment_id", fx.context_prompt(F.lit("Report"), F.col("nearest_heading"), F.col("table_reference"), F.col("list_introduction")).alias("context"))


@query("SELECT chunk_row_id, CAST(greatest(1800 - coalesce(floor(token_count), 0), 600) AS INTEGER) AS budget FROM chunks")
def token_budget(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "chunks").select("chunk_row_id", fx.token_budget(2000, F.coalesce(F.floor("token_count"), F.lit(0))).alias("budget"))


@query(r"SELECT chunk_row_id, regexp_replace(group_id, '[^\p{L}\p{N}_-]', '_', 'g') AS name FROM chunks WHERE group_id IS NOT NULL")
def clean_group_ids(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "chunks").where("group_id IS NOT NULL").select("chunk_row_id", fx.clean_group_id(F.col("group_id")).alias("name"))


@query(r"SELECT chunk_row_id, regexp_replace(regexp_replace(regexp_replace(group_id, '[ \t\r\n\f]+', ' ', 'g'), '^[ \t\r\n\f]+|[ \t\r\n\f]+\z', '', 'g'), '[^\p{L}\p{N}_]', '_', 'g') AS name FROM chunks WHERE group_id IS NOT NULL")
def clean_names(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "chunks").where("group_id IS NOT NULL").select("chunk_row_id", fx.clean_header(F.col("group_id")).alias("name"))


@query("SELECT segment_id FROM segments WHERE segment_type = 'text' AND page_number = 2")
def segments_of_type(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "segments").where("segment_type = 'text' AND page_number = 2").select("segment_id")
