"""Queries on extracted pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirelake.common import table
from quirelake.functions import text as fx
from quirelake.operators import pages as ops
from quirelake.operators import tables
from quirelake.plans.registry import Registry
from quirelake.plans.text_queries import strip
from quirelake.plans.visual_queries import _MODEL, _pages

registry = Registry()
query = registry.add

_CLEAN = strip("regexp_replace(x, '[ \\t\\r\\n\\f]+', ' ', 'g')")
_TABLES = f"""t AS (SELECT page_id, pos - 1 AS table_no, string_split(content, chr(10)) AS raw,
    list_filter(list_transform(string_split(content, chr(10)), lambda l: list_transform(string_split(l, '|'), lambda x: {_CLEAN})), lambda r: len(list_filter(r, lambda c: c <> '')) > 0) AS rows
  FROM (SELECT page_id, unnest(list_transform(tables, lambda x: x.content)) AS content, generate_subscripts(tables, 1) AS pos FROM page_extractions))"""


@query(
    f"""WITH {_TABLES} SELECT page_id, CAST(table_no AS INTEGER) AS table_no, rows[1] AS headers, rows[2:] AS data_rows, CAST(len(rows) - 1 AS INTEGER) AS row_count,
    array_to_string(rows[1], ' | ') || chr(10) || repeat('-', length(array_to_string(rows[1], ' | '))) || chr(10) || array_to_string(list_transform(rows[2:], lambda r: array_to_string(r, ' | ')), chr(10)) AS formatted FROM t WHERE len(raw) >= 2 AND len(rows) >= 2"""
)
def page_tables(spark: SparkSession, d: str) -> DataFrame:
    return ops.page_tables(table(spark, d, "page_extractions"))


def _layer(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Every page's text as a plain text layer shows it, with blanks for the bars of tables, and the cells of its tables."""
    pages = table(spark, d, "page_extractions")
    texts = pages.where("text IS NOT NULL").select("page_id", F.translate("text", "|", " ").alias("t"))
    cells = F.filter(ops.grid(F.col("x.content")), lambda r: F.exists(r, lambda c: fx.strip(c) != ""))
    return texts, pages.select("page_id", F.posexplode("tables").alias("table_no", "x")).select("page_id", "table_no", F.transform(cells, lambda r: F.transform(r, fx.strip)).alias("rows"))


def _position(text: str, cells: str) -> str:
    filled = f"list_filter(list_transform({cells}, lambda x: {strip('x')}), lambda x: x <> '')"
    pairs = f"list_transform(range(1, len({filled})), lambda k: regexp_replace({filled}[k], '([^A-Za-z0-9 ])', '\\\\\\1', 'g') || '\\s*' || regexp_replace({filled}[k + 1], '([^A-Za-z0-9 ])', '\\\\\\1', 'g'))"
    places = f"list_transform({pairs}, lambda p: CASE WHEN regexp_matches({text}, p) THEN strpos({text}, regexp_extract({text}, p)) ELSE 0 END)"
    return f"coalesce(list_filter({places}, lambda a: a > 0)[1], 0)"


_SPANS = f"""l AS (SELECT page_id, replace(text, '|', ' ') AS t FROM page_extractions WHERE text IS NOT NULL),
  g AS (SELECT page_id, pos, list_filter(list_transform(string_split(content, chr(10)), lambda l: string_split(l, '|')), lambda r: len(list_filter(r, lambda c: {strip("c")} <> '')) > 0) AS rows
    FROM (SELECT page_id, unnest(list_transform(tables, lambda x: x.content)) AS content, generate_subscripts(tables, 1) AS pos FROM page_extractions)),
  a AS (SELECT page_id, t, rows, {_position("t", "rows[1]")} AS s FROM g JOIN l USING (page_id) WHERE len(rows) > 0),
  b AS (SELECT page_id, t, s, {_position("substr(t, s)", "rows[len(rows)]")} AS k FROM a WHERE s > 0),
  e AS (SELECT page_id, s - 1 AS start_pos, CASE WHEN strpos(substr(t, s + k - 1), chr(10)) > 0 THEN s + k - 1 + strpos(substr(t, s + k - 1), chr(10)) - 2 ELSE s + k - 2 END AS end_pos FROM b WHERE k > 0),
  o AS (SELECT *, CASE WHEN start_pos <= max(end_pos) OVER (PARTITION BY page_id ORDER BY start_pos, end_pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS opens FROM e WHERE start_pos <= end_pos),
  m AS (SELECT *, sum(opens) OVER (PARTITION BY page_id ORDER BY start_pos, end_pos) AS n FROM o),
  spans AS (SELECT page_id, CAST(min(start_pos) AS INTEGER) AS start_pos, CAST(max(end_pos) AS INTEGER) AS end_pos FROM m GROUP BY page_id, n)"""


@query(f"WITH {_SPANS} SELECT * FROM spans")
def table_boundaries(spark: SparkSession, d: str) -> DataFrame:
    texts, cells = _layer(spark, d)
    return ops.table_spans(texts, cells, "page_id", "t")


@query(
    f"""WITH {_SPANS}, c AS (SELECT page_id, t, coalesce(list(struct_pack(a := start_pos, b := end_pos) ORDER BY start_pos) FILTER (start_pos IS NOT NULL), []) AS s FROM l LEFT JOIN spans USING (page_id) GROUP BY page_id, t),
    p AS (SELECT page_id, k, {strip("substr(t, CASE WHEN k = 0 THEN 0 ELSE s[k].b END + 1, CASE WHEN k = len(s) THEN length(t) ELSE s[k + 1].a END - CASE WHEN k = 0 THEN 0 ELSE s[k].b END)")} AS part FROM (SELECT *, unnest(range(0, len(s) + 1)) AS k FROM c)),
    pure AS (SELECT page_id, string_agg(part, chr(10) || chr(10) ORDER BY k) AS content FROM p WHERE part <> '' GROUP BY page_id)
    SELECT page_id, 0 AS segment_no, 'text' AS segment_type, content, 0 AS row_count FROM pure WHERE length(content) > 50
    UNION ALL SELECT page_id, CAST(pos AS INTEGER), 'table', array_to_string(list_transform(rows, lambda r: array_to_string(list_transform(r, lambda x: {strip("x")}), ' | ')), chr(10)), CAST(len(rows) AS INTEGER) FROM g"""
)
def separated_segments(spark: SparkSession, d: str) -> DataFrame:
    texts, cells = _layer(spark, d)
    return ops.separated_segments(texts, cells, "page_id", "t")


_PARTS = f"""e AS (
    SELECT page_id, document_id, page_number, 0 AS kind, k, 'text' AS tag, {strip("x")} AS content FROM (SELECT page_id, document_id, page_number, unnest(string_split_regex(coalesce(text, ''), '\\n[ \\t]*\\n\\s*')) AS x, generate_subscripts(string_split_regex(coalesce(text, ''), '\\n[ \\t]*\\n\\s*'), 1) AS k FROM page_extractions)
    UNION ALL SELECT page_id, document_id, page_number, 1, k, 'table', {strip("x.content")} FROM (SELECT page_id, document_id, page_number, unnest(tables) AS x, generate_subscripts(tables, 1) AS k FROM page_extractions)
    UNION ALL SELECT page_id, document_id, page_number, 2, k, CASE x.image_type WHEN 'picture' THEN 'image' ELSE x.image_type END, '[' || upper(x.image_type) || '] ' || coalesce(x.caption, '') FROM (SELECT page_id, document_id, page_number, unnest(images) AS x, generate_subscripts(images, 1) AS k FROM page_extractions)
    UNION ALL SELECT page_id, document_id, page_number, 3, k, 'formula', {strip("x.latex")} FROM (SELECT page_id, document_id, page_number, unnest(formulas) AS x, generate_subscripts(formulas, 1) AS k FROM page_extractions))"""


@query(
    f"""WITH {_PARTS} SELECT page_id, document_id, page_number, CAST(row_number() OVER (PARTITION BY page_id ORDER BY kind, k) - 1 AS INTEGER) AS part_no, CASE WHEN tag = 'table' THEN 'table' WHEN tag = 'text' THEN 'text' ELSE 'visual' END AS segment_type,
    CASE tag WHEN 'table' THEN 'data' WHEN 'text' THEN NULL ELSE tag END AS visual_subtype, content FROM e WHERE coalesce(content, '') <> ''"""
)
def page_segments(spark: SparkSession, d: str) -> DataFrame:
    rows = ops.page_segments(table(spark, d, "page_extractions"))
    return rows.withColumn("visual_subtype", F.when(F.col("segment_type") != "text", F.col("segment_subtype"))).drop("segment_subtype")


@query(f"WITH {_MODEL} SELECT document_id, page_number, text, 'model' AS origin, coalesce(confidence, 0.0) < 0.8 AS needs_review FROM model")
def hybrid_model_only(spark: SparkSession, d: str) -> DataFrame:
    return ops.hybrid_pages(*_pages(spark, d), mode=0)


@query(
    f"""WITH RECURSIVE {_MODEL}, f AS (SELECT document_id, page_number, content AS x, row_number() OVER (PARTITION BY document_id, page_number ORDER BY segment_id) AS k FROM segments WHERE page_number IS NOT NULL),
    w AS (SELECT document_id, page_number, coalesce(text, '') AS t, coalesce(text, '') AS merged, 0 AS k FROM model WHERE coalesce(confidence, 0.0) < 0.8
      UNION ALL SELECT w.document_id, w.page_number, w.t, CASE WHEN length(f.x) > length(w.merged) * 1.2 THEN f.x ELSE w.merged END, f.k FROM w JOIN f ON f.document_id = w.document_id AND f.page_number = w.page_number AND f.k = w.k + 1)
    SELECT document_id, page_number, text, 'model' AS origin, false AS needs_review FROM model WHERE coalesce(confidence, 0.0) >= 0.8
    UNION ALL SELECT document_id, page_number, arg_max(merged, k), CASE WHEN arg_max(merged, k) <> any_value(t) THEN 'fallback' ELSE 'model' END, true FROM w GROUP BY document_id, page_number
    UNION ALL SELECT document_id, page_number, x, 'fallback', false FROM f WHERE k = 1 AND document_id NOT IN (SELECT document_id FROM model WHERE document_id IS NOT NULL)"""
)
def hybrid_fallback(spark: SparkSession, d: str) -> DataFrame:
    return ops.hybrid_pages(*_pages(spark, d), mode=1)


@query(
    "WITH p AS (SELECT document_id, page_number, min(page_id) AS page_id FROM page_extractions GROUP BY ALL) SELECT segment_id, x.page_id AS raw_page_id, length(x.text) AS raw_length, CASE WHEN x.page_id IS NOT NULL THEN CAST(coalesce(len(x.tables), 0) AS INTEGER) END AS raw_tables FROM segments s LEFT JOIN p ON p.document_id = s.document_id AND p.page_number = s.page_number LEFT JOIN page_extractions x ON x.page_id = p.page_id"
)
def segment_pages(spark: SparkSession, d: str) -> DataFrame:
    rows = ops.with_page_payload(table(spark, d, "segments"), table(spark, d, "page_extractions"))
    return rows.select("segment_id", "raw_page_id", F.length("raw_text").alias("raw_length"), "raw_tables")


@query("SELECT i.page_id, pos AS image_no, CASE WHEN lower(t) IN ('chart', 'diagram', 'formula', 'image', 'figure') THEN 'visual' ELSE 'text' END AS kind, CASE WHEN lower(t) IN ('image', 'figure') THEN 'image' WHEN lower(t) IN ('chart', 'diagram', 'formula') THEN lower(t) ELSE 'paragraph' END AS subtype FROM (SELECT page_id, unnest(list_transform(images, lambda x: x.image_type)) AS t, generate_subscripts(images, 1) AS pos FROM page_extractions) i")
def tag_types(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "page_extractions").select("page_id", F.posexplode("images").alias("n", "i"))
    kind, subtype = ops.tag_type(F.col("i.image_type"))
    return rows.select("page_id", (F.col("n") + 1).cast("bigint").alias("image_no"), kind.alias("kind"), subtype.alias("subtype"))


_ENHANCED = """CASE WHEN segment_type = 'text' AND coalesce(segment_subtype, 'paragraph') = 'paragraph'"""


@query(
    f"""WITH k AS (SELECT segment_id, segment_type, segment_subtype, content, CASE WHEN regexp_matches(content, '(?im)(table\\s+[0-9]+[:.]|tabelle\\s+[0-9]+[:.]|\\btable\\s+[ivx]+[:.]|^\\s*\\|[^|\\n]*\\|[^|\\n]*\\||\\t[^\\t\\n]*\\t)') THEN 'table'
        WHEN regexp_matches(content, '(?i)((chart|figure|fig\\.|diagram|graph|abbildung)\\s+[0-9]+[:.])') THEN 'chart' WHEN s THEN 'table' ELSE 'paragraph' END AS found
      FROM (SELECT *, coalesce(len(l) >= 2 AND (len(list_filter(list_filter(l[1:3], lambda x: {strip("x")} <> ''), lambda x: NOT contains(x, '|'))) = 0 AND len(list_distinct(list_transform(list_filter(l, lambda x: {strip("x")} <> '')[1:5], lambda x: length(x) - length(replace(x, '|', ''))))) = 1
          OR len(list_filter(list_filter(l[1:3], lambda x: {strip("x")} <> ''), lambda x: NOT contains(x, ','))) = 0 AND len(list_distinct(list_transform(list_filter(l, lambda x: {strip("x")} <> '')[1:5], lambda x: length(x) - length(replace(x, ',', ''))))) = 1
          OR len(list_filter(list_filter(l[1:3], lambda x: {strip("x")} <> ''), lambda x: NOT contains(x, chr(9)))) = 0 AND len(list_distinct(list_transform(list_filter(l, lambda x: {strip("x")} <> '')[1:5], lambda x: length(x) - length(replace(x, chr(9), ''))))) = 1), false) AS s FROM (SELECT *, string_split({strip("content")}, chr(10)) AS l FROM segments WHERE content IS NOT NULL)))
    SELECT segment_id, {_ENHANCED} THEN CASE found WHEN 'table' THEN 'table' WHEN 'chart' THEN 'visual' ELSE 'text' END ELSE segment_type END AS segment_type,
      {_ENHANCED} THEN CASE found WHEN 'table' THEN 'data' ELSE found END ELSE segment_subtype END AS segment_subtype, found = 'table' AS is_table FROM k"""
)
def enhanced_segments(spark: SparkSession, d: str) -> DataFrame:
    return tables.with_structure(table(spark, d, "segments").where("content IS NOT NULL")).select("segment_id", "segment_type", "segment_subtype", "is_table")


@query(
    f"""WITH l AS (SELECT segment_id, list_transform(list_filter(string_split({strip("content")}, chr(10)), lambda x: {strip("x")} <> ''), lambda x: list_filter(regexp_split_to_array(x, '[ \\t\\r\\n\\f]+'), lambda w: w <> '')) AS rows FROM segments WHERE content IS NOT NULL)
    SELECT segment_id, rows[1] AS headers, CAST(len(rows) - 1 AS INTEGER) AS num_rows, CAST(len(rows[1]) AS INTEGER) AS num_columns FROM l WHERE len(rows) > 0"""
)
def fixed_width_parse(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "segments").where("content IS NOT NULL").select("segment_id", tables.parse_fixed_width(F.col("content")).alias("t")).where("t IS NOT NULL")
    return rows.select("segment_id", "t.headers", F.size("t.rows").alias("num_rows"), F.size("t.headers").alias("num_columns"))
