"""Reading pages that a document model wrote as tags with places, and JSON in model responses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quirelake.functions.text import strip

#: Consecutive equal lines from which on an output is taken for a runaway repetition.
REPEATS = 11
# The grammar of placed tags and of visual tags.
_PLACED = r"<(\w+)>(?:<loc_\d+>){4}([^<]+)</\1>"
_VISUAL = r"<(picture|image|figure|chart)><loc_(\d+)><loc_(\d+)><loc_(\d+)><loc_(\d+)>(?:([^<]*)</\1>)?"


def normalise(tags: Column) -> Column:
    """Tag names as the reader of tags knows them."""
    for old, new in (("paragraph", "text"), ("para", "text"), ("section_header", "section_header_level_1")):
        tags = F.replace(F.replace(tags, F.lit(f"<{old}>"), F.lit(f"<{new}>")), F.lit(f"</{old}>"), F.lit(f"</{new}>"))
    return tags


def _pairs(tags: Column, pattern: str, *groups: int) -> Column:
    return F.arrays_zip(*(F.regexp_extract_all(tags, F.lit(pattern), g).alias(f"g{g}") for g in groups))


def parse_pages(pages: DataFrame, tags_col: str = "doctags") -> DataFrame:
    """``pages`` with ``text``, ``tables``, ``images``, ``formulas`` and ``confidence`` of a page of tags.

    Text without any placed tag is taken from whatever stands between tags and
    is longer than three characters. Null and empty pages give empty text and
    arrays.
    """
    c = strip(normalise(F.coalesce(F.col(tags_col), F.lit(""))))
    rows = pages.withColumn("_p", _pairs(c, _PLACED, 1, 2)).withColumn("_v", _pairs(c, _VISUAL, 1, 2, 3, 4, 5, 6))
    content = lambda x: strip(x["g2"])
    is_text = lambda x: (content(x) != "") & (x["g1"].isin("paragraph", "text", "section_header", "title", "caption") | ((x["g1"] == "page_header") & ~content(x).rlike("^[0-9]+$")))
    texts = F.transform(F.filter("_p", is_text), content)
    loose = F.filter(F.transform(F.regexp_extract_all(c, F.lit(r">([^<]+)<"), 1), strip), lambda x: (F.length(x) > 3) & ~F.startswith(x, F.lit("loc_")))
    tables = F.transform(F.filter("_p", lambda x: x["g1"] == "table"), lambda x: F.struct(content(x).alias("content"), F.lit("text").alias("table_format")))
    formulas = F.transform(F.filter("_p", lambda x: x["g1"].isin("formula", "equation")), lambda x: F.struct(content(x).alias("latex"), F.lit("formula").alias("formula_type")))
    images = F.transform(
        "_v", lambda x: F.struct(F.array(*(x[f"g{k}"].cast("int") for k in range(2, 6))).alias("bbox"), strip(F.coalesce(x["g6"], F.lit(""))).alias("caption"), x["g1"].alias("image_type"), F.lit(False).alias("has_data"))
    )
    out = rows.withColumns({"text": F.array_join(F.when(F.size(texts) > 0, texts).otherwise(loose), "\n"), "tables": tables, "images": images, "formulas": formulas, "confidence": F.lit(0.8)})
    return out.drop("_p", "_v")


def cut_repetitions(pages: DataFrame, key: str, tags_col: str = "doctags", repeats: int = REPEATS) -> DataFrame:
    """``pages`` with ``cut``: the tags up to the first of ``repeats`` equal consecutive lines, blank lines not counted, and ``cut_failed``.

    What is cut has its open tags closed and a comment added; with fewer than
    two meaningful tags left the page has failed. Pages without such a run stay
    as they are.
    """
    lines = pages.select(key, F.posexplode(F.split(tags_col, "\n")).alias("n", "line"))
    w = Window.partitionBy(key).orderBy("n")
    runs = lines.where(strip(F.col("line")) != "").withColumn("_new", (~F.col("line").eqNullSafe(F.lag("line").over(w))).cast("int")).withColumn("_run", F.sum("_new").over(w))
    at = F.row_number().over(Window.partitionBy(key, "_run").orderBy("n"))
    first = runs.withColumn("_k", at).where(F.col("_k") == repeats).groupBy(key).agg(F.min(F.col("n") - (repeats - 1)).alias("_at"))
    rows = pages.join(first, key, "left")
    head = F.array_join(F.slice(F.split(tags_col, "\n"), F.lit(1), F.greatest(F.col("_at"), F.lit(0))), "\n")
    opened = F.filter(F.regexp_extract_all(head, F.lit(r"<(\w+)>"), 1), lambda t: ~t.rlike("^(loc.*|nl)$"))
    closed = F.regexp_extract_all(head, F.lit(r"</(\w+)>"), 1)
    # Each closing tag takes away one opening tag of its name.
    left = F.aggregate(closed, opened, lambda acc, t: F.when(F.array_position(acc, t) > 0, F.concat(F.slice(acc, F.lit(1), (F.array_position(acc, t) - 1).cast("int")), F.slice(acc, (F.array_position(acc, t) + 1).cast("int"), F.size(acc)))).otherwise(acc))
    ends = F.array_join(F.transform(F.reverse(left), lambda t: F.concat(F.lit("\n</"), t, F.lit(">"))), "")
    meaningful = F.regexp_count(head, F.lit(r"<(text|paragraph|section_header|title|caption|table|picture|formula|code)>"))
    whole = F.concat(head, ends, F.lit("\n<!-- output truncated at a repetition -->"))
    found = F.col("_at").isNotNull()
    return rows.withColumn("cut", F.when(found, whole).otherwise(F.col(tags_col))).withColumn("cut_failed", found & (meaningful < 2)).drop("_at")


def table_cells(df: DataFrame, key: str, text_col: str) -> DataFrame:
    """``(key, row, col, text)`` of tables written as ``TableCell(...)`` with text and offsets; of cells at one place the last by text."""
    cells = F.regexp_extract_all(text_col, F.lit(r"TableCell\(((?:[^()]|\([^()]*\))*)\)"), 1)
    one = df.select(key, F.explode(cells).alias("c"))
    number = lambda name: F.try_to_number(F.regexp_extract("c", name + r"=(\d+)", 1), F.lit("999999")).cast("int")
    text = F.when(F.col("c").rlike("text='"), F.regexp_extract("c", "text='([^']*)'", 1)).when(F.col("c").rlike('text="'), F.regexp_extract("c", 'text="([^"]*)"', 1))
    rows = one.select(key, number("start_row_offset_idx").alias("row"), number("start_col_offset_idx").alias("col"), text.alias("text")).where("row IS NOT NULL AND col IS NOT NULL AND text IS NOT NULL")
    return rows.groupBy(key, "row", "col").agg(F.max("text").alias("text"))


def markdown_table(cells: DataFrame, key: str) -> DataFrame:
    """``(key, markdown)``: cells as a Markdown table, missing ones empty, a rule below the first row."""
    grid = cells.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct(F.concat_ws(",", F.col("row").cast("string"), F.col("col").cast("string")).alias("k"), F.col("text").alias("v")))).alias("m"), F.max("row").alias("r"), F.max("col").alias("c"))
    line = lambda r: F.concat(F.lit("| "), F.array_join(F.transform(F.sequence(F.lit(0), F.col("c")), lambda k: F.coalesce(F.try_element_at("m", F.concat_ws(",", r.cast("string"), k.cast("string"))), F.lit(""))), " | "), F.lit(" |"))
    lines = F.transform(F.sequence(F.lit(0), F.col("r")), line)
    rule = F.concat(F.lit("|"), F.array_join(F.transform(F.sequence(F.lit(0), F.col("c")), lambda _: F.lit(" --- ")), "|"), F.lit("|"))
    return grid.select(key, F.array_join(F.concat(F.slice(lines, 1, 1), F.array(rule), F.slice(lines, F.lit(2), F.size(lines))), "\n").alias("markdown"))


def _is_json(c: Column) -> Column:
    """Whether a text is JSON as a whole. The reader stops after the first value, so the text is read inside an array and inside an object: what follows a value spoils one of them."""
    one = F.size(F.from_json(F.concat(F.lit("["), c, F.lit("]")), "array<string>")) == 1
    return F.coalesce(one & F.from_json(F.concat(F.lit('{"x":'), c, F.lit("}")), "struct<x:string>")["x"].isNotNull(), F.lit(False))


def json_of(response: Column) -> Column:
    """The JSON that a model's response holds: itself, a fenced block, or the longest object in it that parses; null for none."""
    c = strip(response)
    fenced = strip(F.regexp_extract(c, r"(?s)```json\s*(.*?)```", 1))
    found = F.concat(*(F.array_sort(F.regexp_extract_all(c, F.lit(p), 0), lambda a, b: F.length(b) - F.length(a)) for p in (r"\{[^{}]*\}", r"(?s)\{.*?\}", r"(?s)\{.*\}")))
    # What models put before JSON.
    bare = F.regexp_replace(F.regexp_replace(c, r"^(Here's the JSON:|The JSON output is:|JSON:|Response:|Answer:)\s*", ""), r"```(?:json)?\s*", "")
    tried = F.concat(F.array(c, fenced), found, F.array(bare))
    return F.try_element_at(F.filter(tried, lambda x: (x != "") & x.rlike(r"^\s*[\[{]") & _is_json(x)), F.lit(1))


def json_or_default(response: Column) -> Column:
    """The JSON of a response, or where it has none one that is made of its text; null for null and empty."""
    made = F.to_json(F.struct(response.alias("description"), F.lit(0.7).alias("confidence"), F.lit("unknown_visual").alias("element_type")))
    return F.coalesce(json_of(response), F.when(strip(response) != "", made))


# The fields of responses in plain text and how they are written.
FIELDS = (
    ("model", r"(?i)(?:Model|Modell):\s*([^\n,]+)"), ("motor", r"(?i)(?:Motor|Engine):\s*([^\n,]+)"), ("power", r"(?i)(\d+)\s*(?:kW|PS|hp)"), ("torque", r"(?i)(\d+)\s*(?:Nm|lb-ft)"),
    ("table_rows", r"(?i)(?:Row|Zeile)\s*\d+:\s*([^\n]+)"), ("columns", r"(?i)(?:Column|Spalte)s?:\s*([^\n]+)"),
)


def response_fields(response: Column) -> Column:
    """Named values in a response of plain text, as a map; null if there are none."""
    pairs = F.filter(F.array(*(F.struct(F.lit(k).alias("key"), F.regexp_extract_all(response, F.lit(p), 1).alias("value")) for k, p in FIELDS)), lambda x: F.size(x["value"]) > 0)
    return F.when(F.size(pairs) > 0, F.map_from_entries(pairs))


def structured_response(response: Column) -> Column:
    """``struct(type, format, json, fields)`` of a response: an object in it, else named values, else plain text; null for null and empty."""
    found = F.when(strip(json_of(response)).startswith("{") & (F.size(F.json_object_keys(json_of(response))) > 0), json_of(response))
    fields = F.when(found.isNull(), response_fields(response))
    kind = F.when(found.isNotNull() | fields.isNotNull(), "structured").otherwise("text")
    form = F.when(found.isNotNull(), "json").when(fields.isNotNull(), "text_extracted").otherwise("plain")
    return F.when(F.coalesce(response, F.lit("")) != "", F.struct(kind.alias("type"), form.alias("format"), found.alias("json"), fields.alias("fields")))


def page_type(response: Column) -> Column:
    """What kind of page a response in plain text describes."""
    low = F.lower(response)
    return F.when(low.rlike("title|deckblatt"), "title").when(low.rlike("content|inhalt"), "table_of_contents").when(low.rlike("technical|technisch"), "technical_specification").otherwise("content")


def page_context(response: Column) -> Column:
    """``struct(page_type, main_topic, key_information)`` of a response: by its JSON's keys, else by its words; null for null."""
    found = F.when(strip(json_of(response)).startswith("{"), json_of(response))
    value = lambda k: F.get_json_object(found, f"$.{k}")
    kind = F.when(found.isNotNull(), F.coalesce(value("page_type"), F.lit("content"))).otherwise(page_type(response))
    return F.when(response.isNotNull(), F.struct(kind.alias("page_type"), value("main_topic").alias("main_topic"), F.coalesce(F.from_json(value("key_information"), "array<string>"), F.array().cast("array<string>")).alias("key_information")))


def extraction_triples(df: DataFrame, key: str, response_col: str, most: int = 50) -> DataFrame:
    """``(key, subject, predicate, object, confidence)`` of responses ``{"triples": [...]}``; confidence 0.8 where missing, at most ``most`` a response."""
    schema = "struct<triples:array<struct<subject:string,predicate:string,object:string,confidence:double,context:string>>>"
    parsed = F.from_json(json_of(F.col(response_col)), schema)["triples"]
    rows = df.select(key, F.posexplode(F.slice(parsed, 1, most)).alias("n", "t")).where("t.subject IS NOT NULL AND t.predicate IS NOT NULL AND t.object IS NOT NULL")
    return rows.select(key, "t.subject", "t.predicate", "t.object", F.coalesce("t.confidence", F.lit(0.8)).alias("confidence"))
