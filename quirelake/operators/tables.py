"""Tables inside texts: their structure, and triples from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirelake.functions import text as fx


def delimiter(c: Column) -> Column:
    """The first of bar, tab and comma that the first line has."""
    first = F.element_at(F.split(fx.strip(c), "\n"), 1)
    return F.when(F.contains(first, F.lit("|")), "|").when(F.contains(first, F.lit("\t")), "\t").when(F.contains(first, F.lit(",")), ",")


def parse_delimited(c: Column) -> Column:
    """``struct(headers, rows)`` of a delimited text with at least two lines; null for others. Bars drop empty cells."""
    lines = F.filter(F.split(fx.strip(c), "\n"), lambda x: fx.strip(x) != "")

    def cells(line: Column, mark: str) -> Column:
        parts = F.transform(F.split(line, r"\|" if mark == "|" else mark), fx.strip)
        return F.filter(parts, lambda x: x != "") if mark == "|" else parts

    def parsed(mark: str) -> Column:
        rows = F.filter(F.transform(lines, lambda x: cells(x, mark)), lambda r: F.size(r) > 0)
        return F.struct(F.try_element_at(rows, F.lit(1)).alias("headers"), F.slice(rows, F.lit(2), F.greatest(F.size(rows) - 1, F.lit(0))).alias("rows"))

    d = delimiter(c)
    return F.when(F.size(F.split(fx.strip(c), "\n")) >= 2, F.when(d == "|", parsed("|")).when(d == "\t", parsed("\t")).when(d == ",", parsed(",")))


def fixed_width(c: Column) -> Column:
    """At least three lines, the first five of lengths within a fifth of their mean."""
    lines = F.split(fx.strip(c), "\n")
    sizes = F.transform(F.filter(F.slice(lines, 1, 5), lambda x: fx.strip(x) != ""), lambda x: F.length(x))
    total = F.aggregate(sizes, F.lit(0), lambda a, x: a + x)
    # Compared as whole numbers: |n * size - total| < total / 5.
    return F.coalesce((F.size(lines) >= 3) & F.forall(sizes, lambda x: F.abs(x * F.size(sizes) - total) * 5 < total), F.lit(False))


def parse_fixed_width(c: Column) -> Column:
    """``struct(headers, rows)`` of lines cut at white space, the first that is not blank being the header; null without any."""
    lines = F.filter(F.split(fx.strip(c), "\n"), lambda x: fx.strip(x) != "")
    rows = F.transform(lines, fx.words)
    return F.when(F.size(rows) > 0, F.struct(F.try_element_at(rows, F.lit(1)).alias("headers"), F.slice(rows, F.lit(2), F.greatest(F.size(rows) - 1, F.lit(0))).alias("rows")))


def structure(c: Column) -> Column:
    """The structure of a table in text: delimited if it has a delimiter, else by fixed widths, else null."""
    return F.coalesce(parse_delimited(c), F.when(fixed_width(c), parse_fixed_width(c)))


def with_structure(segments: DataFrame) -> DataFrame:
    """``segments`` retyped by what their content looks like, with ``is_table``, ``table_structure`` and ``triple_count``.

    Only texts that are paragraphs or have no subtype are retyped; a structure
    comes wherever a table is seen.
    """
    found = fx.content_type(F.col("content"))
    rows = segments.withColumn("_found", found)
    plain = (F.col("segment_type") == "text") & (F.coalesce("segment_subtype", F.lit("paragraph")) == "paragraph")
    kind = F.when(F.col("_found") == "table", "table").when(F.col("_found") == "chart", "visual").otherwise("text")
    subtype = F.when(F.col("_found") == "table", "data").otherwise(F.col("_found"))
    shape = F.when(F.col("_found") == "table", structure(F.col("content")))
    width = lambda r: F.least(F.size(r), F.size(F.col("table_structure.headers")))
    rows = rows.withColumns({"segment_subtype": F.when(plain, subtype).otherwise(F.col("segment_subtype")), "segment_type": F.when(plain, kind).otherwise(F.col("segment_type")), "is_table": F.col("_found") == "table", "table_structure": shape})
    return rows.withColumn("triple_count", F.when(F.col("table_structure").isNotNull(), F.aggregate("table_structure.rows", F.lit(0), lambda n, r: n + width(r)))).drop("_found")


def table_triples(df: DataFrame, key: str, text_col: str) -> DataFrame:
    """``(key, subject, predicate, object)``: a triple for each cell with a header, subjects ``row_1``, ``row_2``, ..."""
    parsed = df.select(key, parse_delimited(F.col(text_col)).alias("_t")).where("_t IS NOT NULL")
    rows = parsed.select(key, F.col("_t.headers").alias("h"), F.posexplode("_t.rows").alias("n", "cells"))
    width = F.least(F.size("h"), F.size("cells"))
    cells = rows.where(width > 0).select(key, "n", F.explode(F.arrays_zip(F.slice("h", F.lit(1), width).alias("p"), F.slice("cells", F.lit(1), width).alias("o"))).alias("z"))
    return cells.select(key, F.concat(F.lit("row_"), (F.col("n") + 1).cast("string")).alias("subject"), F.col("z.p").alias("predicate"), F.col("z.o").alias("object"))


def row_triples(df: DataFrame, subject: Column, columns: dict[str, Column]) -> DataFrame:
    """``(subject, predicate, object)`` of a relational table, one for each named column that is not null."""
    listed = F.array(*(F.struct(F.lit(p).alias("predicate"), o.cast("string").alias("object")) for p, o in columns.items()))
    return df.select(subject.alias("subject"), F.explode(listed).alias("t")).select("subject", "t.predicate", "t.object").where("object IS NOT NULL")


def n_triples(triples: DataFrame) -> DataFrame:
    """``line``: N-Triples with all objects as literals, quotes and line ends escaped."""
    escaped = F.replace(F.replace(F.replace(F.col("object"), F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit("\n"), F.lit("\\n"))
    return triples.select(F.concat(F.lit("<"), F.col("subject"), F.lit("> <"), F.col("predicate"), F.lit('> "'), escaped, F.lit('" .')).alias("line"))


#: Triples of a subject in one block; a subject with more is written in several.
BLOCK = 1000
# The prefixes of Turtle files.
PREFIXES = {"rdf": "http://www.w3.org/1999/02/22-rdf-syntax-ns#", "rdfs": "http://www.w3.org/2000/01/rdf-schema#", "xsd": "http://www.w3.org/2001/XMLSchema#"}


def _blocks(triples: DataFrame, line: Column, before: Column, between: str, after: Column) -> DataFrame:
    """``(subject, block)``: the lines of a subject's triples in order, in blocks of about ``BLOCK``."""
    sizes = triples.groupBy("subject").agg(F.ceil(F.count("*") / BLOCK).alias("_parts"))
    large = sizes.where("_parts > 1")
    # Only subjects with more than a block are split, by the hash of their triples.
    part = F.coalesce(F.pmod(F.xxhash64("predicate", "object"), F.col("_parts")), F.lit(0))
    rows = triples.join(large, "subject", "left").select("subject", part.alias("_part"), F.struct("predicate", "object", line.alias("line")).alias("l"))
    listed = F.array_join(F.transform(F.array_sort(F.collect_list("l")), lambda x: x["line"]), between)
    return rows.groupBy("subject", "_part").agg(listed.alias("_b")).select("subject", F.concat(before, F.col("_b"), after).alias("block"))


def turtle_prefixes() -> str:
    """The head of a Turtle file."""
    return "\n".join(f"@prefix {name}: <{iri}> ." for name, iri in PREFIXES.items())


def turtle(triples: DataFrame) -> DataFrame:
    """``(subject, block)``: Turtle statements, the predicates of a subject in order."""
    line = F.concat(F.lit("    "), F.col("predicate"), F.lit(" "), F.col("object"))
    return _blocks(triples, line, F.concat(F.col("subject"), F.lit("\n")), " ;\n", F.lit(" ."))


def _xml(c: Column) -> Column:
    for sign, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(sign), F.lit(name))
    return c


def rdf_xml(triples: DataFrame) -> DataFrame:
    """``(subject, block)``: a description element for each subject, its objects as literals."""
    name = _xml(F.col("predicate"))
    line = F.concat(F.lit("  <"), name, F.lit(">"), _xml(F.col("object")), F.lit("</"), name, F.lit(">"))
    return _blocks(triples, line, F.concat(F.lit('<rdf:Description rdf:about="'), _xml(F.col("subject")), F.lit('">\n')), "\n", F.lit("\n</rdf:Description>"))


def json_ld(triples: DataFrame) -> DataFrame:
    """``(subject, block)``: an object for each subject with the values of each predicate in a list."""
    values = triples.groupBy("subject", "predicate", F.pmod(F.xxhash64("object"), F.lit(64)).alias("_salt")).agg(F.array_sort(F.collect_list("object")).alias("v"))
    sizes = values.groupBy("subject").agg(F.ceil(F.sum(F.size("v")) / BLOCK).alias("_parts"))
    # A subject of one block has all values of a predicate together; a larger one has them by salt.
    parts = values.join(sizes, "subject").withColumn("_part", F.when(F.col("_parts") > 1, F.col("_salt")).otherwise(F.lit(0)))
    joined = parts.groupBy("subject", "_part", "predicate").agg(F.array_sort(F.flatten(F.collect_list("v"))).alias("v"))
    text = lambda c: F.substring(F.to_json(F.array(c)), F.lit(2), F.length(F.to_json(F.array(c))) - 2)
    pair = F.concat(text(F.col("predicate")), F.lit(":"), F.to_json("v"))
    listed = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("predicate", pair.alias("p")))), lambda x: x["p"]), ",")
    return joined.groupBy("subject", "_part").agg(listed.alias("_b")).select("subject", F.concat(F.lit('{"@id":'), text(F.col("subject")), F.lit(","), F.col("_b"), F.lit("}")).alias("block"))


def bracketed(c: Column) -> tuple[Column, Column]:
    """Texts and tables of a text whose tables stand between ``[TABLE]`` and ``[/TABLE]`` lines."""
    parts = F.transform(F.split(c, r"\[/?TABLE\]"), fx.strip)
    is_table = lambda x: (x != "") & F.contains(c, F.concat(F.lit("[TABLE]\n"), x, F.lit("\n[/TABLE]")))
    return F.filter(parts, lambda x: (x != "") & ~is_table(x)), F.filter(parts, is_table)
