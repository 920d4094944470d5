"""Scalar functions on text: column in, column out, all within the JVM."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from quirelake.schema import LEGACY_TYPES

#: White space as both engines' patterns understand it.
WS = r"[ \t\r\n\f]"


def strip(c: Column) -> Column:
    """Without white space at both ends."""
    return F.regexp_replace(c, rf"^{WS}+|{WS}+\z", "")


def words(c: Column) -> Column:
    """The runs without white space."""
    return F.filter(F.split(c, f"{WS}+"), lambda w: w != "")


def word_count(c: Column) -> Column:
    return F.when(c.isNull(), 0).otherwise(F.size(words(c)))


def estimate_tokens(c: Column) -> Column:
    """1.3 tokens a word; 0 for null."""
    return F.round(word_count(c) * 13 / 10, 1)


def token_budget(limit: int, context: Column) -> Column:
    """Tokens left for content: a tenth is reserved, at least three tenths stay."""
    return F.greatest(F.lit(int(limit * 0.9)) - context, F.lit(limit * 3 // 10)).cast("int")


def is_upper(c: Column) -> Column:
    """Has letters with case, all of them upper case."""
    return (F.upper(c) == c) & (F.lower(c) != c)


def any_contains(c: Column, terms: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(c, F.lit(t)) for t in terms])


def count_contains(c: Column, terms: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a + b, [F.contains(c, F.lit(t)).cast("int") for t in terms])


def clean_page_content(c: Column) -> Column:
    """Lines with single blanks, no blank lines, ligatures and dashes in plain characters."""
    lines = F.filter(F.transform(F.split(c, "\n"), lambda x: strip(F.regexp_replace(x, f"{WS}+", " "))), lambda x: x != "")
    out = F.array_join(lines, "\n")
    # Characters that page extraction leaves.
    for old, new in (("ﬁ", "fi"), ("ﬂ", "fl"), ("ﬀ", "ff"), ("ﬃ", "ffi"), ("ﬄ", "ffl"), ("…", "..."), ("–", "-"), ("—", "--")):
        out = F.replace(out, F.lit(old), F.lit(new))
    return F.coalesce(out, F.lit(""))


def txt_subtype(c: Column) -> Column:
    """Subtype of a paragraph of a text or Markdown file."""
    hashes = F.length(F.regexp_extract(c, r"^(#+)[ \t]", 1))
    return (
        F.when(hashes == 1, "heading_1").when(hashes == 2, "heading_2").when(hashes >= 3, "heading_3")
        .when(c.rlike(r"^([-*+] |[0-9]+\.)"), "list").when(F.startswith(c, F.lit("```")), "code").when(F.startswith(c, F.lit(">")), "quote")
        .otherwise("paragraph")
    )


def pdf_subtype(c: Column) -> Column:
    """Subtype of a text block of a PDF page."""
    first = F.substring(c, 1, 1)
    short = (F.length(c) < 100) & (is_upper(c) | (is_upper(first) & (word_count(c) < 10)))
    return (
        F.when(short & c.rlike(r"^(1[0-9]|[1-9])[.)]"), "heading_2").when(short & F.lower(strip(c)).rlike("^(chapter|section|part)"), "heading_1").when(short, "title")
        .when(F.contains(c, F.lit("[LIST]")) | c.rlike(r"^([•*○-] |(1[0-9]|[1-9])\.)"), "list").when(c.rlike(r"^(    |\t)"), "code").otherwise("paragraph")
    )


def section_marker(subtype: Column, c: Column) -> Column:
    """Whether a segment opens a section."""
    return F.coalesce(subtype.isin("heading_1", "heading_2", "heading_3", "title"), F.lit(False)) | c.rlike(r"^[0-9]+\.?[0-9]*\.?[ \t]+[A-Z]") | (is_upper(c) & (F.length(c) < 100))


def pdf_section(c: Column) -> Column:
    """The first section line among a chunk's first three lines; null if none."""
    lines = F.transform(F.slice(F.split(c, "\n"), 1, 3), strip)
    found = F.filter(lines, lambda x: x.rlike(r"^[0-9]+\.?[0-9]*\.?[ \t]+[A-Z]") | (is_upper(x) & (F.length(x) < 100)) | x.rlike(r"^[IVX]+\.[ \t]+[A-Z]"))
    return F.try_element_at(found, F.lit(1))


def slide_topic(c: Column) -> Column:
    """The first line that is not blank and does not open a bracket; null if none."""
    found = F.filter(F.split(c, "\n"), lambda x: (strip(x) != "") & ~F.startswith(x, F.lit("[")))
    return strip(F.try_element_at(found, F.lit(1)))


def structured_table(c: Column) -> Column:
    """At least two lines, and one delimiter in each of the first three and equally often in the first five that are not blank."""
    lines = F.split(strip(c), "\n")
    filled = F.filter(lines, lambda x: strip(x) != "")
    one = lambda d: (
        F.forall(F.filter(F.slice(lines, 1, 3), lambda x: strip(x) != ""), lambda x: F.contains(x, F.lit(d)))
        & (F.size(F.array_distinct(F.transform(F.slice(filled, 1, 5), lambda x: F.length(x) - F.length(F.replace(x, F.lit(d), F.lit("")))))) == 1)
    )
    return F.coalesce((F.size(lines) >= 2) & (one("|") | one("\t") | one(",")), F.lit(False))


# What captions of tables and charts look like, and lines with bars or tabs.
TABLE_MARKS = (r"table\s+[0-9]+[:.]", r"tabelle\s+[0-9]+[:.]", r"\btable\s+[ivx]+[:.]", r"^[^\S\n]*\|[^|\n]*\|[^|\n]*\|", r"\t[^\t\n]*\t")
CHART_MARKS = (r"chart\s+[0-9]+[:.]", r"figure\s+[0-9]+[:.]", r"fig\.\s+[0-9]+[:.]", r"diagram\s+[0-9]+[:.]", r"graph\s+[0-9]+[:.]", r"abbildung\s+[0-9]+[:.]")


def content_type(c: Column) -> Column:
    """``table``, ``chart`` or ``paragraph`` by what the text looks like."""
    table, chart = c.rlike(f"(?im){'|'.join(TABLE_MARKS)}"), c.rlike(f"(?i){'|'.join(CHART_MARKS)}")
    return F.when(table, "table").when(chart, "chart").when(structured_table(c), "table").otherwise("paragraph")


def legacy_type(name: Column) -> tuple[Column, Column]:
    """``(type, subtype)`` of a type name of older data."""
    pairs = [F.lit(x) for k, v in LEGACY_TYPES.items() for x in (k, v[0])]
    subs = [F.lit(x) for k, v in LEGACY_TYPES.items() for x in (k, v[1])]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), name), F.lit("text")), F.coalesce(F.try_element_at(F.create_map(*subs), name), name)


def needs_context(kind: Column, subtype: Column, c: Column) -> Column:
    """Tables, visuals, lists and texts with list marks gain from context."""
    # Marks of lists.
    marks = ("•", "●", "- ", "* ", "1.", "2.", "a)", "b)")
    return F.coalesce(kind.isin("table", "visual") | ((kind == "text") & ((subtype == "list") | any_contains(c, marks))), F.lit(False))


def table_reference(c: Column) -> Column:
    """Where a text refers to a table, with up to 50 characters around; by the first pattern that matches."""
    # Ways of referring to a table, in the order they are tried.
    patterns = ("[Tt]abelle? *[0-9]+", "[Tt]able *[0-9]+", "[Ff]olgende +[Tt]abelle", "[Ff]ollowing +[Tt]able", "[Nn]achstehende +[Tt]abelle")
    tried = [F.when(c.rlike(p), strip(F.regexp_extract(c, rf"(?s)(.{{0,50}}?{p}.{{0,50}})", 1))) for p in patterns]
    return F.coalesce(*tried)


def list_introduction(c: Column) -> Column:
    """The last sentence of a text that introduces a list; null for others."""
    text = strip(c)
    # Ways of introducing a list.
    introduces = text.rlike(r"([Ff]olgende +[\p{L}0-9_]+:|[Ff]ollowing +[\p{L}0-9_]+:|[Dd]ie +[\p{L}0-9_]+ +umfassen:|[Ii]ncluding:|[Ww]ie +folgt:|:\z)")
    return F.when(introduces, strip(F.element_at(F.split(text, r"\."), -1)))


def rollout(key: Column, percentage: int) -> Column:
    """Whether a key falls into the first ``percentage`` hundredths, the same each time."""
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint") % 100 < percentage


def clean_header(c: Column) -> Column:
    return F.regexp_replace(strip(F.regexp_replace(c, f"{WS}+", " ")), r"[^\p{L}\p{N}_]", "_")


def clean_group_id(c: Column) -> Column:
    """A group id with ``_`` for whatever is no letter, digit, ``_`` or ``-``."""
    return F.regexp_replace(c, r"[^\p{L}\p{N}_-]", "_")


def clean_value(c: Column) -> Column:
    return strip(F.regexp_replace(c, f"{WS}+", " "))


def element_type(description: Column) -> Column:
    """The visual element type a description speaks of."""
    low = F.lower(description)
    # Words by which a type is recognised, in the order they are tried.
    kinds = (
        ("chart", ("chart", "graph", "plot", "visualization")), ("diagram", ("diagram", "flowchart", "schematic", "architecture")), ("table", ("table", "grid", "spreadsheet")),
        ("screenshot", ("screenshot", "screen capture", "interface")), ("formula", ("formula", "equation", "mathematical")), ("map", ("map", "geographic", "location")), ("drawing", ("drawing", "sketch", "illustration")),
    )
    out = F.lit("image")
    for kind, terms in reversed(kinds):
        out = F.when(any_contains(low, terms), kind).otherwise(out)
    return out


def document_kind(title: Column, headings: Column, declared: Column | None = None) -> Column:
    """What kind of document it is: as declared where that is given and not empty, else by its title and else by its first headings."""
    if declared is not None:
        return F.when(F.coalesce(declared, F.lit("")) != "", declared).otherwise(document_kind(title, headings))
    low, heads = F.lower(F.coalesce(title, F.lit(""))), F.lower(F.coalesce(headings, F.lit("")))
    # Words of titles and headings.
    return (
        F.when(any_contains(low, ("specification", "technical", "datasheet")), "Technical Specification").when(any_contains(low, ("manual", "guide", "instruction")), "Manual")
        .when(any_contains(low, ("report", "analysis", "study")), "Report").when(any_contains(low, ("presentation", "slides")), "Presentation")
        .when(any_contains(heads, ("motor", "engine", "performance", "specification")), "Technical Specification").when(any_contains(heads, ("price", "cost", "model", "variant")), "Product Catalog")
        .otherwise("Document")
    )


def context_prompt(kind: Column, heading: Column, reference: Column, introduction: Column) -> Column:
    """The context of a segment in one line."""
    referred = F.when(reference.isNotNull(), F.concat(F.lit("Referenced as: "), reference)).when(introduction.isNotNull(), F.concat(F.lit("Introduced by: "), introduction))
    return F.concat_ws(" | ", F.concat(F.lit("Document type: "), kind), F.concat(F.lit("Under section: "), heading), referred)


#: Bounds of a context summary in tokens.
CONTEXT_MIN, CONTEXT_MAX = 50, 300


def context_quality(c: Column) -> Column:
    """A score from 0 to 1 of a context summary; 0 for null and empty."""
    low, tokens = F.lower(c), word_count(c) * 13
    # Words that point at content; one counts twice.
    terms = ("konzept", "definition", "wichtig", "hauptthema", "kernpunkt", "concept", "definition", "important", "main", "key", "thema", "inhalt", "aspekt", "punkt", "element")
    length = F.when((tokens >= CONTEXT_MIN * 10) & (tokens <= CONTEXT_MAX * 10), 0.3).otherwise(0.0)
    sentences = F.size(F.filter(F.split(c, r"\."), lambda s: strip(s) != ""))
    unique = F.try_divide(F.size(F.array_distinct(words(low))), F.size(words(low)))
    score = length + F.least(count_contains(low, terms) * 0.1, F.lit(0.3)) + F.when(sentences.between(2, 5), 0.2).otherwise(0.0) + F.coalesce(unique, F.lit(0.0)) * 0.2
    return F.when(F.coalesce(c, F.lit("")) == "", 0.0).otherwise(F.least(score, F.lit(1.0)))


# What heads the parts of a model's response.
CONTEXT_MARKERS = ("KONTEXT FÜR NACHFOLGENDE ABSCHNITTE:", "CONTEXT FOR FOLLOWING SECTIONS:", "CONTEXT SUMMARY:", "KONTEXTZUSAMMENFASSUNG:", "ZUSAMMENFASSUNG:")
RESULT_MARKERS = ("HAUPTAUFGABE ERGEBNIS:", "MAIN TASK RESULT:", "ERGEBNIS:", "RESULT:")


def _after(c: Column, markers: tuple[str, ...], until: tuple[str, ...]) -> Column:
    out = F.lit(None).cast("string")
    for marker in reversed(markers):
        rest = F.substring(c, F.instr(c, marker) + len(marker), F.length(c))
        cut = rest
        for other in reversed(until):
            cut = F.when(F.contains(rest, F.lit(other)), F.substring_index(rest, other, 1)).otherwise(cut)
        out = F.when(F.contains(c, F.lit(marker)), strip(cut)).otherwise(out)
    return out


def response_context(c: Column) -> Column:
    """The context part of a model's response; without marker its last paragraph."""
    found = _after(c, CONTEXT_MARKERS, RESULT_MARKERS)
    return F.when(F.coalesce(found, F.lit("")) == "", strip(F.element_at(F.split(c, "\n\n"), -1))).otherwise(found)


def response_result(c: Column) -> Column:
    """The result part of a model's response; null without marker."""
    return _after(c, RESULT_MARKERS, CONTEXT_MARKERS)


def clean_context(c: Column, limit: int = CONTEXT_MAX) -> Column:
    """A context summary without markup and markers, cut at a sentence to ``limit`` tokens."""
    out = F.regexp_replace(strip(F.regexp_replace(c, r"\n\s*\n", "\n")), "[*_`]", "")
    for marker in (*CONTEXT_MARKERS[:2], *RESULT_MARKERS[:2]):
        out = strip(F.replace(out, F.lit(marker), F.lit("")))
    start = F.struct(F.lit(0).alias("used"), F.lit(False).alias("full"), F.array().cast("array<string>").alias("kept"))
    step = lambda acc, s: F.struct(
        F.when(acc.full | (acc.used + word_count(s) * 13 > limit * 10), acc.used).otherwise(acc.used + word_count(s) * 13).alias("used"),
        (acc.full | (acc.used + word_count(s) * 13 > limit * 10)).alias("full"),
        F.when(acc.full | (acc.used + word_count(s) * 13 > limit * 10), acc.kept).otherwise(F.concat(acc.kept, F.array(s))).alias("kept"),
    )
    cut = F.array_join(F.aggregate(F.split(out, r"\. "), start, step).kept, ". ")
    cut = F.when(F.endswith(cut, F.lit(".")), cut).otherwise(F.concat(cut, F.lit(".")))
    return F.coalesce(F.when(word_count(out) * 13 > limit * 10, cut).otherwise(out), F.lit(""))
