"""Chunks: packing segments, validating, grouping, inheriting context."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quirelake.functions import text as fx
from quirelake.operators.packing import pack
from quirelake.operators.running import running


def pack_segments(segments: DataFrame, max_tokens: int = 200, keys: tuple[str, ...] = ("document_id",)) -> DataFrame:
    """``segments`` with ``chunk_ordinal``: packed in order up to ``max_tokens`` (1.3 a word)."""
    # Ten times the tokens, so that all sums are whole.
    rows = segments.withColumn("_tenths", fx.word_count(F.col("content")) * 13)
    return pack(rows, list(keys), "segment_index", "_tenths", max_tokens * 10, "chunk_ordinal").drop("_tenths")


def assemble(packed: DataFrame, keys: tuple[str, ...] = ("document_id",), max_tokens: int = 200, min_tokens: int = 20) -> DataFrame:
    """The chunks of packed segments with their text, tokens, pages, type and validity."""
    listed = F.array_sort(F.collect_list(F.struct("segment_index", "content")))
    chunks = packed.groupBy(*keys, "chunk_ordinal").agg(
        F.array_join(F.transform(listed, lambda x: x["content"]), "\n\n").alias("content"),
        F.count("*").alias("n_segments"),
        F.sum(fx.word_count(F.col("content"))).alias("n_words"),
        F.min("page_number").alias("start_page"),
        F.max("page_number").alias("end_page"),
        F.max((F.col("segment_type") == "table").cast("int")).alias("_table"),
        F.max((F.col("segment_type") == "visual").cast("int")).alias("_visual"),
        F.max((F.col("segment_type") == "text").cast("int")).alias("_text"),
    )
    kind = F.when(F.col("_table") == 1, "table_data").when((F.col("_visual") == 1) & (F.col("_text") == 1), "hybrid").when(F.col("_visual") == 1, "visual_context").otherwise("content")
    valid = (F.col("n_words") * 13 <= int(max_tokens * 1.2) * 10) & (F.col("n_words") * 13 >= min_tokens * 10) & (fx.strip(F.col("content")) != "")
    return chunks.withColumn("chunk_type", kind).withColumn("is_valid", valid).drop("_table", "_visual", "_text")


def chunk_statistics(chunks: DataFrame, by: list[str], context: Column, visual: Column) -> DataFrame:
    """Counts, token sums and zero-safe ratios of chunks with ``content``, ``token_count`` and ``inherited_context``.

    ``efficiency`` is the part of all tokens that is content and no inherited context.
    """
    share = lambda a, b: F.round(F.coalesce(F.try_divide(a, b), F.lit(0.0)), 6)
    out = chunks.groupBy(*by).agg(
        F.count("*").alias("n_chunks"), F.round(F.sum("token_count"), 1).alias("tokens"), F.count_if(context).alias("with_context"), F.count_if(visual).alias("with_visuals"),
        F.count_if(F.coalesce(fx.strip(F.col("content")), F.lit("")) == "").alias("empty_chunks"), (F.sum(fx.word_count(F.col("inherited_context")) * 13) / 10).alias("_context"),
    )
    out = out.withColumn("efficiency", share(F.col("tokens"), F.col("tokens") + F.col("_context"))).drop("_context")
    return out.withColumns({"avg_tokens": share(F.col("tokens"), F.col("n_chunks")), "context_coverage": share(F.col("with_context"), F.col("n_chunks")), "visual_coverage": share(F.col("with_visuals"), F.col("n_chunks"))})


def section_groups(chunks: DataFrame, section: Column, into: str = "group_ordinal") -> DataFrame:
    """``chunks`` with ``section`` and their group: a new one where the section differs from the last one known."""
    order = [F.col("chunk_ordinal"), F.col("chunk_row_id")]
    rows = running(chunks.withColumn("section", section), ["document_id"], "chunk_ordinal", order, F.col("section"), "_last", "last")
    opens = (F.col("section").isNotNull() & ~F.col("section").eqNullSafe(F.col("_last"))).cast("int")
    # The first chunks of a document without any section are group 0 like those of its first section.
    counted = running(rows.withColumn("_opens", opens), ["document_id"], "chunk_ordinal", order, F.col("_opens"), "_opened", "sum")
    first = F.when(F.col("_opens") + F.col("_opened") > 0, F.col("_opens") + F.col("_opened") - 1).otherwise(0)
    starts = counted.groupBy("document_id").agg((F.min_by("_opens", F.struct(*order)) == 0).alias("_headless"))
    joined = counted.join(starts, "document_id")
    number = F.when(F.col("_headless"), F.col("_opens") + F.col("_opened")).otherwise(first)
    return joined.withColumn(into, number.cast("int")).drop("_last", "_opens", "_opened", "_headless")


def heading_groups(chunks: DataFrame, level: Column, into: str = "group_ordinal") -> DataFrame:
    """``chunks`` with their group by heading level: a new one at a heading not deeper than the group's own.

    A group's level is its first heading's; levels of groups never rise, so a
    heading opens a group exactly if none before it was higher up.
    """
    order = [F.col("chunk_ordinal"), F.col("chunk_row_id")]
    rows = running(chunks.withColumn("_level", level), ["document_id"], "chunk_ordinal", order, F.col("_level"), "_least", "min")
    opens = F.coalesce(F.col("_level") <= F.coalesce("_least", F.col("_level")), F.lit(False)).cast("int")
    rows = running(rows.withColumn("_opens", opens), ["document_id"], "chunk_ordinal", order, F.col("_opens"), "_opened", "sum")
    return rows.withColumn(into, (F.col("_opens") + F.col("_opened")).cast("int")).drop("_level", "_least", "_opens", "_opened")


def sequential_groups(chunks: DataFrame, size: int = 6, into: str = "group_ordinal") -> DataFrame:
    """``chunks`` in groups of ``size`` in the order of their ordinals."""
    order = [F.col("chunk_ordinal"), F.col("chunk_row_id")]
    return running(chunks, ["document_id"], "chunk_ordinal", order, F.lit(1), "_rank", "sum").withColumn(into, F.floor(F.col("_rank") / size).cast("int")).drop("_rank")


def merged_parts(groups: DataFrame, most: int = 8, least: int = 2) -> DataFrame:
    """``(document_id, group_ordinal, part_no, new_ordinal)``: the groups that parts of ``groups`` (with ``chunk_count`` and ``group_type``) end up in.

    Groups are split into parts of at most ``most`` chunks; then, inside each
    run of consecutive parts of one type that are smaller than ``least``, every
    two become one.
    """
    last = F.floor((F.col("chunk_count") - 1) / most).cast("int")
    parts = groups.where("chunk_count > 0").select("document_id", "group_ordinal", "group_type", F.explode(F.sequence(F.lit(0), last)).alias("part_no"), "chunk_count")
    small = F.least(F.lit(most), F.col("chunk_count") - F.col("part_no") * most) < least
    w = Window.partitionBy("document_id").orderBy("group_ordinal", "part_no")
    kind = F.when(small, F.coalesce("group_type", F.lit("")))
    # A part continues a run if it is small and of the type of the part before it, which is small too.
    rows = parts.withColumn("_kind", kind).withColumn("_starts", (F.col("_kind").isNull() | ~F.col("_kind").eqNullSafe(F.lag("_kind").over(w))).cast("int")).withColumn("_run", F.sum("_starts").over(w))
    at = F.row_number().over(Window.partitionBy("document_id", "_run").orderBy("group_ordinal", "part_no")) - 1
    rows = rows.withColumn("_opens", (at % 2 == 0).cast("int"))
    return rows.select("document_id", "group_ordinal", "part_no", (F.sum("_opens").over(w) - 1).cast("int").alias("new_ordinal"))


def split_and_merge(groups: DataFrame, most: int = 8, least: int = 2) -> DataFrame:
    """Groups ``(document_id, group_ordinal, group_type, chunk_count)`` split and merged: ``(document_id, new_ordinal, chunk_count, n_merged)``."""
    parts = merged_parts(groups, most, least).join(groups, ["document_id", "group_ordinal"])
    size = F.least(F.lit(most), F.col("chunk_count") - F.col("part_no") * most)
    return parts.groupBy("document_id", "new_ordinal").agg(F.sum(size).alias("chunk_count"), F.count("*").alias("n_merged"))


def positions(chunks: DataFrame, keys: tuple[str, ...] = ("document_id", "group_ordinal")) -> DataFrame:
    """``chunks`` with place, size, first, last and progress in their group."""
    order = [F.col("chunk_ordinal"), F.col("chunk_row_id")]
    sizes = chunks.groupBy(*keys).agg(F.count("*").alias("n_in_group"))
    placed = running(chunks, list(keys), "chunk_ordinal", order, F.lit(1), "place", "sum").join(sizes, list(keys))
    n = F.col("n_in_group")
    return placed.withColumns(
        {"is_first": F.col("place") == 0, "is_last": F.col("place") == n - 1, "is_middle": (F.col("place") > 0) & (F.col("place") < n - 1), "progress": F.round(F.when(n <= 1, 1.0).otherwise(F.col("place") / (n - 1)), 6)}
    )


def inherit_context(placed: DataFrame, keys: tuple[str, ...] = ("document_id", "group_ordinal"), sentences: int = 2) -> DataFrame:
    """``placed`` chunks with the context of their group: the first sentences of its first chunk.

    The first chunk generates it, the others inherit it with falling relevance;
    groups of one chunk have none.
    """
    return inherited(placed, placed.where(HEADS).select(*keys, F.col("chunk_row_id").alias("source_row_id"), summary(sentences).alias("context")), keys)


#: The chunks that others inherit from.
HEADS = "place = 0 AND n_in_group > 1"


def summary(sentences: int = 2) -> Column:
    """The first sentences of ``content``."""
    return F.array_join(F.slice(F.split("content", r"\. "), 1, sentences), ". ")


def inherited(placed: DataFrame, heads: DataFrame, keys: tuple[str, ...] = ("document_id", "group_ordinal")) -> DataFrame:
    """``placed`` with what they inherit from ``heads``: the keys, ``source_row_id`` and ``context``, a row a group."""
    relevance = F.greatest(F.lit(0.1), F.lit(1.0) - 0.1 * F.col("place"))
    later = (F.col("place") > 0) & F.col("source_row_id").isNotNull()
    heads = heads.select(*keys, "source_row_id", "context")
    return placed.join(heads, list(keys), "left").withColumns(
        {"generates": F.coalesce(F.col("source_row_id") == F.col("chunk_row_id"), F.lit(False)), "context": F.when(later, F.col("context")), "freshness": F.when(later, F.col("place")), "relevance": F.when(later, F.round(relevance, 6))}
    )


def roll_up(chunks: DataFrame, keys: tuple[str, ...] = ("document_id", "group_ordinal")) -> DataFrame:
    """Groups of chunks: counts, tokens and pages."""
    return chunks.groupBy(*keys).agg(
        F.count("*").alias("chunk_count"), F.round(F.sum("token_count"), 1).alias("total_tokens"), F.min("page_range.start_page").alias("start_page"), F.max("page_range.end_page").alias("end_page"),
        F.bool_or(F.col("chunk_type") == "table_data").alias("has_tables"), F.min_by("chunk_row_id", F.struct("chunk_ordinal", "chunk_row_id")).alias("first_chunk"), F.max_by("chunk_row_id", F.struct("chunk_ordinal", "chunk_row_id")).alias("last_chunk"),
    )
