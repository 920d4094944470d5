"""Splitting oversized items at natural boundaries.

A text over its limit is split recursively down a hierarchy of separators
(sections, paragraphs, lines, sentences, clauses, words, characters): a part
that would not fit beside the overlap is split at the next finer separator. The
parts are then packed greedily: a piece takes parts while they fit. Each piece
after the first starts exactly the given overlap before the end of its
predecessor, so pieces end at natural boundaries, but where sizes are in
characters the shared overlap may begin inside a word.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quirelake.common import durable

#: From coarse to fine, the places after which a text may be cut. Characters come last of all.
SEPARATORS = tuple(
    re.compile(p)
    for p in (
        r"\n(?=#{1,6}\s)",
        r"(?:\r\n|\r|\n)[ \t]*(?:\r\n|\r|\n)\s*",
        r"\r\n|\r|\n",
        r"[.!?。！？][\"'”»)\]]*\s+",
        r"[;:,]\s+",
        r"\s+",
    )
)
_WORD, _BLANK = re.compile(r"[^ \t\r\n]+"), " \t\r\n"


def measure(content: Column, unit: Column) -> Column:
    """The size of ``content`` in ``unit``: code points for ``chars``, runs without space, tab, CR and LF for ``words``; 0 for null."""
    words = F.size(F.filter(F.split(content, r"[ \t\r\n]+"), lambda w: w != ""))
    return F.coalesce(F.when(unit == "words", words).otherwise(F.length(content)), F.lit(0))


class _Ruler:
    """Sizes and positions of a text in one unit."""

    def __init__(self, text: str, unit: str):
        self.words = [m.span() for m in _WORD.finditer(text)] if unit == "words" else None
        if self.words is not None:
            self.starts = [a for a, _ in self.words]
            self.ends = [b for _, b in self.words]

    def size(self, begin: int, end: int) -> int:
        if self.words is None:
            return end - begin
        # Words that begin before the end and end after the beginning: a cut word counts on both sides.
        return max(0, bisect_right(self.starts, end - 1) - bisect_right(self.ends, begin))

    def reach(self, begin: int, limit: int, length: int) -> int:
        """The largest end of a span from ``begin`` that is within ``limit``."""
        if self.words is None:
            return min(length, begin + limit)
        first = bisect_right(self.ends, begin)
        return self.starts[first + limit] if first + limit < len(self.starts) else length

    def back(self, end: int, overlap: int, floor: int) -> int:
        """Where the last ``overlap`` units before ``end`` begin."""
        if overlap <= 0:
            return end
        if self.words is None:
            return max(floor, end - overlap)
        last = bisect_right(self.starts, end - 1)
        return max(floor, self.starts[max(0, last - overlap)]) if last else end


def _parts(ruler: _Ruler, cuts: list[list[int]], begin: int, end: int, room: int, level: int = 0) -> Iterator[tuple[int, bool]]:
    """The ends of the parts of a span, each of at most ``room`` units; True with the end of a part that may be cut anywhere."""
    if ruler.size(begin, end) <= room:
        yield end, False
        return
    if level == len(cuts):
        yield end, True
        return
    places = cuts[level]
    inner = places[bisect_right(places, begin) : bisect_left(places, end)]
    for a, b in zip([begin, *inner], [*inner, end], strict=True):
        yield from _parts(ruler, cuts, a, b, room, level + 1)


def split_text(text: str, limit: int, unit: str = "chars", overlap: int = 0) -> list[tuple[int, int]]:
    """Spans ``(begin, end)`` of pieces of at most ``limit`` units that cover ``text`` in order.

    A text within the limit is one piece. Otherwise its parts, found by
    recursion, are packed greedily. The next piece starts ``overlap`` units
    before the end of the last; overlap is kept below the limit, so that every
    piece brings something new.
    """
    limit, length = max(1, limit), len(text)
    overlap = min(max(0, overlap), limit - 1)
    ruler = _Ruler(text, unit)
    if ruler.size(0, length) <= limit:
        return [(0, length)]
    cuts = [[m.end() for m in s.finditer(text)] for s in SEPARATORS]
    if unit == "words":
        # Some white space is no end of a word here.
        cuts = [[k for k in places if text[k - 1] in _BLANK or text[k : k + 1] in _BLANK] for places in cuts]
    spans, begin, done = [], 0, 0
    for end, anywhere in _parts(ruler, cuts, 0, length, limit - overlap):
        while ruler.size(begin, end) > limit:
            if anywhere:
                done = max(done, ruler.reach(begin, limit, end))
            spans.append((begin, done))
            begin = ruler.back(done, overlap, begin)
        done = end
    return [*spans, (begin, length)]


def split_chunks(chunks: DataFrame, limits: DataFrame) -> DataFrame:
    """Pieces of every chunk: ``(chunk_row_id, piece_no, n_pieces, content, start_char, end_char, n_units, size_unit)``.

    ``limits`` has one row a ``chunk_type`` (the least by value where repeated).
    Chunks within their limit, of a type without limit, of null type, with null
    limit, or with null or empty content give one piece, the content itself.
    Repeated rows each give their pieces.
    """
    bounds = limits.where("chunk_type IS NOT NULL AND max_size IS NOT NULL").groupBy("chunk_type").agg(F.min(F.struct("max_size", "size_unit", F.coalesce("overlap_size", F.lit(0)).alias("overlap_size"))).alias("bound"))
    rows = chunks.select("chunk_row_id", "content", "chunk_type").join(F.broadcast(bounds), "chunk_type", "left")
    rows = rows.withColumn("n_units", measure(F.col("content"), F.col("bound.size_unit")).cast("int"))
    over = F.coalesce(F.col("n_units") > F.col("bound.max_size"), F.lit(False))
    head = ["chunk_row_id", F.col("bound.size_unit").alias("size_unit")]
    whole = rows.where(~over).select(
        *head, F.lit(0).alias("piece_no"), F.lit(1).alias("n_pieces"), "content", F.lit(0).alias("start_char"), F.coalesce(F.length("content"), F.lit(0)).alias("end_char"), "n_units"
    )

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for row in pdf.itertuples(index=False):
                spans = split_text(row.content, int(row.max_size), row.size_unit, int(row.overlap_size))
                ruler = _Ruler(row.content, row.size_unit)
                out += [(row.chunk_row_id, row.size_unit, n, len(spans), row.content[a:b], a, b, ruler.size(a, b)) for n, (a, b) in enumerate(spans)]
            yield pd.DataFrame(out, columns=["chunk_row_id", "size_unit", "piece_no", "n_pieces", "content", "start_char", "end_char", "n_units"])

    kind = chunks.schema["chunk_row_id"].dataType.simpleString()
    pieces = rows.where(over).select(*head, "content", "bound.max_size", "bound.overlap_size").mapInPandas(
        cut, f"chunk_row_id {kind}, size_unit string, piece_no int, n_pieces int, content string, start_char int, end_char int, n_units int"
    )
    return whole.unionByName(pieces).select("chunk_row_id", "piece_no", "n_pieces", "content", "start_char", "end_char", "n_units", "size_unit")


def regroup(chunks: DataFrame, pieces: DataFrame, bucket: int = 1024) -> DataFrame:
    """``pieces`` with their place in the group and the group's true number of chunks.

    A group is ``(document_id, group_ordinal)``, nulls being a value like
    others; its order is ``group_position``, then ``chunk_ordinal``, then
    ``chunk_row_id``, nulls first. Places come from a prefix sum in two levels,
    so no group, however large, is brought into one task: chunks are ranked in
    buckets of nearby ordinals and buckets are summed before.
    """
    group = ["document_id", "group_ordinal"]
    # Counted and joined below, but split once.
    pieces = durable(pieces)
    counts = pieces.groupBy("chunk_row_id").agg(F.max("n_pieces").alias("n"))
    order = [F.col("group_position").asc_nulls_first(), F.col("chunk_ordinal").asc_nulls_first(), F.col("chunk_row_id")]
    rows = chunks.select("chunk_row_id", *group, "group_position", "chunk_ordinal").dropDuplicates(["chunk_row_id"]).join(counts, "chunk_row_id")
    # Chunks without a position come first in the order of their ordinals, so their buckets are by ordinal.
    unplaced = F.when(F.col("group_position").isNull(), F.floor(F.col("chunk_ordinal") / bucket))
    rows = rows.withColumn("bucket", F.struct(F.floor(F.col("group_position") / bucket).alias("a"), unplaced.alias("b")))
    sums = rows.groupBy(*group, "bucket").agg(F.sum("n").alias("in_bucket"))
    w = Window.partitionBy(*group)
    before = F.coalesce(F.sum("in_bucket").over(w.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sums = sums.select(F.struct(*group, "bucket").alias("at"), before.alias("before"), F.sum("in_bucket").over(w).alias("total_chunks"))
    inside = Window.partitionBy(*group, "bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("inner", F.coalesce(F.sum("n").over(inside), F.lit(0))).withColumn("at", F.struct(*group, "bucket"))
    placed = placed.join(sums, placed["at"].eqNullSafe(sums["at"])).select("chunk_row_id", *group, (F.col("before") + F.col("inner")).alias("first"), "total_chunks")
    out = pieces.join(placed, "chunk_row_id")
    return out.select(
        "chunk_row_id", *group, "piece_no", "n_pieces", "content", "n_units", "size_unit", (F.col("first") + F.col("piece_no")).alias("group_position"), "total_chunks"
    )
