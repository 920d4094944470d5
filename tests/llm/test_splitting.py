import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from quirelake.common import table
from quirelake.llm.splitting import regroup, split_chunks, split_text


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["alpha", "b", " ", "\n\n", ". ", "\n", "漢字", "x" * 30, "\t", "# "]), max_size=60), st.integers(1, 40), st.integers(0, 20), st.sampled_from(["chars", "words"]))
def test_pieces(parts, limit, overlap, unit):
    text = "".join(parts)
    spans = split_text(text, limit, unit, overlap)
    count = lambda s: len(s) if unit == "chars" else len(re.findall(r"[^ \t\r\n]+", s))
    assert spans[0][0] == 0 and spans[-1][1] == len(text)
    for (a, b), (c, d) in zip(spans, spans[1:]):
        assert a < c <= b < d
        if unit == "chars":
            assert b - c == min(overlap, limit - 1)
    assert all(count(text[a:b]) <= limit for a, b in spans)
    assert len(spans) == 1 or count(text) > limit


PATTERNS = (r"\n(?=#{1,6}\s)", r"(?:\r\n|\r|\n)[ \t]*(?:\r\n|\r|\n)\s*", r"\r\n|\r|\n", r"[.!?。！？][\"'”»)\]]*\s+", r"[;:,]\s+", r"\s+")


def brute_force(text, limit, overlap):
    """Characters only: parts as strings, packed by trying every number of parts."""

    def parts(whole, spots, patterns):
        # Separators are found in the whole text and cut where they end inside this part.
        if len(whole) <= limit - overlap:
            return [whole]
        if not patterns:
            return list(whole)
        at = spots
        ends = [m.end() - at for m in re.finditer(patterns[0], text) if at < m.end() < at + len(whole)]
        out = []
        for a, b in zip([0, *ends], [*ends, len(whole)]):
            out += parts(whole[a:b], at + a, patterns[1:])
        return out

    if len(text) <= limit:
        return [text]
    left, pieces, carried = parts(text, 0, PATTERNS), [], ""
    while left:
        taken = max(n for n in range(len(left) + 1) if len(carried + "".join(left[:n])) <= limit)
        assert taken
        pieces.append(carried + "".join(left[:taken]))
        left = left[taken:]
        carried = pieces[-1][-overlap:] if overlap else ""
    return pieces


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(["alpha", "b", " ", "\n\n", ". ", "\n", "漢字", "x" * 30, "\t", "# ", ", ", "\r\n"]), max_size=60), st.integers(1, 40), st.integers(0, 20))
def test_pieces_equal_brute_force(parts, limit, overlap):
    text = "".join(parts)
    assert [text[a:b] for a, b in split_text(text, limit, "chars", overlap)] == brute_force(text, limit, min(overlap, limit - 1))


def test_recursion_goes_only_as_far_as_needed():
    sections = "# Pumps\nThe pump runs. It is new.\n\n", "# Valves\nThe valve is shut.\n\n\n"
    text = sections[0] + sections[1] + "The motor is off. " * 8 + "\n\n" + "x" * 130
    pieces = [text[a:b] for a, b in split_text(text, 60)]
    assert pieces[0] == sections[0] + "# Valves\n" or pieces[0] == sections[0]
    assert all(p.endswith((". ", "\n")) for p in pieces[:-3]) and [len(p) for p in pieces[-3:-1]] == [60, 60]


def test_natural_boundaries():
    text = "First sentence here. Second one follows. " * 6
    assert all(text[:b].endswith(". ") for _, b in split_text(text, 100, "chars", 0))


def test_word_overlap_is_exact():
    text = " ".join(f"w{n}" for n in range(100))
    spans = split_text(text, 20, "words", 5)
    for (_, b), (c, _) in zip(spans, spans[1:]):
        assert len(text[c:b].split()) == 5


def test_chunks_and_groups(spark, data):
    chunks, limits = table(spark, data, "chunks"), table(spark, data, "split_limits")
    pieces = split_chunks(chunks, limits)
    contents = {r.chunk_row_id: r.content for r in chunks.collect()}
    by = {}
    for r in pieces.collect():
        by.setdefault(r.chunk_row_id, []).append(r)
    assert set(by) == set(contents)
    for key, rows in by.items():
        rows.sort(key=lambda r: r.piece_no)
        if len(rows) > 1:
            whole, at = "", 0
            for r in rows:
                whole += r.content[at - r.start_char :]
                at = r.end_char
            assert whole == contents[key]
    placed = regroup(chunks, pieces, bucket=2).collect()
    groups = {}
    for r in placed:
        groups.setdefault((r.document_id, r.group_ordinal), []).append(r)
    for rows in groups.values():
        assert sorted(r.group_position for r in rows) == list(range(len(rows))) and {r.total_chunks for r in rows} == {len(rows)}


def test_odd_rows(spark):
    rows = [(1, None, "content"), (2, "", "content"), (3, "x y z", None), (4, "x y z", "none"), (5, "a b c d", "w")]
    chunks = spark.createDataFrame(rows, "chunk_row_id bigint, content string, chunk_type string")
    limits = spark.createDataFrame([("content", 3, "chars", 1), ("w", 2, "words", 1), ("w", 9, "words", 0), (None, 1, "chars", 0), ("none", None, "chars", 0)], "chunk_type string, max_size int, size_unit string, overlap_size int")
    got = {}
    for r in split_chunks(chunks, limits).collect():
        got.setdefault(r.chunk_row_id, []).append(r.content)
    assert got[1] == [None] and got[2] == [""] and got[3] == ["x y z"] and got[4] == ["x y z"] and len(got[5]) == 3
    random.seed(0)
