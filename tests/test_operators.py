import random

import pytest
from pyspark.sql import functions as F

from quirelake.functions import text as fx
from quirelake.operators import chunking, chunks, graph, intervals, packing, segments, sparql, tables, vectors
from quirelake.operators.running import running


def brute_pack(weights, limit):
    out, used, number, any_ = [], 0, 0, False
    for w in weights:
        if any_ and used + w > limit:
            number, used = number + 1, 0
        used, any_ = used + w, True
        out.append(number)
    return out


@pytest.mark.parametrize("fold", [100_000, 3])
def test_pack_equals_brute_force(spark, fold):
    rng = random.Random(5)
    groups = {f"g{n}": [rng.choice([0, 1, 3, 7, 12, 40]) for _ in range(size)] for n, size in enumerate((1, 2, 7, 60))}
    rows = [(g, k, w) for g, ws in groups.items() for k, w in enumerate(ws)]
    df = spark.createDataFrame(rows, "g string, k int, w bigint")
    got = {(r.g, r.k): r.bin for r in packing.pack(df, ["g"], "k", "w", 20, fold_items=fold).collect()}
    assert got == {(g, k): b for g, ws in groups.items() for k, b in enumerate(brute_pack(ws, 20))}


def test_pack_empty(spark):
    df = spark.createDataFrame([], "g string, k int, w bigint")
    assert packing.pack(df, ["g"], "k", "w", 20).count() == 0


@pytest.mark.parametrize("how", ["last", "min", "sum"])
def test_running_equals_window(spark, how):
    rng = random.Random(3)
    rows = [(rng.choice("ab") if rng.random() < 0.9 else None, rng.randrange(40) if rng.random() < 0.95 else None, n, rng.choice([None, 1, 2, 5])) for n in range(300)]
    df = spark.createDataFrame(rows, "g string, p int, id int, v int")
    got = {r.id: r.out for r in running(df, ["g"], "p", [F.col("p"), F.col("id")], F.col("v"), "out", how, bucket=4).collect()}
    want = {}
    for g in ("a", "b", None):
        last, least, total = None, None, 0
        for _, p, n, v in sorted((r for r in rows if r[0] == g), key=lambda r: (r[1] is not None, r[1] or 0, r[2])):
            want[n] = {"last": last, "min": least, "sum": total}[how]
            if v is not None:
                last, least, total = v, v if least is None else min(least, v), total + v
    assert got == want


def test_spans_equal_brute_force(spark):
    rng = random.Random(1)
    text = "".join(rng.choice("abcdef") for _ in range(60))
    spans = [(1, a, min(60, a + rng.randrange(12))) for a in (rng.randrange(60) for _ in range(9))] + [(1, None, 3)]
    df = spark.createDataFrame(spans, "k int, start_pos int, end_pos int")
    merged = intervals.merge_spans(df, "k")
    covered = {c for _, a, b in spans if a is not None for c in range(a, b)}
    assert {c for r in merged.collect() for c in range(r.start_pos, r.end_pos)} == covered
    rest = intervals.outside(spark.createDataFrame([(1, text), (2, "whole"), (3, None)], "k int, t string"), merged, "k", "t").collect()
    assert "".join(r.content for r in sorted(rest, key=lambda r: r.start_pos) if r.k == 1) == "".join(c for n, c in enumerate(text) if n not in covered)
    assert [r.content for r in rest if r.k == 2] == ["whole"] and not [r for r in rest if r.k == 3]


def test_markdown_sample(spark):
    sample = "# Main Title\n\nThis is a paragraph with some text content.\n\n## Section Header\n\nAnother paragraph here.\n\n- List item 1\n- List item 2\n\n### Subsection\n\n> This is a quote block\n> with lines\n\n```python\ndef hello():\n    pass\n```\n\nFinal paragraph."
    df = spark.createDataFrame([(1, sample), (2, None), (3, "")], "doc_id int, text string")
    rows = segments.text_segments(df).orderBy("segment_index").collect()
    assert [r.segment_subtype for r in rows] == ["heading_1", "paragraph", "heading_2", "paragraph", "list", "heading_3", "quote", "code"]
    assert rows[1].start_pos == len("# Main Title") + 2


def test_two_tables_in_text(spark):
    text = "Model | Engine | Power\nA | 2.0 | 184\nB | 3.0 | 258"
    df = spark.createDataFrame([(1, text), (2, "no table"), (3, None)], "k int, t string")
    got = {(r.subject, r.predicate, r.object) for r in tables.table_triples(df, "k", "t").collect()}
    assert ("row_2", "Power", "258") in got and len(got) == 6
    kinds = spark.createDataFrame([("Table 1: x",), ("Figure 2. y",), ("a|b\nc|d",), ("plain text",)], "c string").select(fx.content_type(F.col("c")).alias("k")).collect()
    assert [r.k for r in kinds] == ["table", "chart", "table", "paragraph"]


def test_graph(spark):
    rows = [("a", "rdf:type", "X"), ("b", "rdf:type", "Y"), ("a", "to", "b"), ("b", "to", "c"), ("c", "to", "d"), ("a", "to", "b")]
    t = spark.createDataFrame(rows, "subject string, predicate string, object string")
    assert {r.o for r in sparql.solve(t, [("a", "to", "?m"), ("?m", "to", "?o")]).collect()} == {"c"}
    with pytest.raises(ValueError):
        sparql.solve(t, [("?a", "to", "?b"), ("?c", "to", "?d")])
    assert {(r.node, r.distance) for r in graph.explore(t, "a", 2).collect()} == {("a", 0), ("X", 1), ("b", 1), ("Y", 2), ("c", 2)}
    assert sparql.run(t, "ASK { <a> <to> ?x }").collect()[0].answer is True
    assert [r.x for r in sparql.run(t, "SELECT ?x WHERE { ?x a <Y> } LIMIT 5").collect()] == ["b"]
    assert sparql.run(t, "ASK { <a> <to> <b> }").collect()[0].answer is True and sparql.run(t, "ASK { <b> <to> <a> }").collect()[0].answer is False
    assert {r.subject for r in sparql.run(t, "DESCRIBE <b>").collect()} == {"a", "b"}
    refused = (
        "SELECT ?x", "SELECT ?x WHERE { }", "DESCRIBE", "SELECT ?y WHERE { ?x to ?z }", "SELECT ?x WHERE { ?x to ?y } GROUP BY ?x", "SELECT ?x WHERE { ?x to ?y . MINUS { ?x to <b> } }", "SELECT (COUNT(?x) AS ?n) WHERE { ?x to ?y }",
        "SELECT ?x WHERE { ?x to ?y FILTER(LANG(?y) = 'en') }", "SELECT ?x WHERE { ?x to/to ?y }", "SELECT ?x WHERE { ?x to ?y } LIMIT many", "SELECT ?x WHERE { GRAPH <g> { ?x to ?y } }", "SELECT ?x WHERE { ?x to ?y . BIND(1 AS ?z) }",
        "SELECT ?x WHERE { ?x to ?y", "INSERT DATA { <a> <to> <b> }", "SELECT ?x WHERE { ?x to ?y . FILTER(?q = 1) }", "SELECT ?x WHERE { ?x to ?y . OPTIONAL { ?y to ?z } ?z to ?x }", "SELECT ?x WHERE { { ?a to ?b } UNION { ?c to ?x } ?a to ?x }",
        "SELECT ?x WHERE { ?x to ?y } ORDER BY RAND()", "SELECT REDUCED ?x WHERE { ?x to ?y }", "SELECT ?x FROM <g> WHERE { ?x to ?y }", "SELECT ?x WHERE { ?x to ?y . FILTER NOT EXISTS { ?y to ?x } }",
    )
    for text in refused:
        with pytest.raises(ValueError):
            sparql.run(t, text)


def test_sparql_filters_and_numbers(spark):
    t = spark.createDataFrame([("a", "size", "9"), ("b", "size", "10"), ("c", "size", "many"), ("a", "name", 'A "x"'), ("b", "name", "Bee")], "subject string, predicate string, object string")

    def names(condition):
        return sorted(r.s for r in sparql.run(t, "SELECT ?s WHERE { ?s size ?n . OPTIONAL { ?s name ?m } FILTER(" + condition + ") }").collect())

    assert names("?n < 10") == ["a"] and names("?n >= 9 && ?n != 10") == ["a"] and names("?n = 10 || ?n = \"many\"") == ["b", "c"]
    assert names("BOUND(?m)") == ["a", "b"] and names("!BOUND(?m)") == ["c"] and names('CONTAINS(LCASE(?m), "x")') == ["a"] and names('STRSTARTS(?m, "A \\"")') == ["a"]
    assert names('REGEX(?m, "^BEE$", "i")') == ["b"] and names("STRLEN(?n) > 2") == ["c"]
    rows = sparql.run(t, "PREFIX ex: <http://x/> # sizes\nSELECT * WHERE { ?s size ?n ; name ?m . } ORDER BY ?n LIMIT 1").collect()
    assert [(r.s, r.n, r.m) for r in rows] == [("b", "10", "Bee")]


def test_closure_of_long_chains_and_circles(spark):
    chain = [(f"c{k}", f"c{k + 1}") for k in range(70)]
    up = {}
    for r in graph.closure(spark.createDataFrame([*chain, ("x", "y"), ("y", "x"), ("z", None)], "name string, parent string")).collect():
        up.setdefault(r.name, set()).add(r.ancestor)
    assert len(up["c0"]) == 71 and up["x"] == up["y"] == {"x", "y"} and up["z"] == {"z"}


def test_similar_leaves_out_what_has_no_direction(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [0.6, 0.8]), (5, [1.0, 0.0])], "vec_id int, embedding array<float>")
    assert [(r.vec_id, r.score) for r in vectors.top_similar(df, [1.0, 0.0], 3).collect()] == [(1, 1.0), (5, 1.0), (4, 0.6)]


def test_responses_and_context(spark):
    both = "CONTEXT SUMMARY: About engines. RESULT: 42"
    df = spark.createDataFrame([(both,), ("first\n\nlast part",), ("*bold* " + "word. " * 400,)], "c string")
    rows = df.select(fx.response_context(F.col("c")).alias("a"), fx.response_result(F.col("c")).alias("b"), fx.clean_context(F.col("c"), 20).alias("d")).collect()
    assert (rows[0].a, rows[0].b) == ("About engines.", "42")
    assert (rows[1].a, rows[1].b) == ("last part", None)
    assert rows[2].d.startswith("bold word. word") and len(rows[2].d.split()) <= 16


def test_single_chunk_inherits_nothing(spark):
    df = spark.createDataFrame([(1, "d", 0, 0, "One. Two. Three."), (2, "d", 1, 0, "x"), (3, "d", 2, 1, "y")], "chunk_row_id int, document_id string, chunk_ordinal int, group_ordinal int, content string")
    rows = {r.chunk_row_id: r for r in chunks.inherit_context(chunks.positions(df)).collect()}
    assert rows[1].generates and rows[2].context == "One. Two" and rows[2].freshness == 1 and rows[3].context is None


def test_merges_take_all_results_of_a_hash(spark, tmp_path):
    from quirelake.plans import catalog

    rows = [("h", 1, "a", 0.2), ("h", 2, "b", 0.9), ("h", 3, "c", 0.4), ("k", 4, "d", None)]
    spark.createDataFrame(rows, "content_hash string, analysis_id int, description string, confidence double").write.parquet(f"{tmp_path}/analysis_results.parquet")
    best, combined = ({(r.content_hash, r.description, r.confidence) for r in catalog.queries()[q](spark, str(tmp_path)).collect()} for q in ("merge_best_all", "merge_combine_all"))
    assert best == {("h", "b", 0.9), ("k", "d", 0.0)}
    assert combined == {("h", "a\n\nAdditional details: b\n\nAdditional details: c", 0.9), ("k", "d", 0.0)}


def test_chunking_whole_documents(spark):
    kinds = {"a": "docx", "b": "pdf", "c": "xlsx", "d": "txt", "e": None, "f": "pptx"}
    rows, n = [], 0
    rng = random.Random(5)
    for doc in kinds:
        for k in range(40):
            heading = rng.choice(["# Top", "## Sub", "1. Intro", "PLAIN", ""]) + "\n" if k % 3 == 0 else ""
            rows.append((n, doc, k, k // 4, "table" if k == 7 else "text", heading + "word " * rng.randint(1, 60), [f"h{k}"] if k % 5 == 0 else None, '{"sheet_name": "S%d"}' % (k // 9 % 2) if doc == "c" else None))
            n += 1
    rows.append((n, "g", 0, None, "visual", None, None, "no json"))
    s = spark.createDataFrame(rows, "segment_id int, document_id string, segment_index int, page_number int, segment_type string, content string, visual_references array<string>, metadata string")
    v = spark.createDataFrame([(1, "a", "h5", "a chart of pumps", '{"n": 1}'), (2, "a", "h5", "again", None), (3, "b", "h10", "", None)], "visual_id int, document_id string, content_hash string, vlm_description string, extracted_data string")
    d = spark.createDataFrame([(k, t) for k, t in kinds.items() if k != "e"] + [("e", None)], "document_id string, document_type string")
    out = chunking.chunk_documents(d, s, v, 100, 5).collect()
    by = {}
    for r in out:
        by.setdefault(r.document_id, []).append(r)
    assert set(by) == {*kinds, "g"}
    for doc, made in by.items():
        made.sort(key=lambda r: r.chunk_ordinal)
        mine = [r for r in rows if r[1] == doc]
        notes = {k: 4 for k in range(40) if doc == "a" and k == 5}
        assert brute_pack([(len((r[5] or "").split()) + notes.get(r[2], 0)) * 13 for r in mine], 1000) == [c.chunk_ordinal for c in made for _ in c.segment_references]
        assert [c.chunk_id for c in made] == [f"{doc}__chunk_{k:03d}" for k in range(len(made))]
        groups = {}
        for c in sorted(made, key=lambda c: (c.group_ordinal, c.place)):
            groups.setdefault(c.group_ordinal, []).append(c)
        assert sorted(groups) == list(range(len(groups)))
        for members in groups.values():
            assert [c.place for c in members] == list(range(len(members))) and {c.n_in_group for c in members} == {len(members)} and len(members) <= 8
            assert len({c.group_id for c in members}) == 1 and (len(members) == 1 or members[0].generates)
        sizes = [len(groups[k]) for k in sorted(groups)]
        assert all(not (a == b == 1) for a, b in zip(sizes, sizes[1:])) or max(sizes) <= 2
    assert any("[VISUAL: a chart of pumps]\n[DATA: {\"n\": 1}]" in c.content and c.chunk_type == "table_data" or c.chunk_type == "hybrid" for c in by["a"])
    assert {c.group_type for c in by["c"]} == {"sheet_group"} and {c.sheet_name for c in by["c"]} == {"S0", "S1"}
    assert {c.group_type for c in by["e"]} == {"page_range"} and by["g"][0].is_fallback and not by["g"][0].is_valid
    assert chunking.chunk_documents(d.limit(0), s.limit(0), v.limit(0)).count() == 0


def test_plans_of_chunk_groups_stay_small(spark, monkeypatch):
    s = spark.createDataFrame([(1, "a", 0, 1, "text", "# One\nword", ["h"], None)], "segment_id int, document_id string, segment_index int, page_number int, segment_type string, content string, visual_references array<string>, metadata string")
    v = spark.createDataFrame([(1, "a", "h", "a chart", None)], "visual_id int, document_id string, content_hash string, vlm_description string, extracted_data string")
    d = spark.createDataFrame([("a", "docx")], "document_id string, document_type string")
    sizes, write = [], chunking.durable
    leaves = lambda df: df._jdf.queryExecution().analyzed().collectLeaves().size()
    monkeypatch.setattr(chunking, "durable", lambda df: (sizes.append(leaves(df)), write(df))[1])
    groups = chunking.group_summaries(chunking.chunk_documents(d, s, v, 100, 1, inherit=False))
    full = chunking.chunk_documents(d, s, v, 100, 1)
    # Each reading of a table is a leaf; what is written begins anew.
    assert max(*sizes, leaves(groups)) <= 20
    # Texts are joined once to groups that have their context already.
    assert leaves(full) <= 5
    assert [(r.group_type, r.chunk_count, r.n_visuals) for r in groups.collect()] == [("heading_hierarchy", 1, 1)]


def test_small_groups_of_one_type_are_merged(spark):
    rng = random.Random(8)
    for _ in range(4):
        groups = [("d", k, rng.choice("xy"), rng.choice([1, 1, 1, 2, 3, 7])) for k in range(rng.randint(1, 12))]
        parts = [(k, t, min(3, n - p)) for _, k, t, n in groups for p in range(0, n, 3)]
        want, k = [], 0
        while k < len(parts):
            if k + 1 < len(parts) and parts[k][2] < 2 and parts[k + 1][2] < 2 and parts[k][1] == parts[k + 1][1]:
                want.append(2)
                k += 2
            else:
                want.append(parts[k][2])
                k += 1
        df = spark.createDataFrame(groups, "document_id string, group_ordinal int, group_type string, chunk_count int")
        assert [r.chunk_count for r in chunks.split_and_merge(df, 3, 2).orderBy("new_ordinal").collect()] == want
