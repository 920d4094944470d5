import json
import random
import re

import pytest
from pyspark.sql import functions as F

from quirelake.facade import Engine
from quirelake.functions import prompts
from quirelake.functions import text as fx
from quirelake.operators import chunking, extraction, pages, reports, running, segments, tables, visuals
from quirelake.sinks import export
from quirelake.sources import config, doctags, files, ooxml
from quirelake.streaming import ingest


def column(spark, values, kind, make):
    df = spark.createDataFrame([(n, v) for n, v in enumerate(values)], f"n int, v {kind}")
    return [r.x for r in df.select("n", make(F.col("v")).alias("x")).orderBy("n").collect()]


def test_table_text(spark):
    rows = [[["A ", "B\nC"], [None, ""], ["1", "2"]], [["A", "B"], [" ", None]], [["A"]], None, []]
    got = column(spark, rows, "array<array<string>>", pages.table_text)
    assert got[0].headers == ["A", "B C"] and got[0].data_rows == [["1", "2"]] and got[0].formatted == "A | B C\n-------\n1 | 2" and got[1:] == [None] * 4


def test_tables_in_raw_text(spark):
    raw = "Before the table.\nModel  Power\nX1 \n 184\nX2  258 kW\nAfter it all there is more text that is long enough to stay."
    texts = spark.createDataFrame([(1, raw), (2, "nothing here"), (3, None), (4, r"a\Eb  c+ 1")], "k int, t string")
    cells = [(1, 0, [["Model", "Power"], ["X1", "184"], ["X2", "258"]]), (2, 0, [["Model", "Power"], ["a", "b"]]), (3, 0, [["x", "y"]]), (4, 0, [[r"a\Eb", "c+"], ["c+", "1"]]), (1, 1, [[]]), (1, 2, None)]
    t = spark.createDataFrame(cells, "k int, table_no int, rows array<array<string>>")
    spans = {(r.k, raw[r.start_pos : r.end_pos] if r.k == 1 else (r.start_pos, r.end_pos)) for r in pages.table_spans(texts, t, "k", "t").collect()}
    assert spans == {(1, "Model  Power\nX1 \n 184\nX2  258 kW"), (4, (0, 6))}
    out = {(r.k, r.segment_no): r for r in pages.separated_segments(texts, t, "k", "t").collect()}
    assert out[1, 0].content.startswith("Before the table.\n\nAfter it all") and out[1, 1].row_count == 3 and (2, 0) not in out
    assert pages.separated_segments(texts.limit(0), t.limit(0), "k", "t").count() == 0


def test_hybrid_modes(spark):
    model = spark.createDataFrame([("d", 1, "good text", 0.9), ("d", 2, "weak", 0.2), ("d", 3, None, None)], "document_id string, page_number int, text string, confidence double")
    fallback = spark.createDataFrame([("d", 2, 1, "a longer text"), ("d", 2, 2, "short"), ("d", 4, 1, "only here"), ("e", 1, 1, "other")], "document_id string, page_number int, ord int, text string")
    run = lambda mode: {(r.document_id, r.page_number): (r.text, r.origin, r.needs_review) for r in pages.hybrid_pages(model, fallback, mode).collect()}
    assert run(0) == {("d", 1): ("good text", "model", False), ("d", 2): ("weak", "model", True), ("d", 3): (None, "model", True)}
    assert run(1) == {("d", 1): ("good text", "model", False), ("d", 2): ("a longer text", "fallback", True), ("d", 3): ("", "model", True), ("e", 1): ("other", "fallback", False)}
    assert set(run(2)) == {("d", 1), ("d", 2), ("d", 3), ("d", 4), ("e", 1)} and run(2)["d", 4][0] == "only here"
    with pytest.raises(ValueError):
        pages.hybrid_pages(model, fallback, 3)


def test_rows_before_over_buckets(spark):
    rng = random.Random(1)
    rows = [(k, p, n) for k in ("a", None) for n, p in enumerate(sorted(rng.sample(range(400), 60)))]
    df = spark.createDataFrame(rows, "k string, p int, n int")
    for r in running.before(df, ["k"], "p", [F.col("p")], F.col("n"), "x", 3, bucket=7).collect():
        assert r.x == [m for m in range(r.n - 3, r.n) if m >= 0]
    placed = segments.reindexed(df.select(F.col("k").alias("document_id"), F.col("p").alias("page"), F.col("n").alias("segment_index"), F.col("n").alias("o")), "page", [F.col("o")])
    assert all(r.segment_index == r.o for r in placed.collect())
    s = spark.createDataFrame([("d", 1, n, n) for n in range(6)] + [("d", None, 9, 9), (None, 1, 0, 10)], "document_id string, page_number int, segment_index int, segment_id int")
    assert {r.segment_id: r.relative_position for r in segments.relative_position(s).collect()} == {0: "top", 1: "top", 2: "middle", 3: "middle", 4: "middle", 5: "bottom", 9: "unknown", 10: "top"}


def test_completeness(spark):
    values = ["[1, 2]", "[]", "{}", '{"a": "x"}', '{"a": "x", "k9": "y"}', '{"a": [1]}', '{"a": ": ["}', '{"a": 3, "b": {"c": "d"}}', None, "no json", ""]
    assert column(spark, values, "string", visuals.completeness) == [0.5, 0.0, 0.0, 0.1, 0.2, 0.6, 0.1, 0.7, 0.0, 0.0, 0.0]


def test_boxes_charts_and_places(spark):
    assert column(spark, ["x <loc_1><loc_2><loc_30><loc_4>", "1>2>3>4>", "1>2>3", None], "string", visuals.boxes_of) == [[1, 2, 30, 4], [1, 2, 3, 4], None, None]
    charts = spark.createDataFrame([("T", "Bar", [("s", [str(k) for k in range(12)]), (None, None)]), (None, None, None), ("", "Pie", [])], "t string, k string, s array<struct<title:string,values:array<string>>>")
    got = [r.x for r in charts.select(visuals.chart_text(F.col("t"), F.col("k"), F.col("s")).alias("x")).collect()]
    assert got == ["Chart Title: T\nChart Type: Bar\nData Series:\n  s: 0, 1, 2, 3, 4, 5, 6, 7, 8, 9\n  Series 2: No data", "Chart Type: Unknown", "Chart Type: Pie"]
    s = spark.createDataFrame([(1, "d", 0), (2, "d", None), (3, None, 0)], "segment_id int, document_id string, p int")
    v = spark.createDataFrame([(8, "d", "paragraph_0", "b"), (7, "d", "paragraph_0", "a"), (6, "d", None, "c"), (5, None, "paragraph_0", "e"), (4, "d", "paragraph_0", None)], "visual_id int, document_id string, r string, content_hash string")
    assert [(r.segment_id, r.refs) for r in visuals.by_reference(s, F.concat(F.lit("paragraph_"), F.col("p").cast("string")), v, F.col("r")).collect()] == [(1, ["a", "b"])]


def ladder(text):
    """The rungs one after another, by Python."""

    def good(t):
        try:
            return isinstance(json.loads(t), (dict, list))
        except ValueError:
            return False

    c = text.strip(" \t\r\n\f")
    fence = re.search(r"```json\s*(.*?)```", c, re.S)
    tried = [c, fence.group(1).strip() if fence else ""]
    for p in (r"\{[^{}]*\}", r"(?s)\{.*?\}", r"(?s)\{.*\}"):
        tried += sorted(re.findall(p, c), key=len, reverse=True)
    tried.append(re.sub(r"```(?:json)?\s*", "", re.sub(r"^(Here's the JSON:|The JSON output is:|JSON:|Response:|Answer:)\s*", "", c)))
    return next((t for t in tried if t and good(t)), None)


def test_ladder_equals_its_rungs(spark):
    texts = ['{"a": 1}', 'Sure:\n```json\n{"a": {"b": 2}}\n```', 'x {"a": 1} y {"bb": 22} z', 'Answer: [1, 2]', "```\n[3]\n```", 'say {"a": {"b": 1}} now', "nothing", "", '{"a": ', "Response: 5", '{"a": 1} {"b"', '```json\nbroken\n``` {"c": 1}', '{"a": NaN}', '{"a":1}] {}', '{"a":1}} {}', '[1] [2]', '[1]]', '{"a":1},', '{"a":1},{"b":2}']
    assert column(spark, texts, "string", doctags.json_of) == [ladder(t) for t in texts]
    made = column(spark, ["plain words", "", None], "string", doctags.json_or_default)
    assert json.loads(made[0]) == {"description": "plain words", "confidence": 0.7, "element_type": "unknown_visual"} and made[1:] == [None, None]


def test_structured_responses(spark):
    texts = ['Here: {"model": "X"}', "Model: X5, new\nMotor: B58 with 250 kW and 500 Nm\nRow 1: a\nColumns: b, c", "just words", "", None, "{}"]
    got = column(spark, texts, "string", doctags.structured_response)
    assert (got[0].type, got[0].format, got[0].json) == ("structured", "json", '{"model": "X"}')
    assert got[1].fields == {"model": ["X5"], "motor": ["B58 with 250 kW and 500 Nm"], "power": ["250"], "torque": ["500"], "table_rows": ["a"], "columns": ["b, c"]}
    assert (got[2].type, got[2].format) == ("text", "plain") and got[3:5] == [None, None] and got[5].format == "plain"
    pages_ = column(spark, ['{"page_type": "title", "main_topic": "m", "key_information": ["a"]}', '{"x": 1}', "Inhalt", None], "string", doctags.page_context)
    assert [(p.page_type, p.main_topic, p.key_information) for p in pages_[:3]] == [("title", "m", ["a"]), ("content", None, []), ("table_of_contents", None, [])] and pages_[3] is None


def test_normalised_tags(spark):
    place = "<loc_1><loc_2><loc_3><loc_4>"
    df = spark.createDataFrame([(1, f"<para>{place}first</para><section_header>{place}second</section_header>")], "k int, doctags string")
    assert doctags.parse_pages(df.withColumn("doctags", doctags.normalise(F.col("doctags")))).collect()[0].text.startswith("first")
    assert doctags.parse_pages(df).collect()[0].text.startswith("first")


def test_extraction_in_batches(spark):
    def model(prompt):
        text = prompt.rpartition("Text:\n")[2]
        if text == "fail":
            raise RuntimeError("down")
        return json.dumps({"triples": [{"subject": text[:3], "predicate": "p", "object": "o"}] * 60}) if text != "none" else "no idea"

    df = spark.createDataFrame([(1, "abc " * 100), (2, "fail"), (3, "none"), (4, None)], "k int, t string")
    triples, texts = extraction.extract_triples(df, "k", "t", model, most=50, attempts=2, wait=0.0)
    rows = triples.collect()
    assert len(rows) == 50 and {len(r.source_chunk) for r in rows} == {200} and {r.confidence for r in rows} == {0.8}
    assert {r.k: (r.success, r.error, r.triple_count) for r in texts.collect()} == {1: (True, None, 50), 2: (False, "RuntimeError: down", 0), 3: (False, "the response holds no triples", 0), 4: (False, None, 0)}


def test_prompts(spark, tmp_path):
    (tmp_path / "t.txt").write_text("{a}-{b} {c}", encoding="utf-8")
    df = spark.createDataFrame([("{b}", None), ("x", "y")], "a string, b string")
    got = [r.p for r in df.select(prompts.from_template(prompts.load_template(str(tmp_path / "t.txt")), {"a": F.col("a"), "b": F.col("b")}).alias("p")).collect()]
    assert got == ["{b}- {c}", "x-y {c}"]
    made = [r.p for r in df.select(prompts.context_generation("T", F.col("b")).alias("p")).collect()]
    assert made[1].startswith("HAUPTAUFGABE: T\n\nZUSÄTZLICHE") and "\nTEXT:\ny\n\nAUSGABEFORMAT:" in made[1]
    focus, lines = prompts.adaptive(F.col("a"))
    assert spark.createDataFrame([("table",), ("map",), (None,)], "a string").select(focus.alias("f"), lines[0].alias("l")).collect()[0].f == "ocr"


def test_blocks_and_parts(spark):
    hub = [("hub", "p", f"o{n:05d}") for n in range(2500)] + [("s", "q", 'a "b" <c>'), ("s", "p", "x")]
    t = spark.createDataFrame(hub, "subject string, predicate string, object string")
    for write in (tables.turtle, tables.rdf_xml, tables.json_ld):
        blocks = {}
        for r in write(t).collect():
            blocks.setdefault(r.subject, []).append(r.block)
        assert len(blocks["s"]) == 1 and len(blocks["hub"]) >= 3
        assert len(set(re.findall(r"o\d{5}", "".join(blocks["hub"])))) == 2500
    objects = {}
    for r in tables.json_ld(t).collect():
        for p, v in json.loads(r.block).items():
            objects.setdefault((r.subject, p), []).extend(v if p != "@id" else [])
    assert objects["s", "q"] == ['a "b" <c>'] and len(objects["hub", "p"]) == 2500
    s = spark.createDataFrame([(n, "d", n, None, "text", "paragraph", f"c{n}") for n in range(2100)] + [(9000, "d", 5000, 1, "metadata", "sheet", "Costs")], "segment_id int, document_id string, segment_index int, page_number int, segment_type string, segment_subtype string, content string")
    v = spark.createDataFrame([(1, "d", "h", "chart", 3, "sales")], "visual_id int, document_id string, content_hash string, element_type string, page_number int, vlm_description string")
    parts = {(r.section, r.part_no): r.content for r in export.full_text(s, v).collect()}
    assert set(parts) == {("text", 0), ("text", 1), ("text", 2), ("text", 4), ("visuals", 0)} and parts["text", 4] == "## Costs" and parts["visuals", 0] == "[CHART]: sales (Page 3)"
    d = spark.createDataFrame([("d", "p", "pdf"), ("e", None, None)], "document_id string, source_path string, document_type string")
    rows = export.parsed_documents(d, s, v).collect()
    assert sum(len(json.loads(r.json)["segments"]) for r in rows if r.section == "segments") == 2101
    assert {json.loads(r.json)["document_id"]: json.loads(r.json)["summary"]["total_segments"] for r in rows if r.section == "metadata"} == {"d": 2101, "e": 0}


def test_reports_of_nothing(spark):
    runs = spark.createDataFrame([("m", None, None, None, None, 1)], "model_used string, success boolean, error_message string, processing_time_seconds double, created_at timestamp, analysis_id int")
    assert reports.client_statistics(runs, ["model_used"], "created_at", "analysis_id").collect()[0].average_ms == 0.0
    assert reports.client_statistics(runs.limit(0), ["model_used"], "created_at", "analysis_id").count() == 0
    assert reports.batch_statistics(runs, ["model_used"], 30.0).collect()[0].seconds_saved == 0.0
    assert reports.inference_summary(runs, ["model_used"], F.lit(3), F.col("processing_time_seconds")).collect()[0].average_throughput == 0.0
    assert reports.stage_statistics(runs.withColumn("confidence", F.lit(None).cast("double")).limit(0), ("x",)).collect()[0].total_elements == 0
    one = spark.createDataFrame([("h", 0.5, "a"), ("k", None, "b"), ("s", 0.9, "c")], "content_hash string, confidence double, description string")
    two = spark.createDataFrame([("h", 0.4, "x"), ("h", 0.8, "y"), ("k", 0.1, "z"), ("s", 1.0, "w")], "content_hash string, confidence double, description string")
    assert {r.content_hash: (r.confidence, r.description, r.was_retried) for r in reports.retried(one, two, "content_hash").collect()} == {"h": (0.8, "y", True), "k": (0.1, "z", True), "s": (0.9, "c", False)}


def test_settings_files(tmp_path):
    path = str(tmp_path / "a.json")
    config.save({"a": {"b": "${X:3}", "c": [1]}, "d": None}, path)
    assert config.load(path, {}) == {"a": {"b": 3, "c": [1]}, "d": None}
    config.save({"a": 1}, path)
    assert json.loads(open(path + ".bak", encoding="utf-8").read())["d"] is None and config.load(path) == {"a": 1}
    assert config.schema_of({"a": {"b": 1.5, "c": [1]}, "d": None, "e": True}) == {"a.b": "float", "a.c": "list", "d": "null", "e": "bool"}
    assert config.errors({"a": {"b": 1}, "c": "x"}, {"a.b": "float", "c": "int", "z": "str"}) == ["c is str, not int", "z is missing"]
    for text, name in (("[1]", "b.json"), ("x", "c.txt")):
        (tmp_path / name).write_text(text, encoding="utf-8")
        with pytest.raises(ValueError):
            config.load(str(tmp_path / name))


def test_checked_and_ordered_files(spark, tmp_path):
    for name in ("b.txt", "a.txt"):
        (tmp_path / name).write_text("# T\n\nSome longer text here.", encoding="utf-8")
    rows = {r.path: r.error for r in files.check_files(spark, [str(tmp_path / "a.txt"), str(tmp_path), str(tmp_path / "no.txt")]).collect()}
    assert rows == {str(tmp_path / "a.txt"): None, str(tmp_path): "not a file", str(tmp_path / "no.txt"): "no such file"}
    assert [r.title for r in files.in_order(files.scan(spark, str(tmp_path))).collect()] == ["a", "b"]


def test_content_type_of_lines_with_marks(spark):
    texts = ["a\tb\tc", "x\n | a | b | c", "a\tb", "| a | b", "Table 3: x", "plain\t\n\tplain\nlast"]
    assert column(spark, texts, "string", fx.content_type) == ["table", "table", "paragraph", "paragraph", "table", "paragraph"]
    s = spark.createDataFrame([("text", "paragraph", "h | i\n1 | 2\n3 | 4"), ("text", "list", "h | i\n1 | 2"), ("text", None, "words"), ("visual", "chart", "Table 1: x")], "segment_type string, segment_subtype string, content string")
    got = [(r.segment_type, r.segment_subtype, r.triple_count) for r in tables.with_structure(s).collect()]
    assert got == [("table", "data", 4), ("text", "list", 2), ("text", "paragraph", None), ("visual", "chart", None)]


def test_files_are_parsed_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for name, text in (("a.txt", "# A\n\nThe first text is long enough."), ("b.txt", "# A\n\nThe first text is long enough.")):
        (tmp_path / "in" / name).write_text(text, encoding="utf-8")
    scan = lambda: files.scan(spark, str(tmp_path / "in"))
    first = ingest.parse_once(spark, scan(), str(tmp_path / "cache"))
    assert first.count() == 4 and first.select("document_id").distinct().count() == 2
    (tmp_path / "in" / "c.txt").write_text("# C\n\nAnother text that is long enough.", encoding="utf-8")
    assert ingest.parse_once(spark, scan(), str(tmp_path / "cache")).count() == 6
    assert spark.read.parquet(str(tmp_path / "cache" / "hashes")).count() == 2
    seen = []
    ingest.ingest(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "check"), after=lambda rows, n: seen.append((n, rows.count())))
    assert sum(n for _, n in seen) == 3


def test_summaries_vectors_and_kinds(spark, tmp_path):
    made = spark.createDataFrame([("d", 0, "g", "section", 10, 1, 1, 2, "content"), ("d", 0, "g", "section", 5, 0, 2, 4, "table_data")], "document_id string, group_ordinal int, group_id string, group_type string, n_words int, n_visuals int, start_page int, end_page int, chunk_type string")
    r = chunking.group_summaries(made).collect()[0]
    assert (r.chunk_count, r.n_words, r.n_visuals, r.start_page, r.end_page, r.has_tables) == (2, 15, 1, 1, 4, True)
    old = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], "vec_id int, embedding array<float>")
    new = spark.createDataFrame([(2, [1.0, 0.0]), (3, [0.6, 0.8])], "vec_id int, embedding array<float>")
    assert [r.vec_id for r in Engine(spark, embeddings=old).add_vectors(new).search([1.0, 0.0], 5, 0.5).collect()] == [1, 2, 3]
    assert column(spark, ["Given", "", None], "string", lambda c: fx.document_kind(F.lit("user manual"), F.lit(None).cast("string"), c)) == ["Given", "Manual", "Manual"]
    export.write_report(spark.createDataFrame([(1, "a")], "n int, t string"), str(tmp_path / "r"))
    assert spark.read.json(str(tmp_path / "r")).collect()[0].t == "a"


def test_cells_left_empty(spark):
    rows = spark.createDataFrame([("d", 1, 1, 1, "a", "cell"), ("d", 1, 1, 3, "=b", "cell"), ("d", 1, 2, 2, "c", "cell"), ("d", 1, 3, 1, "", "cell")], "document_id string, part int, row_no int, col_no int, content string, kind string")
    lines = lambda **more: {r.row_no: r.content for r in ooxml._joined(rows, "document_id", "part", **more).collect()}
    assert lines() == {1: "a | [Formula: =b]", 2: "c"} and lines(skip_empty=False) == {1: "a |  | [Formula: =b]", 2: " | c | "}
