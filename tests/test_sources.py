import io
import zipfile

import pytest
from pyspark.sql import functions as F

from quirelake.facade import Engine
from quirelake.functions import images
from quirelake.sinks import export
from quirelake.sources import config, doctags, files, models
from quirelake.streaming import ingest

W = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
S = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
R = 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
P = 'xmlns:p="http://schemas.openxmlformats.org/presentationml/2006/main" xmlns:a="http://schemas.openxmlformats.org/drawingml/2006/main"'


def packed(**parts):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as archive:
        for name, text in parts.items():
            archive.writestr(name.replace("__", "/"), text)
    return out.getvalue()


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "deep").mkdir()
    (tmp_path / "deep" / "note.md").write_text("# A Note\n\nThis paragraph is long enough to be kept.\n")
    (tmp_path / ".hidden.txt").write_text("hidden")
    (tmp_path / "image.png").write_bytes(b"\x89PNG")
    para = lambda text, style="": f'<w:p>{f"<w:pPr><w:pStyle w:val={chr(34)}{style}{chr(34)}/></w:pPr>" if style else ""}<w:r><w:t>{text}</w:t></w:r></w:p>'
    cells = "".join(f"<w:tr>{''.join(f'<w:tc>{para(c)}</w:tc>' for c in row)}</w:tr>" for row in (("k", "v"), ("a", "1")))
    (tmp_path / "a.docx").write_bytes(packed(**{"word__document.xml": f"<w:document {W}><w:body>{para('Head', 'Heading2')}{para('')}{para('Text.')}<w:tbl>{cells}</w:tbl></w:body></w:document>"}))
    sheet = "".join(f'<row r="{r}">{"".join(f"<c r={chr(34)}{c}{r}{chr(34)} t={chr(34)}inlineStr{chr(34)}><is><t>{v}</t></is></c>" for c, v in row)}</row>' for r, row in ((1, (("A", "only"),)), (2, (("A", "x"), ("B", "y"))), (3, (("A", "1"), ("B", "2")))))
    formula = '<row r="4"><c r="A4"><f>SUM(A1:A3)</f></c></row>'
    (tmp_path / "b.xlsx").write_bytes(
        packed(**{"xl__workbook.xml": f'<workbook {S} {R}><sheets><sheet name="Data" sheetId="1" r:id="r1"/></sheets></workbook>', "xl__worksheets__sheet1.xml": f"<worksheet {S}><sheetData>{sheet}{formula}</sheetData></worksheet>"})
    )
    shape = lambda kind, text: f'<p:sp><p:nvSpPr><p:cNvPr id="1" name="n"/><p:nvPr>{f"<p:ph type={chr(34)}{kind}{chr(34)}/>" if kind else ""}</p:nvPr></p:nvSpPr><p:txBody><a:p><a:r><a:t>{text}</a:t></a:r></a:p></p:txBody></p:sp>'
    (tmp_path / "c.pptx").write_bytes(packed(**{"ppt__slides__slide1.xml": f"<p:sld {P}>{shape('', 'body text')}{shape('title', 'The title')}</p:sld>"}))
    (tmp_path / "broken.docx").write_bytes(b"no archive")
    return str(tmp_path)


def test_scan_and_parse(spark, folder):
    found = files.scan(spark, folder)
    assert sorted(r.title for r in found.select("title").collect()) == ["a", "b", "broken", "c", "note"]
    names = {r.document_id: r.title for r in found.select("document_id", "title").collect()}
    rows = files.parse(found).orderBy("document_id", "segment_index").collect()
    by = {}
    for r in rows:
        by.setdefault(names[r.document_id], []).append((r.segment_subtype, r.content))
    assert by["note"] == [("heading_1", "# A Note"), ("paragraph", "This paragraph is long enough to be kept.")]
    assert by["a"] == [("heading_2", "Head"), ("paragraph", " "), ("paragraph", "Text."), ("data", "k | v\na | 1")]
    assert by["b"] == [("sheet", "Sheet: Data"), ("data", "only"), ("header", "x | y"), ("data", "1 | 2"), ("data", "[Formula: =SUM(A1:A3)]")]
    assert by["c"] == [("slide", "TITLE: The title\nbody text")]
    assert "broken" not in by


def test_read_files_leaves_out_missing(spark, folder):
    assert files.read_files(spark, [f"{folder}/a.docx", f"{folder}/none.txt"]).count() == 1
    assert files.read_files(spark, [f"{folder}/none.txt"]).count() == 0


def test_ingest_takes_each_file_once(spark, folder, tmp_path):
    target, mark = str(tmp_path / "out"), str(tmp_path / "mark")
    ingest.ingest(spark, f"{folder}/deep", target, mark, "*.md")
    ingest.ingest(spark, f"{folder}/deep", target, mark, "*.md")
    assert spark.read.parquet(target).count() == 2


def test_unseen(spark, folder):
    found = files.scan(spark, folder, "*.docx")
    known = found.where("title = 'a'").select(F.sha2("content", 256).alias("content_hash"))
    assert [r.title for r in ingest.unseen(found, known).collect()] == ["broken"]


def test_doctags(spark):
    loc = "<loc_1><loc_2><loc_3><loc_4>"
    page = f"<text>{loc}Body</text><page_header>{loc}12</page_header><page_header>{loc}Chapter</page_header><formula>{loc}x=1</formula><picture>{loc}a photo</picture>"
    df = spark.createDataFrame([(1, page), (2, "<doctag><text>Sample parsed content</text></doctag>"), (3, None)], "k int, doctags string")
    rows = {r.k: r for r in doctags.parse_pages(df).collect()}
    assert rows[1].text == "Body\nChapter" and rows[1].formulas[0].latex == "x=1" and rows[1]["images"][0].bbox == [1, 2, 3, 4] and rows[1]["images"][0].caption == "a photo"
    assert rows[2].text == "Sample parsed content" and rows[3].text == ""
    lines = spark.createDataFrame([(1, "<text>a</text>\n<title>b</title>\n<table>\n" + "x\n" * 11), (2, "x\n" * 10)], "k int, doctags string")
    cut = {r.k: r for r in doctags.cut_repetitions(lines, "k").collect()}
    assert cut[1].cut == "<text>a</text>\n<title>b</title>\n<table>\n</table>\n<!-- output truncated at a repetition -->" and not cut[1].cut_failed
    assert cut[2].cut == "x\n" * 10


def test_model_tables_and_json(spark):
    text = "TableCell(text='a', start_row_offset_idx=0, start_col_offset_idx=0), TableCell(text='b (c)', start_row_offset_idx=1, start_col_offset_idx=1)"
    cells = doctags.table_cells(spark.createDataFrame([(1, text), (2, None), (3, "none")], "k int, t string"), "k", "t")
    assert doctags.markdown_table(cells, "k").collect()[0].markdown == "| a |  |\n| --- | --- |\n|  | b (c) |"
    answers = [('{"a": 1}',), ('x ```json\n{"b": {"c": 2}}\n``` y',), ('so {"d": 3} it is',), ("nothing",), (None,)]
    got = [r.j for r in spark.createDataFrame(answers, "r string").select(doctags.json_of(F.col("r")).alias("j")).collect()]
    assert got == ['{"a": 1}', '{"b": {"c": 2}}', '{"d": 3}', None, None]
    response = '{"triples":[{"subject":"John","predicate":"worksAt","object":"Corp","confidence":0.95},{"subject":"Corp","predicate":"in","object":"Town"}]}'
    triples = doctags.extraction_triples(spark.createDataFrame([(1, response), (2, "{broken")], "k int, r string"), "k", "r").collect()
    assert [(t.subject, t.confidence) for t in triples] == [("John", 0.95), ("Corp", 0.8)]


def png(pixels):
    import struct
    import zlib

    height, width = len(pixels), len(pixels[0])
    part = lambda kind, body: struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
    raw = b"".join(b"\0" + bytes(row) for row in pixels)
    return b"\x89PNG\r\n\x1a\n" + part(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 0, 0, 0, 0)) + part(b"IDAT", zlib.compress(raw)) + part(b"IEND", b"")


def test_images(spark):
    grid = [[255 * ((x % 8 == 0) ^ (y % 8 == 0)) for x in range(40)] for y in range(20)]
    flat = [[128] * 20 for _ in range(20)]
    rows = [(1, png(grid), None), (2, png(flat), None), (3, b"no image", None), (4, None, "A flowchart of the plant"), (5, png(flat), "the table below")]
    df = spark.createDataFrame(rows, "k int, data binary, context string")
    got = {r.k: r.t for r in df.select("k", images.element_type(F.col("data"), F.col("context")).alias("t")).collect()}
    assert got == {1: "diagram", 2: "image", 3: "image", 4: "diagram", 5: "table"}
    assert images.read_png(png(grid)).shape == (20, 40, 1)


def test_model_calls(spark):
    def model(prompt):
        if "bad" in prompt:
            raise ValueError("no answer")
        return prompt.upper()

    rows = models.call(spark.createDataFrame([(1, "ok"), (2, "bad"), (3, None)], "k int, p string"), model, "p", wait=0.0).collect()
    assert {(r.k, r.response, r.error) for r in rows} == {(1, "OK", None), (2, None, "ValueError: no answer"), (3, None, None)}


def test_config():
    settings = config.substitute({"a": "${X:5}", "b": ["${Y}", "v-${Z:q}"], "c": "${W:true}"}, {"Y": "1.5"})
    assert settings == {"a": 5, "b": [1.5, "v-q"], "c": True}
    assert config.get(settings, "b") == [1.5, "v-q"] and config.get(settings, "x.y", 7) == 7
    assert config.put({"a": {"b": 1}}, "a.c", 2) == {"a": {"b": 1, "c": 2}}


def test_engine_and_export(spark, tmp_path, folder):
    t = spark.createDataFrame([("a", "p", 'say "x"')], "subject string, predicate string, object string")
    engine = Engine(spark).add(t).add(t)
    assert engine.statistics().collect()[0].n_triples == 1
    for kind in export.FORMATS:
        engine.export(str(tmp_path / kind), kind)
    assert spark.read.text(str(tmp_path / "ntriples")).collect()[0].value == '<a> <p> "say \\"x\\"" .'
    with pytest.raises(ValueError):
        engine.export(str(tmp_path / "none"), "owl")
    assert engine.chunk(engine.parse(folder, "*.md"), 100, 1).collect()[0].is_valid


def test_json_ladder_over_payloads_as_they_stand(spark, tmp_path):
    import json
    import re

    from quirelake.plans import catalog

    texts = ['{"a": 1}', "[1, 2]", 'Result:\n```json\n{"a": {"b": 2}}\n```\nend', 'Answer: {"a": {"b": [3]}} and so on', "JSON: [4, 5]", 'see {"x": 1} or {"long": 22}', "no JSON", "{broken", "", "7", None]
    spark.createDataFrame(list(enumerate(texts)), "result_id int, payload string").write.parquet(f"{tmp_path}/parse_results.parquet")

    def brute(text):
        """The steps in their order: itself, the fenced block, each pattern's matches from the longest on, what stands after a prefix."""
        tried = [text, *re.findall(r"(?s)```json\s*(.*?)```", text)]
        for pattern in (r"\{[^{}]*\}", r"(?s)\{.*?\}", r"(?s)\{.*\}"):
            tried += sorted(re.findall(pattern, text), key=len, reverse=True)
        for part in [*tried, text.removeprefix("JSON:")]:
            try:
                if isinstance(value := json.loads(part), (dict, list)):
                    return value
            except ValueError:
                pass
        return None

    found = {r.result_id: r.json and json.loads(r.json) for r in catalog.queries()["json_ladder_all"](spark, str(tmp_path)).collect()}
    assert found == {k: brute(t) for k, t in enumerate(texts) if t is not None}
