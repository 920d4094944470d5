import json

import pytest

from quirelake.common import table
from quirelake.operators import shredding

SCHEMA = "result_id int, payload string"


@pytest.fixture(scope="module")
def keys(spark):
    def found(payload, source="parse_results"):
        df = spark.createDataFrame([(1, payload)], SCHEMA)
        rows = shredding.found_members(shredding.shredded(df, source, "result_id"), source).collect()
        return {(r.child_kind, r.parent_key, r.child_key) for r in rows}

    return found


def test_shapes_of_collections(keys):
    ve = {"element_type": "chart", "confidence": 0.5}
    assert keys(json.dumps({"pages": [None, {}, {"text": "a", "visual_elements": [ve, None, ve]}]})) == {("page", "root", "2"), ("visual_element", "2", "0"), ("visual_element", "2", "2")}
    assert keys(json.dumps({"pages": {"p1": {"text": "a", "visualElements": {"v1": ve, "v2": None}}, "p2": None}})) == {("page", "root", "p1"), ("visual_element", "p1", "v1")}
    assert keys(json.dumps({"pages": {"text": "a", "page_number": 1, "visual_elements": ve}, "VisualElements": json.dumps([ve])})) == {("page", "root", "0"), ("visual_element", "0", "0"), ("visual_element", "root", "0")}


def test_envelopes_and_strings(keys):
    record = {"pages": json.dumps([{"text": "a"}])}
    for payload in (json.dumps([record]), json.dumps({"result": record}), json.dumps(json.dumps(record))):
        assert keys(payload) == {("page", "root", "0")}
    assert keys(json.dumps({"debug": {"vlmResults": {"m": {"confidence": 1, "extracted_data": {"vlm_results": {"x": {"y": 1}}}}}}}), "segment_debug") == {("vlm_result", "root", "m")}
    assert keys(json.dumps({"vlm_results": [], "smoldocling_raw": {"pages": [{"text": "a"}], "vlm_results": [{"m": 1}]}}), "segment_debug") == set()


def test_what_gives_nothing(keys):
    for payload in (None, "", "{broken", "3", '"text"', "[]", "null", '{"pages": 5}', '{"pages": null}'):
        assert keys(payload) == set()
    assert keys('{"pages": [{"confidence": NaN}]}') == {("page", "root", "0")}


def test_deep_nesting(keys):
    deep = '{"pages": [' + '{"a":' * 400 + "1" + "}" * 400 + "]}"
    assert len(shredding.shred_payload(deep, frozenset({"pages"}))) == 403
    deeper = '{"result":' * 30 + '{"pages": [' + '{"a":' * 200_000 + "[1, {}]" + "}" * 200_000 + "]}" + "}" * 30
    assert keys(deeper) == {("page", "root", "0")}
    text = '{"pages": [{"text": "a"}]}'
    for _ in range(12):
        text = json.dumps(text)
    assert keys(text) == {("page", "root", "0")}


def test_deep_reader_equals_json():
    for text in ('{"a": [1, -2.5e3, "x\\u00e9\\n", {}, [], null, true, NaN], "b": {"c": {}}}', "[]", "{}", '"x"', "3", "[[[]],[{}]]"):
        assert repr(shredding._deep_loads(text)) == repr(json.loads(text))
    for text in ("", "[", "[1,]", '{"a"}', '{"a":1,}', "[1]]", "[1 2]", '{1: 2}', "nul", '["a"', "[}", "{]"):
        with pytest.raises(ValueError):
            json.loads(text)
        with pytest.raises(ValueError):
            shredding._deep_loads(text)


def brute_force(payload, source):
    """The members of a payload by plain recursion over Python values."""

    def read(value):
        while isinstance(value, str):
            try:
                inner = json.loads(value)
            except ValueError:
                return value
            if not isinstance(inner, (dict, list, str)):
                return value
            value = inner
        return value

    def same(name):
        return "".join(c for c in name.lower() if c.isascii() and c.isalnum())

    def entries(value):
        value = read(value)
        if isinstance(value, list):
            return [(str(n), read(v)) for n, v in enumerate(value) if isinstance(read(v), dict) and read(v)]
        if not isinstance(value, dict) or not value:
            return []
        filled = {k: read(v) for k, v in value.items() if read(v) is not None}
        if all(isinstance(v, dict) for v in filled.values()):
            return [(k, v) for k, v in filled.items() if v]
        return [("0", value)]

    def roots(value):
        value = read(value)
        if isinstance(value, list):
            return [r for v in value for r in roots(v)]
        if not isinstance(value, dict):
            return []
        names = {"pages", "visualelements"} if source == "parse_results" else {"vlmresults"}
        inside = [v for k, v in value.items() if same(k) in shredding.ENVELOPES and isinstance(read(v), (dict, list))]
        return [value] if names & {same(k) for k in value} or not inside else [r for v in inside for r in roots(v)]

    out = []
    for root in roots(payload) if payload and isinstance(read(payload), (dict, list)) else []:
        for name, value in root.items():
            if source == "segment_debug" and same(name) == "vlmresults":
                out += [("vlm_result", "root", k) for k, _ in entries(value)]
            elif source == "parse_results" and same(name) == "visualelements":
                out += [("visual_element", "root", k) for k, _ in entries(value)]
            elif source == "parse_results" and same(name) == "pages":
                for key, page in entries(value):
                    out.append(("page", "root", key))
                    out += [("visual_element", key, k) for n, v in page.items() if same(n) == "visualelements" for k, _ in entries(v)]
    return out


@pytest.mark.parametrize(("source", "id_col"), [("parse_results", "result_id"), ("segment_debug", "debug_id")])
def test_members_equal_brute_force(spark, data, source, id_col):
    rows = table(spark, data, source)
    found = shredding.found_members(shredding.shredded(rows, source, id_col), source)
    got = sorted((r.row_id, r.child_kind, r.parent_key, r.child_key) for r in found.collect())
    want = sorted((r[id_col], *m) for r in rows.collect() for m in brute_force(r.payload, source))
    assert got == want and got


def test_tables(spark):
    rows = [(1, json.dumps({"pages": [{"page_number": "1", "text": "a"}, {"pageNumber": 2}]}), "x"), (1, None, "y"), (2, "no json", "z"), (3, "{}", "")]
    df = spark.createDataFrame(rows, "result_id int, payload string, node_id string")
    pages = {(r.child_key, r.page_number, r.text) for r in shredding.shredded(df, "parse_results", "result_id")["page"].collect()}
    assert pages == {("0", "1", "a"), ("1", "2", None)}
    assert shredding.shredded(df.union(df), "parse_results", "result_id")["page"].count() == 4
    assert shredding.found_members(shredding.shredded(df.limit(0), "parse_results", "result_id"), "parse_results").count() == 0
    # Every object below the root hangs on a node of its own record.
    nodes = shredding.adjacency(df, "parse_results", "result_id")
    ids = {(r.payload_id, r.node_id) for r in nodes.collect()}
    assert all((r.payload_id, r.parent_id) in ids for r in nodes.where("parent_id IS NOT NULL").collect())


def test_nodes_hold_every_scalar(spark, tmp_path):
    from quirelake.plans import catalog

    payload = {"status": "done", "result": {"pages": [{"text": "a", "tables": [["x", 7]], "layout_info": {"columns": 2}, "new_field": True}]}}
    spark.createDataFrame([(1, json.dumps(payload))], "result_id int, payload string").write.parquet(f"{tmp_path}/parse_results.parquet")
    spark.createDataFrame([(1, json.dumps({"vlm_results": [{"model": "m", "error": "late"}]}))], "debug_id int, payload string").write.parquet(f"{tmp_path}/segment_debug.parquet")
    rows = catalog.queries()["p3_nodes"](spark, str(tmp_path)).where("scalar IS NOT NULL").collect()
    assert sorted((r.source_table, r.label, r.scalar) for r in rows) == [
        ("parse_results", "0", "x"), ("parse_results", "1", "7"), ("parse_results", "columns", "2"), ("parse_results", "new_field", "true"), ("parse_results", "status", "done"), ("parse_results", "text", "a"),
        ("segment_debug", "error", "late"), ("segment_debug", "model", "m"),
    ]
