import random

import pytest

from quirelake.common import table
from quirelake.llm import queries, residue, scan_noise, truncation


def frame(spark, texts):
    return spark.createDataFrame([("visuals", n, t, "m") for n, t in enumerate(texts)], "source_table string, row_id bigint, body string, model_used string")


def test_residue(spark):
    dirty = ["Click to add text", "Visible here is {{page_title}}.", "Error 500: something went wrong on our side", "404 Not Found", "<noscript>Please enable JS to view this page.</noscript>", "asdf asdf asdf", "Lorem ipsum dolor sit tolis varo", "DIESE ANWENDUNG BENÖTIGT JAVASCRIPT.", "Reason: %error%", "A chart. Source: {{summary_text."]
    clean = [None, "", "  ", "File not found: Aruvel_130.pdf", "HTTP 503 from inference server, attempt 3, page 12 skipped", "Der Ausdruck f(x) = {x | x > 8} steht unter der Kurve.", "invalid <loc_12> tag in table 3", 'The screenshot shows a browser window with the notice "403 Forbidden" in the middle; the toolbar is visible above.', "The dialog lists the option JavaScript next to 17 other check boxes.", "Formula: \\frac{a_{3}}{b} equals \\sqrt{x}."]
    rows = frame(spark, dirty + clean)
    found = {r.row_id for r in residue.residue_records(rows.union(rows)).collect()}
    assert found == set(range(len(dirty)))
    assert residue.without_residue(rows).count() == len(clean)
    assert residue.residue_records(rows.limit(0)).count() == 0


def test_truncation(spark):
    sentences = ["The pump carries the reference of the new series.", "The motor runs in the large hall every day.", "The report lists the open points of the week.", "A valve closes when the pressure drops below the limit."]
    whole = [f"{a} {b}" for a in sentences for b in sentences]
    cut = ["The motor runs in the large hall every day. The pump carries the refe", "A valve closes when the pressure drops below the limit. The report lists the open …", "The report lists the open points of the week. A valve closes when the"]
    captions = ["Bar chart, 7 series", "Bar chart, 9 series", "Bar chart, 11 series", "Bar chart, 3 series", "Bar chart, 8 series"] * 2
    texts = whole * 3 + captions + [None, "", " "] + cut
    rows = frame(spark, texts)
    found = {r.row_id for r in truncation.truncated_records(rows).collect()}
    assert found == set(range(len(texts) - 3, len(texts)))
    rates = truncation.truncation_rates(rows).collect()
    assert len(rates) == 1 and rates[0].n_truncated == 3 and rates[0].n_texts == len(texts) - 3
    assert truncation.truncated_records(rows.limit(0)).count() == 0


def test_page_numbers_and_headers():
    assert [scan_noise.number_of(s) for s in ("— 12 —", "Page 3 of 20", "p. l2", "[7]", "xiv", "S. 5")] == [12, 3, 12, 7, 14, 5]
    assert [scan_noise.number_of(s) for s in ("page 34.", "The page", "12/24 is", "mild", "M8-23")] == [None] * 5
    assert scan_noise.header_key("Technischer Bericht 96/22 | 99") == scan_noise.header_key("Tcchnischer Bericht 96/22 | 100")
    assert scan_noise.header_keys("The pump runs well.") is None


def test_scan_noise(spark):
    clean = spark.createDataFrame([("The electronic controller regulates the temperature of the left-hand chamber. The inflammation of both sides and the percent value. " * 30,), (None,)], "body string")
    page = "Annual Review 7\n\nThe electronic contr-\noller regulates the tempe¬\nrature of the left-\nhand chamber, and the inflammat!on of two-\nand three parts.\n\n- {n} -"
    rows = [("page_extractions", n, page.replace("{n}", str(n)), "d1", n) for n in range(1, 5)]
    rows += [("page_extractions", 9, None, "d1", 9), ("segments", 1, "The percent va-\n12\nAnnual Review 7\nlue of the c0ntroller.", "d1", None), ("segments", 2, "", None, None)]
    scanned = spark.createDataFrame(rows, "source_table string, row_id bigint, body string, document_id string, page_number int")
    found = {(r.source_table, r.row_id, r.noise, r["item"]) for r in scan_noise.found_noise(scanned.union(scanned), clean).collect()}
    for n in range(1, 5):
        assert {(k, i) for t, r, k, i in found if (t, r) == ("page_extractions", n)} == {
            ("running_header", "Annual Review 7"), ("page_number", f"- {n} -"), ("hyphenation", "controller"), ("hyphenation", "temperature"), ("hyphenation", "left-hand"), ("misread", "inflammation"),
        }
    assert {(k, i) for t, r, k, i in found if t == "segments"} == {("running_header", "Annual Review 7"), ("page_number", "12"), ("hyphenation", "value"), ("misread", "controller")}
    text = [r.content for r in scan_noise.repaired_paragraphs(scanned.where("row_id = 1 AND source_table = 'page_extractions'"), clean).collect()]
    assert any(t.startswith("The electronic controller regulates the temperature of the left-hand chamber, and the inflammation") for t in text)
    assert scan_noise.found_noise(scanned.limit(0), clean).count() == 0


def test_decoder_reads_the_stream():
    d = scan_noise.Decoder({"points": 500, "controller": 300, "the": 900})

    def read(text):
        shown, lines = zip(*((t, n) for n, line in enumerate(text.split("\n")) for t in line.split()))
        return [(s.first, s.last, s.word) for s in d.decode(list(shown), list(lines))]

    assert read("the cont roller") == [(0, 0, None), (1, 2, "controller")]
    assert read("contr-\no11er points") == [(0, 1, "controller"), (2, 2, None)]
    assert read("contr-\nol ler the") == [(0, 2, "controller"), (3, 3, None)]
    d.settled = {"thepoints\u0002\u0004": "the points"}
    assert read("thepoints the") == [(0, 0, "the points"), (1, 1, None)]


def test_stream_is_repaired_through_the_queries(spark):
    clean = spark.createDataFrame([("The points of the controller are in the list. The valve is shut. " * 30,)], "body string")
    texts = ["See thepoints of the list.", "The cont roller is shut.", "The contr- oller and the contr-\noller are shut.", "The c0nt roller, the contr-\no11er.", "THE P0INTS: (C0ntroller)!"]
    rows = [("segments", n, t, "d1", 1) for n, t in enumerate(texts)]
    scanned = spark.createDataFrame(rows, "source_table string, row_id bigint, body string, document_id string, page_number int")
    text = {r.row_id: r.content for r in scan_noise.repaired_paragraphs(scanned, clean).collect()}
    assert text[0] == "See the points of the list."
    assert text[1] == "The controller is shut."
    assert text[2].endswith("and the controller are shut.")
    assert text[3].endswith("the controller.")
    assert text[4] == "THE POINTS: (Controller)!"
    found = {(r.row_id, r.noise, r["item"]) for r in scan_noise.found_noise(scanned, clean).collect()}
    assert {(2, "hyphenation", "controller"), (3, "hyphenation", "controller"), (3, "misread", "controller"), (4, "misread", "points"), (4, "misread", "controller")} <= found
    assert not [f for f in found if f[0] in (0, 1)]


def test_paragraph_of_many_lines():
    lines = ["and so the long line of words goes on to the very end"] * 200
    assert scan_noise.paragraphs(lines) == [list(range(200))]
    blocks = [*lines[:90], "", *lines[:70]]
    assert [len(p) for p in scan_noise.paragraphs(blocks)] in ([90, 70], [160])
    rng = random.Random(3)
    for _ in range(40):
        some = [rng.choice(["", "A short one.", "and so the long line of words goes on", "Then it ends here, at last."]) for _ in range(rng.randint(1, 9))]
        assert [k for p in scan_noise.paragraphs(some) for k in p] == [k for k, line in enumerate(some) if line]


def test_queries_run(spark, data):
    named = queries.queries()
    for name in ("p2_found", "p4_found", "p4_rates", "p5_found", "p6_found", "p6_kept", "p7_ids", "p8_shares"):
        assert named[name](spark, data).count() > 0, name
    assert table(spark, data, "documents").count() == named["p7_ids"](spark, data).count()


def test_residue_that_many_texts_hold(spark):
    # One error page with another request in each copy makes up most of the different texts.
    family = [f"Error 500: something went wrong on our side. Request {chr(97 + k // 26)}{chr(97 + k % 26)}qx on host{chr(97 + k % 26)}" for k in range(300)]
    kept = [f"The chart shows the sales of area {chr(97 + k // 26)}{chr(97 + k % 26)}m in the third quarter." for k in range(200)]
    found = {r.row_id for r in residue.residue_records(frame(spark, family + kept)).collect()}
    assert found == set(range(len(family)))


def test_broken_words_are_merged():
    d = scan_noise.Decoder({"the": 900, "controller": 300, "runs": 200, "well": 200})
    for broken in ("The contr oller runs well.", "The cont roller runs well."):
        assert scan_noise.scan(broken, frozenset(), None, True, d)[2] == ["The controller runs well."]
    assert scan_noise.scan("The contr-\noller oller runs well.", frozenset(), None, True, d)[2] == ["The controller oller runs well."]
    assert scan_noise.scan("The blonk runs well.", frozenset(), None, True, d)[2] == ["The blonk runs well."]


def test_paragraphs_use_the_whole_lexicon(spark, monkeypatch):
    monkeypatch.setattr(scan_noise, "HELD_WORDS", 4)
    clean = spark.createDataFrame([("The valve is shut. " * 60 + "A flywheel turns the self-acting pump. " * 3,)], "body string")
    rows = [("segments", 1, "The f1ywheel is shut. The self-\nacting valve.", "d1", 1)]
    scanned = spark.createDataFrame(rows, "source_table string, row_id bigint, body string, document_id string, page_number int")
    text = " ".join(r.content for r in scan_noise.repaired_paragraphs(scanned, clean).collect())
    assert "flywheel" in text and "self-acting" in text


# None of these strings is an exemplar, nor holds one as it stands.
PLANTED = (
    "Please go to your settings and turn on JavaScript, else report {x} stays hidden.",
    "Sorry, the page {x} has moved or does not exist.",
    "Bitte im Browser JavaScript wieder einschalten, um Teil {x} zu lesen.",
    "Type some text about {x} here",
    "Insert a new caption for {x}",
    "Our site is down for planned maintenance, {x}.",
    "The address {x} you gave is not known on this server.",
    "Service at {x} answered: 503 Service Unavailable",
)


@pytest.mark.parametrize("share", [0.01, 0.1, 0.2, 0.5])
def test_residue_is_found_however_common(spark, share):
    def name(k):
        return "".join(chr(97 + (k // 26**i) % 26) for i in (2, 1, 0)) + "or"

    total = 800
    planted = [PLANTED[k % len(PLANTED)].format(x=name(k)) for k in range(int(total * share))]
    kept = [f"The chart shows the sales of area {name(k)} in the third quarter; the page has no title." for k in range(total - len(planted))]
    found = {r.row_id for r in residue.residue_records(frame(spark, planted + kept)).collect()}
    assert len([k for k in found if k < len(planted)]) >= 0.9 * len(planted)
    assert not [k for k in found if k >= len(planted)]


def test_filler_words_are_learned(spark):
    words = "mirata solven quastor pelid norvat tuscan brevio calend".split()
    rng = random.Random(4)
    mixed = [" ".join(rng.choice(words + ["lorem", "ipsum", "dolor", "amet"]) for _ in range(14)) for _ in range(60)]
    unseeded = [" ".join(rng.sample(words, 6)) for _ in range(5)]
    kept = [f"The pump of hall {chr(97 + k)} runs with little noise and needs no care" for k in range(26)]
    found = {r.row_id for r in residue.residue_records(frame(spark, mixed + unseeded + kept)).collect()}
    assert found == set(range(len(mixed) + len(unseeded)))


def test_truncation_of_long_and_common_tokens(spark):
    long = "x" * 90
    whole = [f"The {long}end of the valve is shut. The {long}end of the valve is open."] * 30 + ["The valve of the pump is shut. The valve of the pump is open."] * 30
    cut = [f"The valve of the pump is open. The {long}", "The valve of the pump is shut. The valve of the pu"]
    found = {r.row_id for r in truncation.truncated_records(frame(spark, whole + cut)).collect()}
    assert found == {60, 61}


def test_words_that_are_not_held_count_alike(spark, monkeypatch):
    # "bem" is a rare known word, though it may be "hem" misread; "filterpump" is divided in three.
    clean = spark.createDataFrame([("The controller runs well. " * 40 + "The hem is new. " * 40 + "A bem is rare. The marl lies. The fi-lter-pump filterpump.",)], "body string")
    texts = ["The bem is new.", "The filt-\ner-\npump runs.", "The c0ntroller and the mar1.", "Acmel " * 45]
    scanned = spark.createDataFrame([("segments", n, t, "d1", 1) for n, t in enumerate(texts)], "source_table string, row_id bigint, body string, document_id string, page_number int")

    def found():
        noise = {(r.row_id, r.noise, r["item"]) for r in scan_noise.found_noise(scanned, clean).collect()}
        return noise, {(r.row_id, r.paragraph_no, r.content) for r in scan_noise.repaired_paragraphs(scanned, clean).collect()}

    whole = found()
    assert (0, "misread", "hem") not in whole[0] and (1, "hyphenation", "filterpump") in whole[0]
    for held in (0, 4):
        monkeypatch.setattr(scan_noise, "HELD_WORDS", held)
        assert found() == whole
