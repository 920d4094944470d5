import itertools
import sys
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from quirelake.common import table
from quirelake.llm import bigru, languages, queries, sentences, subjects


def test_gradients_equal_differences():
    rng = np.random.default_rng(0)
    h, c = 3, 4
    shapes = [(512, 3 * h), (h, 3 * h), (h,)] * 2 + [(2 * h, 2 * c), (2 * c,)]
    values = [rng.normal(0, 0.5, s).astype(np.float64) for s in shapes]
    x, mask = bigru.pack([b"hello", b"ab", b"xyz!"])
    y = np.array([0, 3, 1])
    _, grads = bigru._gradients(bigru.as_weights(values), x, mask, y)
    for k, value in enumerate(values):
        for at in [tuple(rng.integers(0, n) for n in value.shape) for _ in range(4)] + ([(104, 1)] if value.shape[0] == 512 else []):
            kept, step = value[at], 1e-3
            value[at] = kept + step
            up, _ = bigru._gradients(bigru.as_weights(values), x, mask, y)
            value[at] = kept - step
            down, _ = bigru._gradients(bigru.as_weights(values), x, mask, y)
            value[at] = kept
            assert abs((up - down) / (2 * step) - grads[k][at]) < 2e-3


def test_inference_equals_training_pass():
    w = bigru.train([b"aaaa bbbb", b"cccc dddd"] * 4, np.array([0, 1] * 4), 2, hidden=4, epochs=2)
    x, mask = bigru.pack([b"aaaa bb", b"c"])
    forward, backward = (bigru._run(w, side, x, mask[:, :, 0], False)[0] for side in (0, 1))
    logits = (np.concatenate([forward, backward], axis=2) @ w.out + w.out_bias).reshape(*mask.shape, 2)
    p = np.exp(logits) / np.exp(logits).sum(axis=3, keepdims=True)
    assert np.abs(bigru.position_probabilities(w, x, mask) - p)[mask > 0].max() < 1e-4
    assert np.allclose(bigru.pooled_probabilities(w, [b""]), 0.5)
    # A long sequence is read whole, and each of its positions counts once.
    long = b"aaaa bbbb cccc dddd " * 60
    x, mask = bigru.pack([long])
    whole = bigru.position_probabilities(w, x, mask)
    assert whole.shape == (len(long) // 2, 1, 2, 2) and np.abs(whole[:, :, 0] - whole[:, :, 1]).max() > 1e-3
    assert np.allclose(bigru.pooled_probabilities(w, [b"a", long, b"cc"], cells=100)[1], whole.mean(axis=(0, 1, 2)), atol=1e-5)


def test_running_sentences():
    text = "# Head\n\nThe pump (see page 3) runs. It costs 3.5 units, z. B. nach Plan!\n\n| a | b |\nNo. | V | W\n\n```\nx = 1.\n```\n- An item here.\n> A quote here?\nScope\n\nLeft open"
    assert sentences.running_sentences(text) == ["The pump (see page 3) runs.", "It costs 3.5 units, z. B. nach Plan!", "An item here.", "A quote here?"]
    assert sentences.running_sentences(None) == [] and sentences.running_sentences("Wrapped line that\ngoes on here.") == ["Wrapped line that goes on here."]


@pytest.fixture(scope="module")
def network(spark, data):
    return queries._network(spark, data)


def test_held_out_languages(spark, data, network):
    # Held-out sentences: rows of the corpus whose label agrees with the names of a language and that were not all in the sample.
    codes, weights = network
    rows = table(spark, data, "segments").where("lang IN ('de', 'en', 'es', 'fr', 'it', 'nl', 'pl', 'pt') AND segment_subtype = 'paragraph'").select("lang", "content").collect()
    pairs = [(r.lang, s) for r in rows for s in sentences.running_sentences(r.content)]
    p = bigru.pooled_probabilities(weights, [languages._key(s) for _, s in pairs])
    right = np.mean([codes[k] == lang for (lang, _), k in zip(pairs, p.argmax(axis=1))])
    assert right > 0.9  # the rest are mostly wrong labels and mixed texts


def test_language_rows(spark, network):
    codes, weights = network
    german = "Der Ablageordner wird am Montag noch einmal besprochen. Die Arbeitsgruppe bleibt 3 Tage lang gültig."
    english = "The archive folder will be discussed again on Monday. The working group is kept for 3 days."
    rows = [(1, german, "German"), (2, german, "en"), (3, f"{german} {english} {german}", "de,en"), (4, None, "de"), (5, "", None), (6, "## Overview", None), (7, english, "en_GB"), (8, english, "zxx"), (8, english, "zxx"), (9, "12 | 13", "x")]
    df = spark.createDataFrame([("t", *r) for r in rows], "source_table string, row_id bigint, body string, label string")
    found = sorted((r.row_id, r.part_no, r.lang) for r in languages.wrong_labels(df, codes, weights).collect())
    assert found == [(2, 0, "de"), (3, 0, "de"), (3, 1, "en"), (3, 2, "de"), (8, 0, "en"), (8, 0, "en")]
    every = {r.row_id: r for r in languages.label_languages(df, codes, weights).collect()}
    assert set(every) == set(range(1, 10)) and every[4].lang == "und" and every[4].confidence == 0 and every[6].n_sentences == 0
    assert languages.label_languages(df.limit(0), codes, weights).count() == 0


def test_fp_growth_equals_brute_force():
    rng = np.random.default_rng(2)
    words = list("abcdef")
    transactions = [([w for w in words if rng.random() < 0.5], [1.0, float(rng.random())]) for _ in range(60)]
    got = {tuple(sorted(p)): s for p, s in subjects.fp_growth(transactions, 5, 3)}
    want = {}
    for size in (2, 3):
        for p in itertools.combinations(words, size):
            rows = [s for items, s in transactions if set(p) <= set(items)]
            if len(rows) >= 5:
                want[p] = [sum(x) for x in zip(*rows)]
    assert got.keys() == want.keys() and all(np.allclose(got[p], want[p]) for p in want)
    halves = [set(), set()]
    for k, own in enumerate(({"a", "b", "c"}, {"d", "e", "f"})):
        halves[k] = {tuple(sorted(p)) for p, _ in subjects.fp_growth(transactions, 5, 3, own)}
    assert halves[0] | halves[1] == set(want) and not halves[0] & halves[1]


def test_held_out_subjects(spark, data):
    examples = table(spark, data, "subject_examples")
    taught, held = examples.where("example_id % 4 <> 0"), examples.where("example_id % 4 = 0")
    rules = subjects.mine_rules(taught, subjects.cut_sentences(table(spark, data, "documents")))
    found = {}
    for r in subjects.document_subjects(subjects.cut_sentences(held, "example_id"), rules, "example_id").collect():
        found.setdefault(r.example_id, set()).add(r.subject)
    truth = {r.example_id: r.subject for r in held.collect()}
    hit = sum(s in found.get(k, ()) for k, s in truth.items())
    wrong = sum(len(f - {truth[k]}) for k, f in found.items())
    assert hit > 0.6 * len(truth) and wrong < 0.35 * len(truth)


def test_subjects_of_nothing(spark, data):
    examples = table(spark, data, "subject_examples")
    documents = spark.createDataFrame([(1, None, "x"), (2, "", "y"), (3, "12 | 13", "z")], "doc_id bigint, text string, subject string")
    cut = subjects.cut_sentences(documents)
    rules = subjects.mine_rules(examples, cut)
    assert subjects.document_subjects(cut, rules).count() == 0
    assert subjects.mine_rules(examples.limit(0), cut).subjects == []


def test_rules_come_from_all_documents(spark):
    areas = ["anvil", "barge", "copse", "dynamo", "easel", "fjord"]
    examples = spark.createDataFrame([(a, f"The {a} stands in the hall. We saw the {a} there.") for a in areas], "subject string, text string")
    texts = [f"The {areas[k % 6]} stands in the hall. Today is a long day, number {k}." for k in range(12_000)]
    # Known by a word in 14 of 12,000 documents only.
    texts[:84:6] = [f"The anvil stands in the hall. The zephyrite came today, number {k}." for k in range(14)]
    rules = subjects.mine_rules(examples, subjects.cut_sentences(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")))
    assert rules.single["zephyrite"][0] == rules.subjects.index("anvil")


def test_little_taught_language_is_learned(spark):
    """A third of a subject's words in one language is known from others, so its documents have small shares; their company is learned and neutral words are not."""
    rng = np.random.default_rng(5)
    word = lambda kind, k, j: f"{kind}{chr(97 + k)}{chr(97 + j)}oru"
    said = lambda a, b: f"{a.capitalize()} {b} here."
    examples = [(f"s{k}", said(word("no", k, j), word("ve", k, (j + more) % 5))) for k in range(12) for j in range(5) for more in range(2)]
    strange = [*(word("no", 0, j) for j in range(4)), *(word("mu", 0, j) for j in range(8))]
    texts = []
    for n in range(505):
        k = n % 12
        own = [said(word("no", k, rng.integers(5)), word("ve", k, rng.integers(5))) if n < 480 else said(strange[rng.integers(12)], word("qu", 0, rng.integers(5))) for _ in range(10)]
        texts.append(" ".join([*own, said(word("ne", 9, rng.integers(3)), word("pe", 9, rng.integers(3)))]))
    cut = subjects.cut_sentences(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string"))
    rules = subjects.mine_rules(spark.createDataFrame(examples, "subject string, text string"), cut)
    learned = {*strange, *(word("qu", 0, j) for j in range(5))}
    assert {w for w, (k, _) in rules.single.items() if w in learned and rules.subjects[k] == "s0"} == learned
    assert not any(w[:2] in ("ne", "pe") for w in rules.single)


ODD_SENTENCES = ["The pump of the pump runs.", "", "12 / 14", 'He said "stop the pump" to us.', "L'eau, l’eau don't ΣΊΣΥΦΟΣ ΣΑΣ.", "İn x² ½ a_b c-d e\tf g　h.", "„So“ «ja» nein.", "The pump of the pump runs."]


def test_every_token_is_looked_at_once():
    assert subjects.words_joined(ODD_SENTENCES).to_pylist() == [" ".join(subjects.words_of(s)) for s in ODD_SENTENCES]
    assert subjects.words_joined([]).to_pylist() == []
    many = [f"The pump number {k % 7} runs in hall {k % 3} of the plant." for k in range(5000)]
    rules = subjects.Rules(["a", "b"], {"pump": (0, 1.0)}, {"plant": [(frozenset({"hall"}), 1, 1.0)]})
    calls = []
    sys.setprofile(lambda _, event, what: calls.append(what) if event == "call" else None)
    try:
        numbered = subjects.Numbered(pa.array([subjects.words_joined(many).to_pylist()] * 2, pa.list_(pa.string())))
        found, shares = rules.found(numbered), numbered.labelled({"pump": 0, "plant": 1}, 2)
    finally:
        sys.setprofile(None)
    assert len(calls) < len(many) / 2
    assert found.tolist() == [[True, True]] and shares.tolist() == [[2.0, 2.0, 2.0]]


def test_numbered_sentences_equal_brute_force():
    rng = np.random.default_rng(5)
    words = [f"w{k}" for k in range(12)]
    documents = [[" ".join(w for w in words if rng.random() < 0.3) for _ in range(rng.integers(0, 6))] for _ in range(60)] + [None, [], ["", "w1"], ["w1", "w1", "w2"]]
    numbered = subjects.Numbered(pa.array(documents, pa.list_(pa.string())))
    texts = {k: s for k, s in zip(numbered.sentence.tolist(), itertools.chain.from_iterable(d or [] for d in documents))}

    single = {"w1": 0, "w2": 1, "w3": 2, "w4": 0, "w5": 1}
    want: dict[str, np.ndarray] = {}
    for d in documents:
        hits = np.zeros(3)
        for s in d or []:
            votes = Counter(single[w] for w in s.split() if w in single)
            for k, v in votes.items():
                hits[k] += v >= 0.34 * max(votes.values())
        for s in set(d or []) if hits.any() else ():
            want[s] = want.get(s, 0) + np.array([1.0, *(hits / len(d))])
    got = numbered.labelled(single, 3)
    assert all(np.allclose(got[k], want.get(s, 0)) for k, s in texts.items())

    weights = {w: (int(rng.integers(3)), float(rng.normal())) for w in words[:5]}
    several = {w: [(frozenset(rng.choice(words[:k], min(k, int(rng.integers(1, 3))), replace=False).tolist()), int(rng.integers(3)), float(rng.normal())) for _ in range(4)] for k, w in enumerate(words) if k > 4}
    rules = subjects.Rules(["a", "b", "c"], weights, several, 0.3)
    found = rules.found(numbered)
    for k, s in texts.items():
        assert {j for j, e in rules.evidence(s.split()).items() if e >= rules.enough} == set(np.flatnonzero(found[k]).tolist())


def test_prefixes_of_groups(monkeypatch):
    monkeypatch.setattr(subjects, "GROUPS", 4)
    rng = np.random.default_rng(6)
    transactions = [sorted(rng.choice(20, rng.integers(1, 9), replace=False).tolist()) for _ in range(50)]
    prefixes, spots = subjects.conditional(np.array(list(itertools.chain(*transactions))), np.array([len(t) for t in transactions]))
    got = sorted((spot, np.frombuffer(p, np.int32).tolist()) for p, spot in zip(prefixes, spots.tolist()))
    assert got == sorted((k, max((t[: at + 1] for at in range(1, len(t)) if t[at] % 4 == g), key=len)) for k, t in enumerate(transactions) for g in {x % 4 for x in t[1:]})
    held = subjects._Held(2)
    held.add(prefixes, np.arange(2.0 * len(prefixes)).reshape(-1, 2))
    rows = subjects._by_group(held).to_pylist()
    out = {}
    for r in rows:
        items, sums = np.frombuffer(r["items"], np.int32).tolist(), np.frombuffer(r["sums"], np.float64).reshape(-1, 2)
        for size, s in zip(np.frombuffer(r["sizes"], np.int32).tolist(), sums.tolist()):
            head, items = items[:size], items[size:]
            assert head[-1] % 4 == r["grp"]
            out[np.array(head, np.int32).tobytes()] = s
        assert not items
    assert {k: held.sums[v].tolist() for k, v in held.numbers.items()} == out


def test_running_sentences_of_odd_ends():
    assert sentences.running_sentences("Siehe Nr. Eins und z. B. Zwei. Ab 3. Das Ende approx. Zwei Worte (so ist es.) Ja. Und nun!»") == ["Siehe Nr. Eins und z. B. Zwei.", "Ab 3. Das Ende approx. Zwei Worte (so ist es.)", "Und nun!»"]
