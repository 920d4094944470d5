import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quirelake.common import table
from quirelake.llm import mixture, tokens

PIECES = ["a", "b", " ", "\n", "é", "漢", "'s", "12", "  ", "　", "!", "word ", "\x1c", "😀", "\r\n"]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=120), st.integers(1, 25))
def test_joined_leaves_equal_the_whole(parts, size):
    enc, text = tokens.encoder(), "".join(parts)
    leaves = [enc.encode_ordinary(text[k : k + size]) for k in range(0, len(text), size)]
    assert tokens.join_tree(leaves, enc) == enc.encode_ordinary(text)


def test_encode_corpus(spark):
    enc = tokens.encoder()
    long = "".join(random.Random(1).choice(PIECES) for _ in range(5000))
    rows = [(1, "Hello there", "x"), (2, None, "y"), (3, "", "z"), (4, long, "x"), (4, long, "x"), (4, "other", "x"), (None, "null id", None), (5, "a" * 3000, "")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, ids string")
    got = sorted((r.doc_id is None, r.doc_id or 0, list(r["ids"])) for r in tokens.encode_corpus(df, leaf_chars=256).collect())
    want = sorted((i is None, i or 0, enc.encode_ordinary(t) if t else []) for i, t, _ in rows)
    assert got == want
    assert tokens.encode_corpus(df.limit(0)).count() == 0


def test_flight_keeps_sums_and_odds():
    rng = np.random.default_rng(3)
    p, sizes = rng.uniform(0.05, 0.95, 40), rng.integers(0, 50, 40).astype(float)
    drawn = np.zeros(40)
    for seed in range(400):
        q = mixture.flight(p, sizes, np.random.default_rng(seed))
        assert ((0 < q) & (q < 1)).sum() <= 2
        assert abs(q.sum() - p.sum()) < 1e-6 and abs((q * sizes).sum() - (p * sizes).sum()) < 1e-5
        drawn += q
    assert np.abs(drawn / 400 - p).max() < 0.12


@pytest.mark.parametrize("block", [4096, 50])
def test_mixture_meets_its_shares(spark, data, block):
    documents, targets = table(spark, data, "documents"), table(spark, data, "mix_targets")
    mixed, report = mixture.mix_sources(documents, targets, block=block)
    rows = {r.source: r for r in report.collect()}
    assert len(rows) == targets.count()
    caps = {r.source: r.max_repeats for r in targets.collect()}
    for r in mixed.collect():
        assert 1 <= r.repeats <= caps[r.source]
    for r in rows.values():
        # A source meets its wanted tokens, or gives all it may; with few documents it can miss by the size of one.
        most = caps[r.source] * r.source_tokens
        assert r.used_tokens <= most
        assert r.used_tokens == most or abs(r.used_tokens - r.wanted_tokens) <= max(0.05 * r.wanted_tokens, 700)
    assert abs(sum(r.actual_share for r in rows.values()) - 1) < 1e-9


def test_mixture_of_nothing(spark, data):
    documents, targets = table(spark, data, "documents"), table(spark, data, "mix_targets")
    mixed, report = mixture.mix_sources(documents.limit(0), targets)
    assert mixed.count() == 0 and report.where("used_tokens > 0").count() == 0
    one = documents.where("text IS NOT NULL").limit(1).withColumn("source", F.lit(" PRESS-kit "))
    mixed, _ = mixture.mix_sources(one.withColumn("tokens", F.lit("clash")), targets)
    assert {r.source for r in mixed.collect()} <= {"press_kit"}
