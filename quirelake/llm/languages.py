"""The language of every document and of every stretch of a mixed one, with a confidence.

A bidirectional gated recurrent network over bytes labels every position of
every running sentence; a sentence pools the probabilities of its positions,
and a document those of its sentences. Runs of consecutive sentences in one
language come from the best path through the sentence probabilities, where a
change of language costs something, so that only sentences that are clearly
foreign break a run.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirelake.llm.bigru import Weights, gate_tables, pooled_probabilities, train
from quirelake.llm.sampling import draw
from quirelake.llm.sentences import running_sentences

# The names by which labels call a language, besides its ISO 639-1 code.
NAMES = {
    "de": "deu ger german deutsch",
    "en": "eng english",
    "es": "spa spanish español espanol castellano",
    "fr": "fra fre french français francais",
    "it": "ita italian italiano",
    "nl": "nld dut dutch nederlands vlaams",
    "pl": "pol polish polski",
    "pt": "por portuguese português portugues",
}

#: Bounds of the sample the network is fitted on: different clean texts, different labelled documents, and of the latter sentences of each language and of each document.
SAMPLE_CLEAN, SAMPLE_DOCUMENTS, SAMPLE_SENTENCES, SAMPLE_PER_DOCUMENT = 4000, 4000, 500, 4
#: Probability with which a sentence is in another language than the one before.
SWITCH = 0.02
#: Sentences that a Python worker remembers.
MEMORY = 100_000
_DIGITS = re.compile(r"\d")
#: The network fitted last, by the digest of what it was fitted on.
_FITTED: dict[bytes, Weights] = {}
_LETTERS = re.compile(r"[^\W\d_]+")


def label_language(label: Column) -> Column:
    """The ISO 639-1 code a label names in any known spelling, region or script aside; null if it names none or several."""
    plain = F.regexp_replace(F.lower(F.trim(label)), "_", "-")
    known = {name: code for code, names in NAMES.items() for name in [code, *names.split()]}
    table = F.create_map(*(F.lit(x) for pair in known.items() for x in pair))
    return F.coalesce(F.try_element_at(table, plain), F.try_element_at(table, F.regexp_extract(plain, r"^([a-z]{2,3})-[a-z0-9-]+$", 1)))


def _key(sentence: str) -> bytes:
    """What the network reads: lower case, digits made equal."""
    return _DIGITS.sub("0", sentence.lower()).encode("utf-8", "replace")


def fit(samples: DataFrame, documents: DataFrame | None = None, text_col: str = "text", label_col: str = "lang") -> tuple[list[str], Weights]:
    """Languages and the network that tells them apart.

    ``samples`` has clean ``lang`` and ``text``, of which at most
    ``SAMPLE_CLEAN`` are read. ``documents`` adds a bounded sample of rows
    labelled with a plain code; their labels are partly wrong, so the network of a first round keeps only the sentences it agrees
    with, and goes on with them.
    """
    clean = draw(samples.where("lang IS NOT NULL"), "text", SAMPLE_CLEAN, ["lang"]).toPandas().sort_values(["spot", "lang"], kind="stable")
    codes = sorted(set(clean.lang))
    rows = [(s, lang, True) for lang, text in zip(clean.lang, clean.text, strict=True) for s in running_sentences(text) or [text]]
    if documents is not None:
        coded = documents.where(F.col(label_col).isin(codes)).select(F.col(label_col).alias("lang"), F.col(text_col).alias("text"))
        labelled = draw(coded, "text", SAMPLE_DOCUMENTS, ["lang"]).toPandas().sort_values(["spot", "lang"], kind="stable")
        counts = dict.fromkeys(codes, 0)
        for lang, text in zip(labelled.lang, labelled.text, strict=True):
            for s in running_sentences(text)[:SAMPLE_PER_DOCUMENT]:
                if counts[lang] < SAMPLE_SENTENCES:
                    counts[lang] += 1
                    rows.append((s, lang, False))
    if not rows:
        rows = [(" ", "und", True)]
        codes = ["und"]
    sequences = [_key(s) for s, _, _ in rows]
    # One driver that runs several queries on the same sample fits once.
    mark = hashlib.sha256(repr((codes, rows)).encode()).digest()
    if mark in _FITTED:
        return codes, _FITTED[mark]
    labels, sure = np.array([codes.index(lang) for _, lang, _ in rows]), np.array([c for _, _, c in rows])
    weights = train(sequences, labels, len(codes), epochs=6)
    keep = sure | (pooled_probabilities(weights, sequences).argmax(axis=1) == labels)
    kept = [s for s, k in zip(sequences, keep, strict=True) if k]
    _FITTED.clear()
    _FITTED[mark] = train(kept, labels[keep], len(codes), epochs=8, rate=0.01, start=weights)
    return codes, _FITTED[mark]


def best_path(p: np.ndarray) -> list[int]:
    """The most probable class of each sentence when a change of class has the odds ``SWITCH``."""
    score = np.log(p + 1e-6)
    stay, change = np.log(1 - SWITCH), np.log(SWITCH)
    best, back = score[0], []
    for row in score[1:]:
        top = int(best.argmax())
        moved = best[top] + change
        kept = best + stay
        back.append(np.where(kept >= moved, np.arange(len(row)), top))
        best = np.maximum(kept, moved) + row
    path = [int(best.argmax())]
    for step in reversed(back):
        path.append(int(step[path[-1]]))
    return path[::-1]


def label_languages(records: DataFrame, codes: list[str], weights: Weights) -> DataFrame:
    """``(source_table, row_id, part_no, lang, confidence, n_sentences, n_parts)`` of records with ``source_table``, ``row_id``, ``body``.

    One row for each run of consecutive running sentences in one language. A
    record without running sentences but with letters gets one row by all its
    words, with ``n_sentences`` 0; without letters, null or empty, language
    ``und`` with confidence 0. Repeated records give their rows each time.
    """
    kind = records.schema["row_id"].dataType.simpleString()

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, tuple[int, float, np.ndarray]] = {}
        tables = gate_tables(weights)
        for batch in batches:
            texts = batch.column("body").to_pylist()
            keys = []
            for text in texts:
                found = running_sentences(text)
                if found:
                    keys.append([_key(s) for s in found])
                else:
                    words = " ".join(_LETTERS.findall(text)) if text else ""
                    keys.append(_key(words) if len(words) > 2 else None)
            fresh = list({k for row in keys if row is not None for k in (row if isinstance(row, list) else [row])} - known.keys())
            if len(known) + len(fresh) > MEMORY:
                known = {}
                fresh = list({k for row in keys if row is not None for k in (row if isinstance(row, list) else [row])})
            if fresh:
                p = pooled_probabilities(weights, fresh, tables=tables).astype(np.float32)
                known.update(zip(fresh, zip(p.argmax(axis=1).tolist(), p.max(axis=1).tolist(), p, strict=True), strict=True))
            out: list[tuple] = []
            for n, row in enumerate(keys):
                if row is None:
                    out.append((n, 0, "und", 0.0, 0, 1))
                elif not isinstance(row, list):
                    top, sure, _ = known[row]
                    out.append((n, 0, codes[top], sure, 0, 1))
                else:
                    hits = [known[k] for k in row]
                    first = hits[0][0]
                    if all(h[0] == first for h in hits):
                        out.append((n, 0, codes[first], sum(h[1] for h in hits) / len(hits), len(hits), 1))
                        continue
                    p = np.stack([h[2] for h in hits])
                    runs = [(lang, [m for m, _ in run]) for lang, run in groupby(enumerate(best_path(p)), key=lambda x: x[1])]
                    out += [(n, part, codes[lang], float(p[at, lang].mean()), len(at), len(runs)) for part, (lang, at) in enumerate(runs)]
            spots, *columns = zip(*out, strict=True) if out else ([], [], [], [], [], [])
            at = pa.array(spots, pa.int64())
            types = (pa.int32(), pa.string(), pa.float64(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("source_table").take(at), batch.column("row_id").take(at), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))],
                names=["source_table", "row_id", "part_no", "lang", "confidence", "n_sentences", "n_parts"],
            )

    rows = records.select("source_table", "row_id", "body")
    return rows.mapInArrow(label, f"source_table string, row_id {kind}, part_no int, lang string, confidence double, n_sentences int, n_parts int")


def wrong_labels(records: DataFrame, codes: list[str], weights: Weights) -> DataFrame:
    """``(source_table, row_id, part_no, lang)`` of records whose ``label`` names no language or another than their sentences', or that are mixed.

    Records without running sentences are none.
    """
    # The label travels inside the table name, so that no join brings it back.
    tagged = records.withColumn("source_table", F.concat_ws("\u0001", "source_table", F.coalesce(label_language(F.col("label")), F.lit("-"))))
    parts = F.split("source_table", "\u0001")
    labelled = label_languages(tagged, codes, weights).where("n_sentences > 0")
    return labelled.where((F.col("n_parts") > 1) | (parts[1] != F.col("lang"))).select(parts[0].alias("source_table"), "row_id", "part_no", "lang")
