"""Subject areas of every document by class-association rules.

Rules say that a sentence with certain words deals with a subject. First rules
come from labelled examples. They label the documents, and what is found there
labels them again, until no more words keep company with the known ones; in all sentences
frequent word sets are mined with parallel frequent-pattern growth, each with
the subjects of the documents it stands in. A rule is
dropped as redundant if a part of its words concludes as surely. A sentence adds
up the evidence of the rules it matches, calibrated on the examples, and a
document has the subjects that enough of its sentences deal with.
"""

from __future__ import annotations

import itertools
import math
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, replace
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirelake.common import durable
from quirelake.llm.sampling import draw
from quirelake.llm.sentences import running_sentences

#: Least number of sentences with a word, least mean share of its subject in their documents, and least ratio of that to the subject's usual share, in the first round.
SUPPORT, CONFIDENCE, LIFT = 10, 0.35, 3.5
#: Least mean share in the second round, when documents are labelled by what the first one found; and least support and mean share of a set of words.
CONFIDENCE_AGAIN, SUPPORT_SET, CONFIDENCE_SET = 0.45, 25, 0.55
#: What words must have to be taken on trial, where the rest of their subject is too little known for such a share: this part of their sentences' labels of one subject, and this ratio of its share in the rest of their documents to the usual one there.
PURE, LIFT_REST = 0.9, 2.3
#: Sentences up to which the least numbers hold as they are; of more sentences they are the same part.
SUPPORT_OF = 75_000
#: The share of the second subject may be at most this part of the first one's, each relative to the usual.
RIVAL = 0.6
#: Confidence of a rule that only the examples teach.
SEED = 0.8
#: Most words in a rule, and the number of groups that conditional transactions are spread over.
MAX_WORDS, GROUPS = 3, 256
#: Most labelled examples that are read.
SAMPLE_EXAMPLES = 20_000
#: Part of the running sentences that must deal with a subject.
SHARE = 0.25
#: Words or transactions that a task sums up before it passes the sums on.
HELD = 100_000

_WORD = re.compile(r"[^\W\d_]{2,}(?:['’][^\W\d_]+)?")
_QUOTED = re.compile(r"[\"„“«][^\"“”»„«]{1,80}[\"“”»]")


def words_of(sentence: str) -> list[str]:
    """The different words of a sentence in lower case, without what stands in quotation marks."""
    if '"' in sentence or "„" in sentence or "“" in sentence or "«" in sentence:
        sentence = _QUOTED.sub(" ", sentence)
    words: list[str] = []
    # No word holds white space, and most tokens are words as they stand.
    for token in sentence.lower().split():
        if not token.isalpha():
            words += _WORD.findall(token)
        elif len(token) > 1:
            words.append(token)
    return list(dict.fromkeys(words))


def words_joined(sentences: list[str]) -> pa.StringArray:
    """The different words of each sentence as ``words_of`` finds them, joined by blanks; every different token is looked at once."""
    lowered = [(_QUOTED.sub(" ", s) if '"' in s or "„" in s or "“" in s or "«" in s else s).lower() for s in sentences]
    split = pc.split_pattern(pa.array(lowered, pa.string()), " ")
    tokens = split.flatten().dictionary_encode()
    numbers: dict[str, int] = defaultdict(itertools.count().__next__)
    # No word holds a blank, so the words of a sentence are those of its tokens.
    found = [[token] if len(token) > 1 and token.isalpha() else _WORD.findall(token) for token in tokens.dictionary.to_pylist()]
    numbered = np.array([numbers[w] for words in found for w in words], np.int64)
    sizes = np.array([len(words) for words in found], np.int64)
    token = tokens.indices.to_numpy()
    of = np.repeat(np.arange(len(sentences)), split.value_lengths().to_numpy())
    spots, at = _spread((np.cumsum(sizes) - sizes)[token], sizes[token])
    words, of = numbered[spots], of[at]
    keys = of * max(1, len(numbers)) + words
    ordered = np.sort(keys)
    repeating = np.zeros(len(sentences), bool)
    repeating[ordered[1:][ordered[1:] == ordered[:-1]] // max(1, len(numbers))] = True
    new = ~repeating[of]
    new[~new] = ~pd.Series(keys[~new]).duplicated().to_numpy()
    lists = _lists(np.bincount(of[new], minlength=len(sentences)), pa.array(list(numbers), pa.string()).take(pa.array(words[new])))
    return pc.binary_join(lists, " ")


def _spread(starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of runs that are ``sizes`` long from ``starts``, one run after another, and the number of the run of each."""
    run = np.repeat(np.arange(len(sizes)), sizes)
    return np.arange(len(run)) + (starts - (np.cumsum(sizes) - sizes))[run], run


def _lists(sizes: np.ndarray, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), values)


class Numbered:
    """The sentences of some documents as numbers, every different one once with its words."""

    def __init__(self, sentences: pa.ListArray):
        self.lengths = sentences.value_lengths().fill_null(0).to_numpy()
        coded = sentences.flatten().dictionary_encode()
        self.sentence, self.n = coded.indices.to_numpy().astype(np.int64), len(coded.dictionary)
        self.document = np.repeat(np.arange(len(sentences)), self.lengths)
        split = pc.split_pattern(coded.dictionary, " ")
        words = split.flatten().dictionary_encode()
        self.vocabulary: list[str] = words.dictionary.to_pylist()
        self.word, self.of = words.indices.to_numpy().astype(np.int64), np.repeat(np.arange(self.n), split.value_lengths().to_numpy())
        if "" in self.vocabulary:  # what splitting an empty sentence gives
            kept = self.word != self.vocabulary.index("")
            self.word, self.of = self.word[kept], self.of[kept]

    def mapped(self, numbers: dict[str, int]) -> np.ndarray:
        """The number of each word of the vocabulary, -1 for those without."""
        return np.array([numbers.get(w, -1) for w in self.vocabulary], np.int64)

    def said(self, by_sentence: np.ndarray) -> np.ndarray:
        """For each document the sum of its sentences' rows; one that it repeats counts each time."""
        return np.stack([np.bincount(self.document, weights=c[self.sentence], minlength=len(self.lengths)) for c in by_sentence.T.astype(float)], axis=1)

    def labelled(self, single: dict[str, int], n: int, own: bool = False) -> np.ndarray:
        """For each different sentence the number of labelled documents it stands in, and the sums of their subjects' shares of all their sentences.

        ``single`` says the subject of a word. A sentence that a document repeats
        is judged once and counts each time for the shares. With ``own`` also, for
        each subject the sentence has itself, the number of those documents, and
        what it adds itself to the shares.
        """
        label = self.mapped(single)[self.word]
        known = label >= 0
        votes = np.bincount(self.of[known] * n + label[known], minlength=self.n * n).reshape(self.n, n)
        dealt = (votes > 0) & (votes >= 0.34 * votes.max(axis=1, keepdims=True))
        hits = self.said(dealt)
        rows = np.concatenate([hits.any(axis=1, keepdims=True), hits / np.maximum(self.lengths, 1)[:, None]], axis=1)
        there = rows[self.document, 0] > 0
        document, sentence = np.divmod(np.unique(self.document[there] * max(1, self.n) + self.sentence[there]), max(1, self.n))
        sums = np.stack([np.bincount(sentence, weights=c[document], minlength=self.n) for c in rows.T], axis=1)
        if not own:
            return sums
        times = np.bincount(sentence, weights=1 / self.lengths[document], minlength=self.n)
        return np.concatenate([sums, dealt * sums[:, :1], dealt * times[:, None]], axis=1)


@dataclass(frozen=True)
class Rules:
    """Rules by their words, and the calibration of their evidence."""

    subjects: list[str]
    single: dict[str, tuple[int, float]]  # word: subject, weight
    several: dict[str, list[tuple[frozenset[str], int, float]]]  # first word: rest of the words, subject, weight
    enough: float = 1.0  # evidence at which the calibrated probability reaches a half

    def evidence(self, words: list[str]) -> dict[int, float]:
        """The summed weight of the matching rules of each subject."""
        out: dict[int, float] = {}
        for subject, weight in filter(None, map(self.single.get, words)):
            out[subject] = out.get(subject, 0.0) + weight
        sets = list(filter(None, map(self.several.get, words)))
        if sets:
            there = set(words)
            for more in sets:
                for rest, subject, weight in more:
                    if rest <= there:
                        out[subject] = out.get(subject, 0.0) + weight
        return out

    def found(self, numbered: Numbered) -> np.ndarray:
        """For each different sentence whether it deals with each subject: its calibrated probability is at least a half.

        The weights are added in the order of ``evidence``.
        """
        n, at = len(self.subjects), {w: k for k, w in enumerate(numbered.vocabulary)}
        subject = numbered.mapped({w: k for w, (k, _) in self.single.items()})[numbered.word]
        weight = np.array([self.single.get(w, (0, 0.0))[1] for w in numbered.vocabulary])[numbered.word]
        known = subject >= 0
        needed = set(self.several).union(*(rest for more in self.several.values() for rest, _, _ in more))
        order = np.flatnonzero(numbered.mapped(dict.fromkeys(needed, 0))[numbered.word] == 0)
        order = order[np.argsort(numbered.word[order], kind="stable")]
        ends = np.cumsum(np.bincount(numbered.word[order], minlength=len(at)))
        places = [np.zeros(0, np.int64)]
        added: list[tuple[int, float]] = []
        for head, more in self.several.items():
            if head not in at:
                continue
            spots = order[ends[at[head] - 1] if at[head] else 0 : ends[at[head]]]
            for rest, k, w in more:
                matching = spots
                for other in rest:
                    if other not in at:
                        matching = matching[:0]
                        break
                    # Its sentences are in order, since places are; the last one stands for those behind it.
                    there = numbered.of[order[ends[at[other] - 1] if at[other] else 0 : ends[at[other]]]]
                    wanted = numbered.of[matching]
                    matching = matching[there[np.minimum(np.searchsorted(there, wanted), len(there) - 1)] == wanted] if len(there) else matching[:0]
                places.append(matching)
                added.append((k, w))
        sizes = [len(p) for p in places[1:]]
        place = np.concatenate(places)
        by_place = np.argsort(place, kind="stable")
        place = place[by_place]
        keys = np.concatenate([numbered.of[known] * n + subject[known], numbered.of[place] * n + np.repeat(np.array([k for k, _ in added], np.int64), sizes)[by_place]])
        weights = np.concatenate([weight[known], np.repeat(np.array([w for _, w in added]), sizes)[by_place]])
        return np.bincount(keys, weights=weights, minlength=numbered.n * n).reshape(numbered.n, n) >= self.enough


def seed_rules(examples: list[tuple[int, list[str]]], n: int) -> dict[str, tuple[int, float]]:
    """Words that at least two example sentences have, nearly all of one subject."""
    counts: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(n))
    for subject, words in examples:
        for w in words:
            counts[w][subject] += 1
    return {w: (int(c.argmax()), 1.0) for w, c in counts.items() if c.sum() >= 2 and c.max() >= 0.9 * c.sum()}


def fp_growth(transactions: Iterable[tuple[list, list[float]]], min_support: float, max_words: int, last: set | None = None) -> Iterator[tuple[tuple, list[float]]]:
    """Frequent word sets of two to ``max_words`` words with the sums of the transactions' vectors, whose first entry is the count.

    The words of a transaction must be sorted. With ``last`` only sets whose
    last word is in it come out.
    """
    listed = [(items, sums) for items, sums in transactions if items]
    words = sorted({w for items, _ in listed for w in items})
    number = {w: k for k, w in enumerate(words)}
    flat = np.array([number[w] for items, _ in listed for w in items], np.int64)
    sums = np.array([s for _, s in listed], np.float64)
    own = None if last is None else {number[w] for w in last if w in number}
    for numbers, total in grow_patterns(flat, np.array([len(items) for items, _ in listed], np.int64), sums, min_support, max_words, own):
        yield tuple(words[k] for k in numbers), total


def grow_patterns(flat: np.ndarray, sizes: np.ndarray, sums: np.ndarray, min_support: float, max_words: int, last: set[int] | None, suffix: tuple[int, ...] = ()) -> Iterator[tuple[tuple[int, ...], list[float]]]:
    """Pattern growth over transactions laid out one after another in ``flat``, ``sizes`` long, each with its row of ``sums``.

    The conditional pattern base of an item is the part before it of every
    transaction that has it. All its items are counted at once; the base, without
    the infrequent ones, is grown further.
    """
    if not len(flat):
        return
    starts = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(sizes)), sizes)
    columns = np.ascontiguousarray(sums.T)
    spots = np.arange(len(flat)) if last is None else np.flatnonzero(np.isin(flat, list(last)))
    order = spots[np.argsort(flat[spots], kind="stable")]
    items, first = np.unique(flat[order], return_index=True)
    ends = [*first[1:].tolist(), len(order)]
    for item, begin, end in zip(items.tolist(), first.tolist(), ends, strict=True):
        spots = order[begin:end]
        rows = owner[spots]
        lengths = spots - starts[rows]
        total = int(lengths.sum())
        if not total:
            continue
        paths = flat[np.arange(total) + np.repeat(starts[rows] - (np.cumsum(lengths) - lengths), lengths)]
        of = np.repeat(rows, lengths)
        counts = np.bincount(paths, weights=columns[0][of])
        frequent = np.flatnonzero(counts >= min_support)
        if not len(frequent):
            continue
        kept = counts[paths] >= min_support
        paths, of, at = paths[kept], of[kept], np.repeat(np.arange(len(rows)), lengths)[kept]
        places = np.searchsorted(frequent, paths)
        added = np.stack([np.bincount(places, weights=c[of], minlength=len(frequent)) for c in columns], axis=1)
        pattern = (item, *suffix)
        for w, total_sums in zip(frequent.tolist(), added.tolist(), strict=True):
            yield (w, *pattern), total_sums
        if len(frequent) > 1 and len(pattern) + 1 < max_words:
            lengths = np.bincount(at, minlength=len(rows))
            yield from grow_patterns(paths, lengths, sums[rows], min_support, max_words, None, pattern)


class _Held:
    """Sums of rows by key."""

    def __init__(self, width: int):
        self.numbers: dict[str | bytes, int] = defaultdict(itertools.count().__next__)
        self.sums = np.zeros((0, width))

    def add(self, keys: list, rows: np.ndarray) -> None:
        into = np.fromiter(map(self.numbers.__getitem__, keys), np.int64, len(keys))
        added = np.stack([np.bincount(into, weights=c, minlength=len(self.numbers)) for c in rows.T], axis=1)
        added[: len(self.sums)] += self.sums
        self.sums = added


def _transactions(held: _Held) -> pa.RecordBatch:
    items = pa.array(np.frombuffer(b"".join(held.numbers), np.int32))
    sizes = np.array([len(k) // 4 for k in held.numbers])
    return pa.RecordBatch.from_arrays([_lists(sizes, items), *(pa.array(c) for c in np.ascontiguousarray(held.sums.T))], names=["words", *(f"s{k}" for k in range(held.sums.shape[1]))])


def conditional(flat: np.ndarray, sizes: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """Of transactions laid out in ``flat``, for each group the longest prefix, of two items at least, that ends in one of its items; and the number of its transaction."""
    ends = np.cumsum(sizes)
    starts, of = ends - sizes, np.repeat(np.arange(len(sizes)), sizes)
    # Of the places of a transaction in one group the last one stays.
    last = np.full(len(sizes) * GROUPS, -1)
    last[of * GROUPS + flat % GROUPS] = np.arange(len(flat))
    at = last[last >= 0]
    at = at[at > starts[of[at]]]
    packed = flat.astype(np.int32).tobytes()
    return [packed[a:b] for a, b in zip((4 * starts[of[at]]).tolist(), (4 * at + 4).tolist(), strict=True)], of[at]


def _bytes(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The bytes of ``values`` cut at ``ends``."""
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(np.concatenate([[0], ends]).astype(np.int32)), pa.py_buffer(values.tobytes())])


def _by_group(held: _Held) -> pa.RecordBatch:
    """A row for each group with the items, sizes and sums of its transactions as bytes; the last item of a transaction says the group."""
    sizes = np.array([len(k) // 4 for k in held.numbers], np.int32)
    items = np.frombuffer(b"".join(held.numbers), np.int32)
    groups = items[np.cumsum(sizes) - 1] % GROUPS
    order = np.argsort(groups, kind="stable")
    there, counts = np.unique(groups, return_counts=True)
    spots, _ = _spread((np.cumsum(sizes) - sizes)[order], sizes[order])
    ends = np.cumsum(counts)
    return pa.RecordBatch.from_arrays([pa.array(there), _bytes(items[spots], 4 * np.cumsum(sizes[order])[ends - 1]), _bytes(sizes[order], 4 * ends), _bytes(held.sums[order], held.sums.itemsize * held.sums.shape[1] * ends)], names=["grp", "items", "sizes", "sums"])


def _conclusion(sums: list[float], base: np.ndarray, support: float = SUPPORT, confidence: float = CONFIDENCE) -> tuple[int, float] | None:
    """The subject a word set concludes and its mean share, if support, confidence and lift allow one."""
    n, shares = sums[0], np.array(sums[1:]) / max(sums[0], 1)
    lift = shares / np.maximum(base, 1e-6)
    top = int(lift.argmax())
    second = float(np.sort(lift)[-2]) if len(lift) > 1 else 0.0
    if n < support or shares[top] < confidence or lift[top] < LIFT or second > RIVAL * lift[top]:
        return None
    return top, float(shares[top])


def _companion(sums: np.ndarray, overall: np.ndarray, support: float) -> int | None:
    """The subject that a word is taken for on trial, by sums as of ``Numbered.labelled`` with ``own``: its labelled sentences are nearly all of it, and so is, more than usual, the rest of its documents."""
    _, shares, own, added = np.split(sums, [1, 1 + len(sums) // 3, 1 + 2 * (len(sums) // 3)])
    _, all_shares, _, all_added = np.split(overall, [1, 1 + len(sums) // 3, 1 + 2 * (len(sums) // 3)])
    lift = np.maximum(shares - added, 0) / max(sums[0], 1) / np.maximum((all_shares - all_added) / overall[0], 1e-6)
    top = int(lift.argmax())
    second = float(np.sort(lift)[-2]) if len(lift) > 1 else 0.0
    return top if own[top] >= support and own[top] >= PURE * own.sum() and lift[top] >= LIFT_REST and second <= RIVAL * lift[top] else None


def _weight(confidence: float, base: float) -> float:
    c, b = min(max(confidence, 0.02), 0.98), min(max(base, 0.02), 0.98)
    return math.log(c / (1 - c)) - math.log(b / (1 - b))


def _calibrate(rules: Rules, examples: list[tuple[int, list[str]]]) -> float:
    """The evidence from which on an example sentence is rather of the subject than not.

    The probability as a rising step function of the evidence comes from
    pooling adjacent violators over all pairs of example sentence and subject.
    """
    pairs = [(found.get(k, 0.0), float(k == subject)) for subject, found in ((s, rules.evidence(w)) for s, w in examples) for k in range(len(rules.subjects))]
    blocks: list[list[float]] = []  # least evidence, positives, size
    for x, group in groupby(sorted(pairs), key=lambda p: p[0]):
        ys = [y for _, y in group]
        blocks.append([x, sum(ys), len(ys)])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            x_, y_, n_ = blocks.pop()
            blocks[-1][1] += y_
            blocks[-1][2] += n_
    return next((x for x, y, n in blocks if y >= 0.5 * n and x > 0), 1.0)


def cut_sentences(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(row_key, sentences)``: the words of every running sentence of a document, joined by blanks, written once to the shared folder.

    Mining and scoring both read them. Null and empty texts have no sentences.
    """
    kind = documents.schema[id_col].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            listed = [running_sentences(text) for text in batch.column("body").to_pylist()]
            joined = words_joined(list(itertools.chain.from_iterable(listed)))
            yield pa.RecordBatch.from_arrays([batch.column("row_key"), _lists(np.array([len(x) for x in listed]), joined)], names=["row_key", "sentences"])

    rows = documents.select(F.col(id_col).alias("row_key"), F.col(text_col).alias("body"))
    return durable(rows.mapInArrow(cut, f"row_key {kind}, sentences array<string>"))


def mine_rules(examples: DataFrame, cut: DataFrame) -> Rules:
    """The rules for all subjects of ``examples`` (``subject``, ``text``; at most ``SAMPLE_EXAMPLES`` different ones are read), mined from them and all documents as ``cut``.

    Rows with null subject or text teach nothing. Without documents, or where
    those have no known words, the rules are those of the examples.
    """
    known = draw(examples.where("subject IS NOT NULL"), "text", SAMPLE_EXAMPLES, ["subject"]).toPandas().sort_values(["spot", "subject"], kind="stable")
    subjects = sorted(set(known.subject))
    n = len(subjects)
    taught = [(subjects.index(s), words_of(x)) for s, t in zip(known.subject, known.text, strict=True) for x in running_sentences(t) or [t]]
    seeds = seed_rules(taught, n)
    first = Rules(subjects, {w: (k, _weight(0.9, 1 / max(1, n))) for w, (k, _) in seeds.items()}, {})
    if not n:
        return first

    def counter(single: dict[str, int], columns: list[str]):
        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """The number of sentences with each word and the sums of their documents' shares; for all sentences together the word is empty."""
            held = _Held(len(columns))
            for batch in batches:
                numbered = Numbered(batch.column("sentences"))
                sums = numbered.labelled(single, n, len(columns) > n + 1)
                some = np.flatnonzero(np.bincount(numbered.word[sums[numbered.of, 0] > 0], minlength=len(numbered.vocabulary)))
                if not len(some):
                    continue
                by_word = np.stack([np.bincount(numbered.word, weights=c[numbered.of], minlength=len(numbered.vocabulary)) for c in sums.T], axis=1)
                worded = np.bincount(numbered.of, minlength=numbered.n) > 0
                held.add(["", *(numbered.vocabulary[k] for k in some.tolist())], np.concatenate([sums[worded].sum(axis=0)[None], by_word[some]]))
                if len(held.numbers) > HELD:
                    yield summed(held)
                    held = _Held(len(columns))
            if held.numbers:
                yield summed(held)

        def summed(held: _Held) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(held.numbers), pa.string()), *(pa.array(c) for c in np.ascontiguousarray(held.sums.T))], names=["word", *columns])

        return count

    names = [f"s{k}" for k in range(n + 1)]
    sums_schema = ", ".join(f"{c} double" for c in names)
    totals = [F.sum(c).alias(c) for c in names]
    concluded = {w: k for w, (k, _) in seeds.items()}
    single: dict[str, tuple[int, float]] = {}
    sure: dict[frozenset[str], float] = {}
    trial: dict[str, int] = {}
    tried: set[str] = set()
    for confidence in itertools.chain([CONFIDENCE], itertools.repeat(CONFIDENCE_AGAIN)):
        labels = concluded | trial
        columns = names if confidence == CONFIDENCE else [f"s{k}" for k in range(3 * n + 1)]
        counts = durable(cut.select("sentences").mapInArrow(counter(labels, columns), f"word string, {', '.join(f'{c} double' for c in columns)}").groupBy("word").agg(*(F.sum(c).alias(c) for c in columns)))
        overall = counts.where("word = ''").toPandas()
        if overall.empty or not overall["s0"].iloc[0]:
            return replace(first, enough=_calibrate(first, taught))
        overall = overall.drop(columns="word").iloc[0].to_numpy(float)
        usual = np.maximum(overall[1 : n + 1] / overall[0], 0.5 / (n + 1) / n)
        scale = max(1.0, overall[0] / SUPPORT_OF)
        support, support_set = SUPPORT * scale, SUPPORT_SET * scale
        # Words of at least some part of all sentences: a table of bounded size.
        counted = counts.where((F.col("word") != "") & (F.col("s0") >= support)).toPandas()
        single, sure = {}, {}
        for row in counted.itertuples(index=False):
            if (found := _conclusion(list(row[1 : n + 2]), usual, support, confidence)) is not None:
                single[row[0]] = (found[0], _weight(found[1], usual[found[0]]))
                sure[frozenset([row[0]])] = found[1]
        # Of words too rare to judge, the examples decide alone.
        judged = set(counted.word)
        single |= {w: (k, _weight(SEED, usual[k])) for w, (k, _) in seeds.items() if w not in judged}
        concluded = {w: k for w, (k, _) in single.items()}
        if confidence == CONFIDENCE:
            continue
        # Where the examples know little of a subject in a language, its documents have small shares. What keeps company with its known words is tried once, and stays if its shares are then large enough.
        asked = counted[~counted.word.isin([*single, *tried])]
        found_out = ((row[0], _companion(np.array(row[1:], float), overall, support)) for row in asked.itertuples(index=False))
        trial = {w: k for w, k in found_out if k is not None}
        tried |= trial.keys()
        if not trial:
            break
    # Sets with a word that concludes by itself would be redundant, and those with a word rarer than a set must be cannot be frequent: such words are not mined further.
    open_ = counted[~counted.word.isin(list(single)) & (counted.s0 >= support_set)].sort_values(["s0", "word"], ascending=[False, True])
    ranked = open_.word.tolist()
    rank = {w: k for k, w in enumerate(ranked)}

    def transact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The ranked words of every labelled sentence with its document's shares; equal ones are summed up before they leave the task."""
        held = _Held(n + 1)
        for batch in batches:
            numbered = Numbered(batch.column("sentences"))
            sums = numbered.labelled(labels, n)
            ranks = numbered.mapped(rank)[numbered.word]
            kept = (ranks >= 0) & (sums[numbered.of, 0] > 0)
            of, items = np.divmod(np.sort(numbered.of[kept] * max(1, len(rank)) + ranks[kept]), max(1, len(rank)))
            sizes = np.bincount(of, minlength=numbered.n)
            packed, ends = items.astype(np.int32).tobytes(), 4 * np.cumsum(sizes)
            several = sizes > 1
            held.add([packed[a:b] for a, b in zip((ends - 4 * sizes)[several].tolist(), ends[several].tolist(), strict=True)], sums[several])
            if len(held.numbers) > HELD:
                yield _transactions(held)
                held = _Held(n + 1)
        if held.numbers:
            yield _transactions(held)

    def condition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The group-dependent transactions of parallel frequent-pattern growth: for each group the longest prefix that ends in one of its words.

        Many transactions share a prefix, which leaves once with their sums.
        """
        held = _Held(n + 1)
        for batch in batches:
            column = batch.column("words")
            prefixes, spots = conditional(column.flatten().to_numpy().astype(np.int64), column.value_lengths().to_numpy().astype(np.int64))
            held.add(prefixes, np.stack([batch.column(c).to_numpy() for c in names], axis=1)[spots])
            if len(held.numbers) > HELD:
                yield _by_group(held)
                held = _Held(n + 1)
        if held.numbers:
            yield _by_group(held)

    def grow(group_rows: pa.Table) -> pa.Table:
        group = group_rows.column("grp")[0].as_py()
        own = set(range(group, len(ranked), GROUPS))
        items, sizes, sums = (np.frombuffer(b"".join(group_rows.column(c).to_pylist()), kind) for c, kind in (("items", np.int32), ("sizes", np.int32), ("sums", np.float64)))
        grown = grow_patterns(items.astype(np.int64), sizes.astype(np.int64), sums.reshape(-1, n + 1), support_set, MAX_WORDS, own)
        found = [([ranked[k] for k in p], s) for p, s in grown if _conclusion(s, usual, support_set, CONFIDENCE_SET) is not None]
        return pa.table({"words": pa.array([w for w, _ in found], pa.list_(pa.string())), "sums": pa.array([s for _, s in found], pa.list_(pa.float64()))})

    # Most sentences are equal once their rare words are gone, so they are summed up before each becomes several transactions.
    sentences_of = cut.select("sentences").mapInArrow(transact, f"words array<int>, {sums_schema}").groupBy("words").agg(*totals)
    grown = sentences_of.mapInArrow(condition, "grp int, items binary, sizes binary, sums binary").groupBy("grp").applyInArrow(grow, "words array<string>, sums array<double>").toPandas()
    several: dict[str, list[tuple[frozenset[str], int, float]]] = defaultdict(list)
    for words, sums in sorted(zip(grown.words, grown.sums, strict=True), key=lambda x: (len(x[0]), list(x[0]))):
        subject, confidence = _conclusion(list(sums), usual, support_set, CONFIDENCE_SET)
        whole = frozenset(words)
        if any(sure.get(whole - {w}, -1.0) >= confidence - 0.05 for w in whole):
            continue
        sure[whole] = confidence
        head = max(whole, key=lambda w: rank[w])
        several[head].append((whole - {head}, subject, _weight(confidence, usual[subject])))
    mined = Rules(subjects, single, dict(several))
    return replace(mined, enough=_calibrate(mined, taught))


def document_subjects(cut: DataFrame, rules: Rules, id_col: str = "doc_id") -> DataFrame:
    """``(id_col, subject, share, n_sentences)``: the subjects that at least ``SHARE`` of the running sentences of a document, as ``cut``, deal with.

    Texts without running sentences have none. Repeated ids each give their rows.
    """
    kind = cut.schema["row_key"].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches if rules.subjects else ():
            numbered = Numbered(batch.column("sentences"))
            counts = numbered.said(rules.found(numbered))
            spots, subjects = np.nonzero((counts > 0) & (counts >= SHARE * numbered.lengths[:, None]))
            keys = batch.column("row_key").take(pa.array(spots, pa.int64()))
            names = pa.array([rules.subjects[k] for k in subjects.tolist()], pa.string())
            sizes = numbered.lengths[spots]
            yield pa.RecordBatch.from_arrays([keys, names, pa.array(counts[spots, subjects] / sizes, pa.float64()), pa.array(sizes, pa.int32())], names=[id_col, "subject", "share", "n_sentences"])

    return cut.mapInArrow(score, f"`{id_col}` {kind}, subject string, share double, n_sentences int")


def composition(found: DataFrame, documents: DataFrame) -> DataFrame:
    """The corpus by subject: ``(subject, n_documents, share_of_documents, mean_share)``."""
    total = documents.agg(F.count("*")).scalar()
    out = found.groupBy("subject").agg(F.count("*").alias("n_documents"), F.round(F.avg("share"), 6).alias("mean_share"))
    return out.withColumn("share_of_documents", F.round(F.try_divide("n_documents", total), 6))
