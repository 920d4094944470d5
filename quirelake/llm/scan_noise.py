"""Repair of text from scanned pages.

Running headers and page numbers are told by what stands at the edges of a
document's pages. The remaining lines of a page are joined into one stream of
tokens with the joints between them: a blank, or a hyphen at a line end. The
cheapest reading of the whole stream in words of the lexicon is decoded, in
which a word may be divided with its hyphen, broken by a blank, run together
with another or have misrecognised characters. Paragraph boundaries are chosen
by dynamic programming over the lines. The lexicon is counted over the whole
corpus; its frequent part, of bounded size, is held by every task, all other
words are read from files beside it, so a reading does not depend on the bound.
Spellings that no word settles are settled by a join with the whole lexicon.
"""

from __future__ import annotations

import atexit
import math
import re
import shutil
import sqlite3
import tempfile
import uuid
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirelake.common import durable

#: Most words of the lexicon that every task holds, the most frequent ones; all others are read from a file.
HELD_WORDS = 300_000
#: Least pages, and least part of a document's pages, that begin with a running header.
HEADER_PAGES, HEADER_SHARE = 2, 0.3
#: Times a word must be more frequent than an unknown spelling to be what was misread, where letters only were confused.
SURER = 5
#: Documents up to which their headers go to every task; beyond, rows of one document are spread over so many parts when its headers are joined to them.
SENT_DOCUMENTS, SALT = 50_000, 64
#: Least part of all words that a word must be for another one to be run together with it, and most times the whole may stand in scanned texts.
GLUED_SHARE, GLUED_TIMES = 0.002, 2
#: Costs: of a blank inside a word, of a hyphen, of a misrecognised character, of an unknown word besides its letters, of what all words settled.
BLANK, HYPHEN, EDIT, UNKNOWN, SETTLED = 9.0, 0.5, 4.0, 25.0, 12.0
#: Longest word of the lexicon; longer tokens are no words and have no readings.
LONGEST = 60

# Misrecognised characters and what they may stand for.
CONFUSIONS = {
    "c": ("e",), "ri": ("n",), "+": ("t",), "1": ("i", "l"), "@": ("a",), "0": ("o",), "!": ("i", "l"), "5": ("s",), "cl": ("d",), "9": ("g",), "b": ("h",), "rn": ("m",), "vv": ("w",),
    "ii": ("ü", "u"), "n": ("r",), "ﬁ": ("fi",), "ﬂ": ("fl",), "f": ("e",), "l": ("i",), "e": ("é", "è", "ę"), "a": ("ä", "à", "ą"), "o": ("ö", "ó"), "u": ("ü", "ú"), "|": ("l", "i"), "8": ("b",), "6": ("b",), "$": ("s",), "ﬀ": ("ff",),
}
# Hyphens at line ends, and words before which a hyphen stands for a left-out word part.
HYPHENS = "-­‐‑¬"
CONJUNCTIONS = frozenset("und oder bzw sowie bis and or to nor et ou y e o u ed od en of i oraz lub ni als wie".split())
#: Different tokens that a task counts before it passes the counts on.
HELD_TOKENS = 300_000
#: What is stripped from both ends of a word.
EDGE = ".,;:!?()[]{}\"'„“”«»‹›’‘*_…|"

_SYMBOL = re.compile(r"[0-9@+!|$ﬁﬂﬀ]")
_NUMBER_LINE = re.compile(
    r"^[\s\-–—·|\[]*(?:(?:page|seite|pagina|página|pág|pag|strona|str|blz|bladzijde|p|s)\b\.?\s*)?([0-9lIO|!]{1,6}|[ivxlcdm]{1,9})(?:\s*(?:of|von|de|di|van|sur|z|/)\s*[0-9lIO|!]{1,6})?[\s\-–—·|\]]*$", re.I
)
_NUMBER = re.compile(r"(?<!\w)[a-z]?[lio!|/.,-]*\d[\dlio!|/.,-]*(?!\w)")
_ROMAN = {"i": 1, "v": 5, "x": 10, "l": 50, "c": 100, "d": 500, "m": 1000}
_ROMAN_LINE = re.compile(r"m{0,3}(?:cm|cd|d?c{0,3})(?:xc|xl|l?x{0,3})(?:ix|iv|v?i{0,3})", re.I)
_CODE_ID = re.compile(r"[a-z]?\d+(?:[-/.,]\d+)*[a-z%]?$", re.I)


def number_of(line: str) -> int | None:
    """The number a page number line shows, in Arabic or Roman numerals, confused digits put right; None for other lines."""
    m = _NUMBER_LINE.match(line)
    if not m:
        return None
    shown = m.group(1)
    if any(c.isdigit() for c in shown):
        return int(re.sub(r"[lI|!]", "1", shown).replace("O", "0"))
    if _ROMAN_LINE.fullmatch(shown) and shown:
        values = [_ROMAN[c] for c in shown.lower()]
        return sum(-v if k + 1 < len(values) and v < values[k + 1] else v for k, v in enumerate(values))
    return None


def header_key(line: str) -> str:
    """A line without case, digits, blanks and marks, with letters that are easily confused made equal."""
    s = _NUMBER.sub(" ", line.lower()).replace("ﬁ", "fi").replace("ﬂ", "fl").translate(str.maketrans("1!|l0@+59chnäöüéèàóęf$", "iiiioatsgebraoueeaoees"))
    for a, b in (("rr", "m"), ("ei", "d"), ("vv", "w"), ("ii", "u"), ("ri", "r")):
        s = s.replace(a, b)
    return re.sub(r"[^a-z]|(?<![a-z])[a-z](?![a-z])", "", s)


def header_keys(line: str) -> str | None:
    """The key of a line that may be a running header; None for sentences, headings in markup, tables, numbers and code."""
    s = line.strip()
    if not 4 <= len(s) <= 90 or s[0] in "#-*>`|[{" or s[-1] in ".!?:;,-" or s.count(" | ") > 1 or number_of(s) is not None or re.search(r'[=;{}]|\("', s):
        return None
    if s[0].islower() or len(s.split()) > 9:
        return None
    return header_key(s) or None


def lexicon(clean: DataFrame, scanned: DataFrame) -> DataFrame:
    """``(word, n_clean, n_scanned)``: how often every word stands in the texts (column ``body``) of both."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Counting in place, with what is held bounded, sends far fewer rows than one for each token.
        seen: Counter[str] = Counter()
        for batch in batches:
            for text in batch.column("body").to_pylist():
                if text:
                    seen.update(text.lower().split())
            if len(seen) > HELD_TOKENS:
                yield counted(seen)
                seen.clear()
        if seen:
            yield counted(seen)

    def counted(seen: Counter[str]) -> pa.RecordBatch:
        words: Counter[str] = Counter()
        for token, n in seen.items():
            word = token.strip(EDGE)
            if 2 <= len(word) <= LONGEST and word[-1] not in HYPHENS:
                words[word] += n
        return pa.RecordBatch.from_arrays([pa.array(words.keys(), pa.string()), pa.array(words.values(), pa.int64())], names=["word", "n"])

    parts = [df.select("body").mapInArrow(count, "word string, n bigint") for df in (clean, scanned)]
    zero = F.lit(0).cast("bigint")
    both = parts[0].select("word", F.col("n").alias("c"), zero.alias("s")).unionByName(parts[1].select("word", zero.alias("c"), F.col("n").alias("s")))
    return both.groupBy("word").agg(F.sum("c").alias("n_clean"), F.sum("s").alias("n_scanned"))


def readings(word: str, depth: int = 2) -> dict[str, int]:
    """What ``word`` may have been before up to ``depth`` misrecognitions, with the number of them."""
    if len(word) > LONGEST + depth:
        return {}
    out, layer = {word: 0}, [word]
    for cost in range(1, depth + 1):
        following = []
        for w in layer:
            for wrong, rights in CONFUSIONS.items():
                at = w.find(wrong)
                while at >= 0:
                    for right in rights:
                        fixed = w[:at] + right + w[at + len(wrong) :]
                        if fixed not in out:
                            out[fixed] = cost
                            following.append(fixed)
                    at = w.find(wrong, at + 1)
        layer = following
    # A symbol is nearly always confused wherever it stands in a word, so all of them at once are a reading too.
    plain = word
    for wrong in "+@059!1|$":
        plain = plain.replace(wrong, CONFUSIONS[wrong][0])
    out.setdefault(plain, depth)
    del out[word]
    return out


class Span(NamedTuple):
    """A reading of some neighbouring tokens as one word, or as they stand where ``word`` is None."""

    first: int
    last: int
    word: str | None
    found: tuple[tuple[str, str], ...] = ()
    open_: tuple[tuple[str, str, str], ...] = ()
    #: Whether a mark at the end is a character of the word.
    marked: bool = False


class Counts(dict[str, int]):
    """Words with how often they stand: the held ones, and those in files that ``_filed`` wrote."""

    def __init__(self, held: dict[str, int], files: list[str]):
        super().__init__(held)
        self.files = [sqlite3.connect(f"file:{path}?mode=ro&immutable=1", uri=True) for path in files]
        #: What the files said lately, 0 for what they do not have.
        self.lately: dict[str, int] = {}

    def get(self, word: str, default: int | None = None) -> int | None:
        n = super().get(word)
        if n is not None or not self.files:
            return default if n is None else n
        n = self.lately.get(word)
        if n is None:
            found = (f.execute("SELECT n FROM words WHERE word = ?", (word,)).fetchone() for f in self.files)
            if len(self.lately) > HELD_WORDS:
                self.lately.clear()
            n = self.lately[word] = next((row[0] for row in found if row), 0)
        return n or default

    def __contains__(self, word: object) -> bool:
        return self.get(word) is not None

    def __getitem__(self, word: str) -> int:
        n = self.get(word)
        if n is None:
            raise KeyError(word)
        return n


class Decoder:
    """Readings of token streams by the words of the lexicon, and by what a join with all of it settled before."""

    def __init__(self, counts: dict[str, int], repairs: bool = True, total: int | None = None):
        self.counts, self.total = counts, max(1, sum(counts.values()) if total is None else total)
        self.memory: dict[str, tuple[str | None, float]] = {}
        #: Whether broken and run-together words are asked for too, which are no noise of their own but matter to the text.
        self.repairs = repairs
        #: What the whole lexicon says on the spellings of the text at hand, by first and second part.
        self.settled: dict[str, str] = {}

    def cost(self, word: str) -> float:
        """Minus the log probability of a known word; infinite for others."""
        n = self.counts.get(word)
        return math.inf if not n else math.log(self.total / n)

    def correct(self, word: str) -> tuple[str | None, float]:
        """The cheapest known reading of a word with misrecognised characters, and its cost."""
        hit = self.memory.get(word)
        if hit is None:
            best, least = None, math.inf
            if any(c.isalpha() for c in word):
                for reading, edits in readings(word).items():
                    if reading in self.counts and (c := self.cost(reading) + EDIT * edits) < least:
                        best, least = reading, c
            if len(self.memory) > 200_000:
                self.memory.clear()
            hit = self.memory[word] = (best, least)
        return hit

    def _alone(self, core: str) -> float:
        return self.cost(core) if core in self.counts else min(self.correct(core)[1], UNKNOWN + len(core))

    def _single(self, k: int, token: str, core: str) -> tuple[float, Span]:
        """The cheapest reading of a token by itself."""
        counts = self.counts
        if not core or core in counts:
            return self.cost(core) if core else 0.0, Span(k, k, None)
        # A mark that belongs to the word may have been stripped as punctuation.
        marked = token[-1:] == "!" and self.correct(core)[0] is None
        if marked:
            core = token.lstrip(EDGE).lower()
        if len(core) < 3 or core in counts or _CODE_ID.match(core) or sum(c.isdigit() for c in core) > 3 or not any(c.isalpha() for c in core) or core[-1] in HYPHENS:
            return UNKNOWN + len(core), Span(k, k, None)
        word, cost = self.correct(core)
        if word is not None and cost < UNKNOWN + len(core) and (_SYMBOL.search(core) or counts[word] >= SURER):
            return cost, Span(k, k, word, (("misread", word),), (), marked)
        asked: tuple[tuple[str, str, str], ...] = (("misread", core, ""),)
        if self.repairs and len(core) > 5 and core.isalpha():
            asked += (("run together", core, "\u0004"),)
        word = self.settled.get(f"{core}\u0002\u0001") or self.settled.get(f"{core}\u0002\u0004")
        return (UNKNOWN + len(core) if word is None else SETTLED), Span(k, k, word, (), asked, marked)

    def _joined(self, k: int, parts: list[str], joints: list[str]) -> tuple[float, Span] | None:
        """The cheapest reading of neighbouring tokens as one word, if there is one."""
        last, blanks = k + len(parts) - 1, joints.count(" ")
        price = HYPHEN * (len(joints) - blanks) + BLANK * blanks
        whole = "".join(parts)
        spellings = [whole]
        if blanks < len(joints):
            spellings.append("".join(part + ("-" if j == "-" else "") for part, j in zip(parts, [*joints, ""], strict=True)))
        word = max(spellings, key=lambda w: self.counts.get(w, 0))
        if word in self.counts:
            return self.cost(word) + price, Span(k, last, word, () if blanks else (("hyphenation", word),))
        if len(parts) > 2:
            return None
        if blanks:
            word = self.settled.get(f"{whole}\u0002\u0003")
            return None if word is None else (SETTLED, Span(k, last, word))
        cost, word = min(((c + price, w) for w, c in map(self.correct, spellings) if w is not None), default=(math.inf, None))
        apart = sum(map(self._alone, parts))
        if word is not None and cost < apart:
            return cost, Span(k, last, word, (("hyphenation", word), ("misread", word)))
        return apart, Span(k, last, self.settled.get(f"{parts[0]}\u0002{parts[1]}", whole), (), (("hyphenation", parts[0], parts[1]),))

    def decode(self, shown: list[str], lines: list[int]) -> list[Span]:
        """The cheapest reading of a stream of tokens, which stand on the given lines, as spans that cover it.

        Known words without a hyphen stay, so the stream falls apart at them,
        and only the stretches between are searched; a word broken by a blank
        has an unknown part.
        """
        cores = [t.strip(EDGE).lower() for t in shown]
        n = len(shown)
        known = [not c or c in self.counts for c in cores]
        joints = ["|"] * n
        for k in range(n - 1):
            a = shown[k]
            if lines[k] != lines[k + 1]:
                if a[-1] in HYPHENS and len(a) > 1 and a[-2].isalpha():
                    second = cores[k + 1].rstrip(HYPHENS)
                    if second and second[0].isalpha() and second not in CONJUNCTIONS:
                        joints[k] = "-"
            # A mark between two tokens ends a word.
            elif not (known[k] and known[k + 1]) and a[-1].isalpha() and shown[k + 1][0].isalpha() and cores[k].isalpha() and cores[k + 1].isalpha():
                joints[k] = " "
        out: list[Span] = []
        k = 0
        while k < n:
            if known[k] and joints[k] == "|":
                out.append(Span(k, k, None))
                k += 1
                continue
            end = k + 1
            while joints[end - 1] != "|":
                end += 1
            out += self._stretch(k, end, shown, cores, joints)
            k = end
        return out

    def _stretch(self, begin: int, end: int, shown: list[str], cores: list[str], joints: list[str]) -> list[Span]:
        """Dynamic programming over the tokens from ``begin`` to ``end``."""
        best: list[tuple[float, Span | None]] = [(0.0, None)] + [(math.inf, None)] * (end - begin)
        for k in range(begin, end):
            before = best[k - begin][0]
            if before == math.inf:
                continue
            for m in range(k + 1, min(end, k + 3) + 1):
                inner = joints[k : m - 1]
                if m == k + 1:
                    option = self._single(k, shown[k], cores[k])
                else:
                    parts = [shown[x].lstrip(EDGE).rstrip(HYPHENS).lower() if joints[x] == "-" and x < m - 1 else cores[x].rstrip(HYPHENS) if x > k and joints[x - 1] == "-" else cores[x] for x in range(k, m)]
                    option = self._joined(k, parts, inner)
                if option is not None:
                    # A hyphen at a line end belongs to a word with the next token.
                    total = before + option[0] + (100.0 if joints[m - 1] == "-" and m < end else 0.0)
                    if total < best[m - begin][0]:
                        best[m - begin] = (total, option[1])
        out: list[Span] = []
        at = end
        while at > begin:
            span = best[at - begin][1]
            assert span is not None
            if self.repairs:
                # Whether all words know what it would make with the next token.
                asked = tuple(("broken", cores[x] + cores[x + 1], "\u0003") for x in range(span.first, min(span.last + 1, end - 1)) if joints[x] == " " and x + 1 > span.last)
                span = span._replace(open_=span.open_ + asked)
            out.append(span)
            at = span.first
        return out[::-1]


def dressed(head: str, tail: str, span: Span) -> str:
    """The word of ``span`` with the punctuation before ``head`` and after ``tail``, and with the capitals of ``head``."""
    word = span.word
    core = head.strip(EDGE)
    if core[:1].isupper():
        word = word.upper() if len(core) > 1 and core.isupper() else word[:1].upper() + word[1:]
    return head[: len(head) - len(head.lstrip(EDGE))] + word + ("" if span.marked else tail[len(tail.rstrip(EDGE)) :])


def _body_lines(text: str) -> list[tuple[int, str]]:
    """Numbered lines without code and tables."""
    out, code = [], False
    for k, line in enumerate(text.splitlines()):
        if line.lstrip().startswith("```"):
            code = not code
        elif not code and " | " not in line.strip(" |"):
            out.append((k, line))
    return out


def page_furniture(text: str, keys: frozenset[str], expected: int | None, is_page: bool) -> tuple[dict[int, str], dict[int, str]]:
    """Line numbers and trimmed lines of running headers and of page numbers.

    ``keys`` are the keys of the document's headers, ``expected`` the number
    this page should show. In a segment such lines stand anywhere, a bare
    number only beside a header.
    """
    lines = text.splitlines()
    filled = [k for k, line in enumerate(lines) if line.strip()]
    headers, numbers = {}, {}
    edge = set(filled[:4] + filled[-3:]) if is_page else set(filled)
    for k in filled:
        line = lines[k].strip()
        if k in edge and keys and header_keys(line) in keys:
            # A page's own title repeats its header once; further lines of the kind are headings.
            if is_page and k not in filled[:2] and k not in filled[-2:] and not (k in filled[:4] and all(p in headers or p in numbers for p in filled[: filled.index(k)])):
                continue
            headers[k] = line
    for k in filled:
        line = lines[k].strip()
        value = number_of(line)
        if value is None or k in headers:
            continue
        at = filled.index(k)
        bare = line.isalnum()
        if is_page:
            if k not in set(filled[:3] + filled[-2:]):
                continue
            column = any(number_of(lines[x].strip()) is not None and x not in headers for x in (k - 1, k + 1) if 0 <= x < len(lines) and lines[x].strip())
            if expected is not None:
                if value == expected or (not bare and not column):
                    numbers[k] = line
            elif not column and (at <= 1 or at >= len(filled) - 1):
                numbers[k] = line
        else:
            near = [filled[x] for x in (at - 1, at + 1) if 0 <= x < len(filled)]
            if any(x in headers for x in near) or (not bare and len(filled) > 1 and not any(number_of(lines[x].strip()) is not None for x in near)):
                numbers[k] = line
    return headers, numbers


def paragraphs(lines: list[str]) -> list[list[int]]:
    """Line numbers of each paragraph, chosen by dynamic programming.

    A break costs little after a blank line, a short line or a full stop, much
    inside a sentence; every paragraph costs something itself.
    """
    filled = [k for k, line in enumerate(lines) if line.strip()]
    if not filled:
        return []
    width = max(len(lines[k]) for k in filled)
    cost = []
    for a, b in zip(filled, filled[1:], strict=False):
        x, y = lines[a].strip(), lines[b].strip()
        score = 2.0 - 3.0 * (b > a + 1) - 1.5 * (len(x) + 1 + len(y.split(None, 1)[0]) <= width) + (1.5 if x[-1] not in ".!?:\"”»)" else -0.5) + (3.0 if y[0].islower() or x[-1] in HYPHENS else 0.0)
        cost.append(score)
    # Breaks before a paragraph are paid, and joins inside it are paid where a break would have been cheap. Joins are sums over
    # lines, so the best beginning of a paragraph does not depend on its end.
    n = len(filled)
    best, back = [0.0] + [math.inf] * n, [0] * (n + 1)
    joined, lowest, start = 0.0, 0.0, 0
    for end in range(1, n + 1):
        best[end], back[end] = lowest + joined + 0.3, start
        if end < n:
            joined += max(0.0, -cost[end - 1])
            opened = best[end] + max(0.0, cost[end - 1]) - joined
            if opened < lowest:
                lowest, start = opened, end
    out, end = [], n
    while end:
        out.append(filled[back[end] : end])
        end = back[end]
    return out[::-1]


def scan(text: str, keys: frozenset[str], expected: int | None, is_page: bool, decoder: Decoder) -> tuple[list[tuple[str, str]], list[tuple[str, str, str]], list[str]]:
    """The noise found ``(noise, item)``, what the held words leave open ``(noise, first part, second part)``, and the repaired paragraphs."""
    headers, numbers = page_furniture(text, keys, expected, is_page)
    found = [("running_header", line) for line in headers.values()] + [("page_number", line) for line in numbers.values()]
    open_: list[tuple[str, str, str]] = []
    body = [(k, line) for k, line in _body_lines(text) if k not in numbers]
    shown: list[str] = []
    lines: list[int] = []
    for n, (k, line) in enumerate(body):
        tokens = line.split()
        if k in headers:
            # Words of headers may be misread too, but are in no sentence.
            for span in decoder.decode(tokens, [n] * len(tokens)):
                found += span.found
                open_ += span.open_
        else:
            shown += tokens
            lines += [n] * len(tokens)
    repaired: list[list[str]] = [[] for _ in body]
    for span in decoder.decode(shown, lines):
        found += span.found
        open_ += span.open_
        head, tail = shown[span.first], shown[span.last]
        words = [dressed(head, tail, span)] if span.word is not None else shown[span.first : span.last + 1]
        repaired[lines[span.first]] += words
    kept = [" ".join(words) for words in repaired]
    return found, open_, [" ".join(kept[n] for n in part if kept[n]) for part in paragraphs([line if n not in headers else "" for n, line in body])]


def _documents_furniture(pages: DataFrame) -> DataFrame:
    """``(document_id, keys, shift)``: the keys of a document's running headers, and page number shown minus page_number."""
    lines = F.filter(F.split("body", r"\r\n|\r|\n"), lambda x: F.trim(x) != "")
    edge = pages.where("document_id IS NOT NULL AND page_number IS NOT NULL AND body IS NOT NULL").select("document_id", "page_number", F.slice(lines, 1, 3).alias("head"), F.when(F.size(lines) > 3, F.slice(lines, -2, 2)).alias("tail"))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for document_id, page, head, tail in zip(pdf.document_id, pdf.page_number, pdf["head"], pdf["tail"], strict=True):
                head, tail = list(head), [] if tail is None else list(tail)
                place = 0
                for line in head:
                    if (value := number_of(line.strip())) is not None:
                        rows.append((document_id, page, None, value - page))
                        continue
                    key = header_keys(line)
                    if key is None or place > 0:
                        break
                    rows.append((document_id, page, key, None))
                    place += 1
                rows += [(document_id, page, None, value - page) for line in tail if (value := number_of(line.strip())) is not None]
            out = pd.DataFrame(rows, columns=["document_id", "page_number", "key", "shift"])
            yield out.astype({"page_number": "Int32", "shift": "Int64"})

    facts = edge.mapInPandas(read, "document_id string, page_number int, key string, shift bigint").distinct()
    sizes = edge.groupBy("document_id").agg(F.countDistinct("page_number").alias("n_pages"))
    keys = facts.where("key IS NOT NULL").groupBy("document_id", "key").agg(F.countDistinct("page_number").alias("n")).join(sizes, "document_id")
    keys = keys.where((F.col("n") >= HEADER_PAGES) & (F.col("n") >= HEADER_SHARE * F.col("n_pages"))).groupBy("document_id").agg(F.collect_set("key").alias("keys"))
    shifts = facts.where("shift IS NOT NULL").groupBy("document_id", "shift").agg(F.countDistinct("page_number").alias("n")).where("n >= 2")
    shifts = shifts.groupBy("document_id").agg(F.max_by("shift", F.struct("n", F.col("shift"))).alias("shift"))
    return sizes.select("document_id").join(keys, "document_id", "left").join(shifts, "document_id", "left")


def _with_furniture(rows: DataFrame, furniture: DataFrame) -> DataFrame:
    """``rows`` with the headers of their documents, by broadcast where there are few documents, else in ``SALT`` parts of each; null documents have none."""
    furniture = durable(furniture)
    if furniture.count() <= SENT_DOCUMENTS:
        return rows.join(F.broadcast(furniture), "document_id", "left")
    part = F.pmod(F.xxhash64("source_table", "row_id"), F.lit(SALT)).cast("int")
    spread = furniture.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    return rows.withColumn("part", part).join(spread, ["document_id", "part"], "left")


def _most_frequent(words: DataFrame) -> pd.DataFrame:
    """At most ``HELD_WORDS`` words, all those of at least some frequency that is a power of two."""
    sized = words.withColumn("size", F.floor(F.log2(F.col("n_clean") + F.col("n_scanned"))))
    # One row for each power of two.
    counts = dict(sized.groupBy("size").count().collect())
    least, total = max([0, *counts]) + 1, 0
    while least > 0 and total + counts.get(least - 1, 0) <= HELD_WORDS:
        least -= 1
        total += counts.get(least, 0)
    return sized.where(F.col("size") >= least).select("word", "n_clean", "n_scanned").toPandas().sort_values("word", ignore_index=True)


def _filed(words: DataFrame) -> str | None:
    """The name under which every task finds the file of ``words`` ``(word, n)``, written row by row; None where there are none."""
    rows = words.toLocalIterator()
    first = next(rows, None)
    if first is None:
        return None
    folder, name = tempfile.mkdtemp(prefix="quirelake-words-"), f"words-{uuid.uuid4().hex}.sqlite"
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    with sqlite3.connect(f"{folder}/{name}") as db:
        db.execute("PRAGMA journal_mode = OFF")
        db.execute("CREATE TABLE words (word TEXT PRIMARY KEY, n INTEGER) WITHOUT ROWID")
        db.execute("INSERT INTO words VALUES (?, ?)", tuple(first))
        db.executemany("INSERT INTO words VALUES (?, ?)", map(tuple, rows))
    db.close()
    words.sparkSession.sparkContext.addFile(f"{folder}/{name}")
    return name


def _known(words: DataFrame) -> tuple[dict[str, int], list[str], int]:
    """The words that stay as they are: those held, the files of all others, and how often all of them stand."""
    usable = durable(words.where(~F.col("word").rlike("[0-9]") & F.expr("n_clean > 0 OR n_scanned >= 40")).select("word", "n_clean", "n_scanned"))
    held = _most_frequent(usable)
    n = (F.col("n_clean") + F.col("n_scanned")).alias("n")
    clean = held[held.n_clean > 0]
    counts = dict(zip(clean.word, (clean.n_clean + clean.n_scanned).tolist(), strict=True))
    # Words of scanned texts only, such as publishers' names, are known unless they are a clean word misread.
    scanned = held[held.n_clean == 0]
    if len(held) == usable.count():
        decoder = Decoder(counts)
        own = {word: n for word, n in zip(scanned.word, scanned.n_scanned.tolist(), strict=True) if not _SYMBOL.search(word) and decoder.correct(word)[0] is None}
        return counts | own, [], sum(counts.values()) + sum(own.values())
    # Counts below the least power of two that is held; words of one size are held together or not at all.
    rest = usable if held.empty else usable.where(F.floor(F.log2(F.col("n_clean") + F.col("n_scanned"))) < math.floor(math.log2(int((held.n_clean + held.n_scanned).min()))))
    files = [name for name in [_filed(rest.where("n_clean > 0").select("word", n))] if name]
    total = usable.where("n_clean > 0").agg(F.sum(n)).collect()[0][0] or 0

    def unread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        decoder = Decoder(Counts(counts, [SparkFiles.get(name) for name in files]), total=total)
        for pdf in batches:
            yield pdf[[not _SYMBOL.search(word) and decoder.correct(word)[0] is None for word in pdf.word]]

    own = durable(usable.where("n_clean = 0").select("word", n).mapInPandas(unread, "word string, n bigint"))
    files += [name for name in [_filed(own)] if name]
    return counts, files, total + (own.agg(F.sum("n")).collect()[0][0] or 0)


def _scanned(rows: DataFrame, furniture: DataFrame, words: DataFrame, schema: str, shape, repairs: bool) -> DataFrame:
    counts, files, total = _known(words)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        decoder = Decoder(Counts(counts, [SparkFiles.get(name) for name in files]) if files else counts, repairs, total)
        for pdf in batches:
            rows = []
            for row in pdf.itertuples(index=False):
                if not row.body:
                    continue
                keys = frozenset() if row.keys is None else frozenset(row.keys)
                is_page = row.source_table == "page_extractions"
                decoder.settled = dict(getattr(row, "settled", None) or {})
                expected = None if pd.isna(row.shift) or pd.isna(row.page_number) else int(row.shift) + int(row.page_number)
                rows += shape(row, *scan(row.body, keys, expected, is_page, decoder))
            yield pd.DataFrame(rows, columns=[c.split()[0].strip("`") for c in schema.split(", ")])

    more = [c for c in rows.columns if c == "settled"]
    return _with_furniture(rows, furniture).select("source_table", "row_id", "page_number", "body", "keys", "shift", *more).mapInPandas(run, schema)


def found_noise(scanned: DataFrame, clean: DataFrame) -> DataFrame:
    """Distinct ``(source_table, row_id, noise, item)`` of all noise in ``scanned``.

    ``scanned`` has ``source_table`` (``page_extractions`` or another),
    ``row_id``, ``document_id``, ``page_number``, ``body``; ``clean`` has
    ``body``, texts that were not scanned. Null and empty texts have no noise;
    null documents and page numbers have no headers of their own. Repeated rows
    come out once.
    """
    words = durable(lexicon(clean, scanned))
    furniture = _documents_furniture(scanned.where(F.col("source_table") == "page_extractions"))
    settled, late = _noise(scanned, furniture, words, repairs=False)
    return settled.unionByName(late.select("source_table", "row_id", "noise", F.col("answer").alias("item"))).distinct()


def _noise(scanned: DataFrame, furniture: DataFrame, words: DataFrame, repairs: bool) -> tuple[DataFrame, DataFrame]:
    """The noise that the held words settle, ``(source_table, row_id, noise, item)``, and what all words do, ``(source_table, row_id, noise, item, rest, answer)`` with the parts of the spelling."""
    kind = scanned.schema["row_id"].dataType.simpleString()

    def shape(row, found, open_, _):
        return [(row.source_table, row.row_id, noise, item, "") for noise, item in found] + [(row.source_table, row.row_id, noise, first, second or "\u0001") for noise, first, second in open_]

    out = durable(_scanned(scanned, furniture, words, f"source_table string, row_id {kind}, noise string, item string, rest string", shape, repairs).distinct())
    settled = out.where("rest = ''").select("source_table", "row_id", "noise", "item")
    frequent = words.where("length(word) > 2 AND word RLIKE '^\\\\p{L}+$'").select("word", (F.col("n_clean") + F.col("n_scanned")).alias("n"))
    # Of words with a given least part of all there are at most as many as its reciprocal.
    glue = frozenset(r.word for r in frequent.where(F.col("n") >= GLUED_SHARE * words.agg(F.sum(F.col("n_clean") + F.col("n_scanned"))).scalar()).select("word").collect()) if repairs else frozenset()

    def candidates(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for noise, item, rest in zip(pdf.noise, pdf["item"], pdf["rest"], strict=True):
                if noise == "hyphenation":
                    for whole in (item + rest, f"{item}-{rest}"):
                        rows.append((noise, item, rest, whole, whole, 0, True))
                        rows += [(noise, item, rest, r, r, edits, False) for r, edits in readings(whole, 1).items()]
                    continue
                rows.append((noise, item, rest, item, item, 0, True))
                if noise == "misread":
                    rows += [(noise, item, rest, r, r, edits, False) for r, edits in readings(item).items()]
                elif noise == "run together":
                    for cut in range(3, len(item) - 2):
                        a, b = item[:cut], item[cut:]
                        if a in glue or b in glue:
                            rows.append((noise, item, rest, b if a in glue else a, f"{a} {b}", 0, False))
            yield pd.DataFrame(rows, columns=["noise", "item", "rest", "word", "shown", "edits", "own"])

    # The rest is looked up in the whole lexicon; each different spelling once.
    asked = out.where("rest <> ''").select("noise", "item", "rest").distinct().mapInPandas(candidates, "noise string, item string, rest string, word string, shown string, edits int, own boolean")
    n = F.col("n_clean") * 3 + F.col("n_scanned")
    rank = F.struct(-F.col("edits"), n, "shown")
    answers = asked.join(words, "word").groupBy("noise", "item", "rest").agg(
        F.max_by("shown", rank).alias("word"),
        F.max_by(F.struct("shown", n.alias("n"), "edits"), F.when(~F.col("own"), rank)).alias("other"),
        F.max_by("shown", F.when(~F.col("own") & (F.col("n_clean") > 0), rank)).alias("clean"),
        F.max(F.when(F.col("own"), n)).alias("own_n"),
        F.max(F.when(F.col("own"), F.col("n_clean"))).alias("own_clean"),
    )
    has_symbol = F.col("item").rlike(r"[0-9@+!|$ﬁﬂﬀ]")
    surer = F.when(has_symbol, F.lit(1)).otherwise(F.lit(SURER))
    is_new = F.coalesce("own_clean", F.lit(0)) == 0
    misread = is_new & (F.col("other.n") >= surer * F.greatest(F.coalesce("own_n", F.lit(0)), F.lit(1)))
    noise = F.col("noise")
    answer = (
        F.when(noise == "misread", F.when(misread, F.col("other.shown")))
        .when(noise == "broken", F.when(~is_new, F.col("item")))
        .when(noise == "run together", F.when(is_new & (F.coalesce("own_n", F.lit(0)) <= GLUED_TIMES), F.col("clean")))
        .otherwise(F.coalesce(F.col("word"), F.concat("item", "rest")))
    )
    late = out.where("rest <> ''").join(answers.select("noise", "item", "rest", answer.alias("answer")), ["noise", "item", "rest"], "left")
    late = late.withColumn("answer", F.coalesce("answer", F.when(noise == "hyphenation", F.concat("item", "rest")))).where("answer IS NOT NULL")
    return settled, late.select("source_table", "row_id", "noise", "item", "rest", "answer")


def repaired_paragraphs(scanned: DataFrame, clean: DataFrame) -> DataFrame:
    """``(source_table, row_id, paragraph_no, content)``: continuous paragraphs without headers, page numbers, tables and code."""
    words = durable(lexicon(clean, scanned))
    furniture = durable(_documents_furniture(scanned.where(F.col("source_table") == "page_extractions")))
    kind = scanned.schema["row_id"].dataType.simpleString()

    # Spellings the held words leave open are settled by all words before the paragraphs are written.
    _, late = _noise(scanned, furniture, words, repairs=True)
    answers = late.groupBy("source_table", "row_id").agg(F.map_from_entries(F.collect_set(F.struct(F.concat("item", F.lit("\u0002"), "rest"), F.col("answer")))).alias("settled"))
    scanned = scanned.join(answers, ["source_table", "row_id"], "left")

    def shape(row, _, __, parts):
        return [(row.source_table, row.row_id, n, part) for n, part in enumerate(p for p in parts if p)]

    return _scanned(scanned, furniture, words, f"source_table string, row_id {kind}, paragraph_no int, content string", shape, repairs=True)
