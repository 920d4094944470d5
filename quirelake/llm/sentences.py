"""Running sentences of a text, without headings, tables, code, running headers and page numbers."""

from __future__ import annotations

import re

_FENCE = re.compile(r"```.*?(?:```|\Z)", re.S)
_PREFIX = re.compile(r"^(?:>+\s*|[-*+•]\s+|\(?\d{1,3}[.)]\s+)+")
#: A full stop, exclamation or question mark with closing marks, before white space and what can begin a sentence.
_END = re.compile(r"[.!?。！？][.!?。！？]*[\"'”“»)\]]*\s+(?=[\"'„“«(\[¿¡]*[^\W_a-zß-öø-ÿ])")
_STOPS = ".!?。！？"
_CLOSED = re.compile(r"[.!?。！？][\"'”“»)\]]*$")
_ABBREVIATIONS = ("bzw", "ca", "Nr", "No", "vgl", "evtl", "ggf", "Abb", "Tab", "Fig", "Dr", "Mr", "Mrs", "Ms", "Prof", "St", "art", "Art", "cf", "pag", "str", "zob", "ver", "resp", "approx")
_OPEN_ABBREVIATION = re.compile(rf"(?:^|[\s(„“\"«])(?:\w|{'|'.join(_ABBREVIATIONS)})\.$")
_ABBREVIATED = tuple(f"{a}." for a in _ABBREVIATIONS)
#: Two words; a word is tried from its beginning only.
_WORDS = re.compile(r"(?<![^\W\d_])[^\W\d_]{2,}+.*?[^\W\d_]{2}", re.S)


def _blocks(text: str) -> list[str]:
    """Paragraphs with their lines joined; headings and tables end a paragraph and are left out."""
    if "```" in text:
        text = _FENCE.sub("\n\n", text)
    lines = [line.strip() for line in text.splitlines()]
    width = max(map(len, lines), default=0)
    blocks: list[str] = []
    open_: list[str] = []
    last = len(lines) - 1
    for k, line in enumerate(lines):
        if not line or line[0] == "#" or " | " in line or line[0] == "|":
            if open_:
                blocks.append(" ".join(open_))
                open_ = []
            continue
        if (line[0] in ">-*+•(" or line[0].isdigit()) and (not open_ or _CLOSED.search(open_[-1])):
            line = _PREFIX.sub("", line)
            if not line:
                continue
        open_.append(line)
        if k < last and line[-1] not in ".!?":
            following = lines[k + 1]
            # The line broke although the next word had room: it is a heading or header, not a wrapped line.
            if following[:1].isupper() and len(line) + 1 + len(following.split(None, 1)[0]) <= width:
                blocks.append(" ".join(open_))
                open_ = []
    if open_:
        blocks.append(" ".join(open_))
    return blocks


def running_sentences(text: str | None) -> list[str]:
    """The running sentences of ``text`` in order, list items and quotations included.

    A sentence ends in a full stop, exclamation or question mark and has at
    least two words. Null and empty texts have none.
    """
    if not text:
        return []
    out: list[str] = []
    for block in _blocks(text):
        begin = 0
        for m in _END.finditer(block):
            sentence = block[begin : m.end()].rstrip()
            # The pattern is needed only after one letter or where an abbreviation may end.
            if sentence[-1] == "." and (not sentence[-3:-2].isalnum() or sentence.endswith(_ABBREVIATED)) and _OPEN_ABBREVIATION.search(sentence[-12:]):
                continue
            out.append(sentence)
            begin = m.end()
        rest = block[begin:].rstrip()
        if rest and (rest[-1] in _STOPS or _CLOSED.search(rest)):
            out.append(rest)
    return [s for s in out if _WORDS.search(s)]
