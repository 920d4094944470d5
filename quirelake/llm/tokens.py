"""Token ids of a whole corpus by a public byte-level BPE vocabulary.

A short text is encoded in one piece. A long one is cut into leaves that are
encoded in parallel; then neighbouring halves are joined up a binary tree. A
join re-encodes a window around the seam and widens it until the window's
outermost tokens on both sides equal the tokens already there, so the result is
exactly the encoding of the undivided text.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Texts longer than this many code points are encoded as a tree of leaves of this length.
LEAF_CHARS = 16_384

# Fixed value: the published pre-tokenisation pattern of this family of vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Before white space that follows a letter or digit a piece always ends, whatever surrounds it.
_EDGE = re.compile(rb"(?<=[A-Za-z0-9])(?=[ \n])")


@lru_cache(maxsize=4)
def encoder(vocabulary: str = VOCABULARY):
    """The encoder of a rank file, made once in each Python process."""
    import tiktoken

    with open(vocabulary, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    return tiktoken.Encoding("corpus", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def _edges(tokens: list[int], enc) -> tuple[bytes, list[int], np.ndarray]:
    """The bytes of tokens, the sure piece boundaries in them, and the offset at which each token starts."""
    parts = enc.decode_tokens_bytes(tokens)
    starts = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(int)
    data = b"".join(parts)
    return data, [m.start() for m in _EDGE.finditer(data)], starts


def join_encodings(left: list[int], right: list[int], enc, window: int = 16) -> list[int]:
    """The encoding of the text of ``left`` followed by the text of ``right``.

    The window starts with ``window`` tokens on each side and doubles until it
    holds two sure boundaries on each side between which old and new tokens
    agree, or until it holds everything.
    """
    if not left or not right:
        return left or right
    while True:
        head, tail = left[-window:], right[:window]
        a, cuts_a, starts_a = _edges(head, enc)
        b, cuts_b, starts_b = _edges(tail, enc)
        whole_a, whole_b = window >= len(left), window >= len(right)
        begin = 0 if whole_a else (cuts_a[0] if len(cuts_a) > 1 else None)
        end = len(b) if whole_b else (cuts_b[-1] if len(cuts_b) > 1 else None)
        if begin is not None and end is not None:
            fresh = enc.encode_ordinary((a[begin:] + b[:end]).decode("utf-8", errors="surrogatepass"))
            i, j = int(np.searchsorted(starts_a, begin)), int(np.searchsorted(starts_b, end))
            n = 0 if whole_a else int(np.searchsorted(starts_a, cuts_a[1])) - i
            m = 0 if whole_b else j - int(np.searchsorted(starts_b, cuts_b[-2]))
            if fresh[:n] == head[i : i + n] and (m == 0 or fresh[-m:] == tail[j - m : j]):
                return left[: len(left) - len(head) + i] + fresh + right[j:]
        window *= 2


def join_tree(parts: list[list[int]], enc) -> list[int]:
    """The encoding of all parts' texts in order, joined pairwise level by level."""
    while len(parts) > 1:
        parts = [join_encodings(parts[k], parts[k + 1], enc) if k + 1 < len(parts) else parts[k] for k in range(0, len(parts), 2)]
    return parts[0] if parts else []


def _list_array(lists: list[list[int]]) -> pa.ListArray:
    offsets = np.zeros(len(lists) + 1, dtype=np.int32)
    np.cumsum([len(x) for x in lists], out=offsets[1:])
    flat = np.fromiter((t for x in lists for t in x), dtype=np.int32, count=int(offsets[-1]))
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def encode_corpus(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY, leaf_chars: int = LEAF_CHARS) -> DataFrame:
    """``(id_col, ids)``: the token ids of every row's text, without special tokens.

    Null and empty texts give an empty list; a null id is kept. Rows that
    repeat an id, also with the same text, each give a row. Other columns are
    not read. Texts of any length are encoded whole.
    """
    kind = df.schema[id_col].dataType.simpleString()
    rows = df.select(F.col(id_col).alias("row_key"), F.col(text_col).alias("body"))
    is_long = F.coalesce(F.length("body") > leaf_chars, F.lit(False))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        for batch in batches:
            ids = [enc.encode_ordinary(t) if t else [] for t in batch.column("body").to_pylist()]
            kept = [batch.column(k) for k in range(batch.num_columns) if batch.schema.names[k] != "body"]
            names = [n for n in batch.schema.names if n != "body"]
            yield pa.RecordBatch.from_arrays([*kept, _list_array(ids)], names=[*names, "ids"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                text = row["body"]
                leaves = [text[k : k + leaf_chars] for k in range(0, len(text), leaf_chars)]
                columns = {n: pa.array([row[n]] * len(leaves), batch.schema.field(n).type) for n in batch.schema.names if n != "body"}
                yield pa.RecordBatch.from_pydict(columns | {"leaf": pa.array(range(len(leaves)), pa.int32()), "body": pa.array(leaves, pa.string())})

    def join(table):
        enc = encoder(vocabulary)
        table = table.sort_by("leaf")
        ids = join_tree(table.column("ids").to_pylist(), enc)
        first = table.slice(0, 1)
        return pa.table({"row_key": first.column("row_key"), "copies": first.column("copies"), "ids": _list_array([ids])})

    short = rows.where(~is_long).mapInArrow(encode, f"row_key {kind}, ids array<int>")
    long = rows.where(is_long).groupBy("row_key", "body").agg(F.count("*").alias("copies")).withColumn("mark", F.md5("body"))
    leaves = long.mapInArrow(cut, f"row_key {kind}, copies bigint, mark string, leaf int, body string").repartition("row_key", "mark", "leaf")
    encoded = leaves.mapInArrow(encode, f"row_key {kind}, copies bigint, mark string, leaf int, ids array<int>")
    joined = encoded.groupBy("row_key", "mark").applyInArrow(join, f"row_key {kind}, copies bigint, ids array<int>")
    repeated = joined.select("row_key", "ids", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row_key", "ids")
    return short.unionByName(repeated).select(F.col("row_key").alias(id_col), "ids")


def token_counts(df: DataFrame, text_col: str = "text", vocabulary: str = VOCABULARY, into: str = "tokens") -> DataFrame:
    """``df`` without ``text_col`` and with ``into``, the number of tokens of the text (0 for null and empty)."""
    kept = [f for f in df.schema.fields if f.name not in (text_col, into)]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        for batch in batches:
            sizes = [len(enc.encode_ordinary(t)) if t else 0 for t in batch.column(text_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in kept), pa.array(sizes, pa.int64())], names=[*(f.name for f in kept), into])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), f"`{into}` bigint"])
    return df.select(*(F.col(f"`{f.name}`") for f in kept), text_col).mapInArrow(count, schema)
