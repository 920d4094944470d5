"""Judging images by their pixels, on Arrow batches."""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Words near an image by which its kind is known.
DIAGRAM_WORDS = ("diagram", "flowchart", "schematic", "architecture", "process")
TABLE_WORDS = ("table", "tabelle", "grid", "matrix")


def read_png(data: bytes) -> np.ndarray | None:
    """Pixels ``(height, width, channels)`` of an 8-bit PNG that is not interlaced; None for other data."""
    if not data or data[:8] != b"\x89PNG\r\n\x1a\n":
        return None
    at, packed, head = 8, b"", None
    while at + 8 <= len(data):
        size, kind = struct.unpack(">I4s", data[at : at + 8])
        body = data[at + 8 : at + 8 + size]
        head = struct.unpack(">IIBBBBB", body) if kind == b"IHDR" else head
        packed += body if kind == b"IDAT" else b""
        at += 12 + size
    channels = {0: 1, 2: 3, 4: 2, 6: 4}.get(head[3]) if head else None
    if channels is None or head[2] != 8 or head[6]:
        return None
    width, height = head[0], head[1]
    rows = np.frombuffer(zlib.decompress(packed), np.uint8).reshape(height, 1 + width * channels)
    out = np.zeros((height, width * channels), np.int64)
    for y, (rule, line) in enumerate(zip(rows[:, 0], rows[:, 1:].astype(np.int64), strict=True)):
        above = out[y - 1] if y else np.zeros_like(line)
        if rule in (0, 2):
            out[y] = (line + (above if rule == 2 else 0)) % 256
            continue
        for x in range(len(line)):
            a, c = (out[y, x - channels], above[x - channels]) if x >= channels else (0, 0)
            b = above[x]
            guess = a + b - c
            nearest = min((abs(guess - a), 0, a), (abs(guess - b), 1, b), (abs(guess - c), 2, c))[2]
            out[y, x] = (line[x] + (a if rule == 1 else (a + b) // 2 if rule == 3 else nearest)) % 256
    return out.reshape(height, width, channels)


# Contrast, edge density and shape of diagrams, the step that makes an edge, the part of the most edges that makes a line, and lines of a table in both directions.
CONTRAST, EDGES, WIDE, STEP, LINE, LINES = 50, (0.05, 0.3), 1.2, 30, 0.3, (3, 2)


def judge_pixels(pixels: np.ndarray) -> str:
    """``diagram`` by contrast, edges and shape, else ``table`` by lines, else ``image``, whether full of text or not."""
    gray = pixels[:, :, : 3 if pixels.shape[2] >= 3 else 1].mean(axis=2)
    height, width = gray.shape
    edges = np.zeros_like(gray)
    if height > 1 and width > 1:
        edges[:-1, :-1] = (np.abs(np.diff(gray, axis=1))[:-1] + np.abs(np.diff(gray, axis=0))[:, :-1]) > STEP
    if sum(map(bool, (gray.std() > CONTRAST, EDGES[0] < edges.mean() < EDGES[1], width / height > WIDE))) >= 2:
        return "diagram"

    def lines(axis: int) -> int:
        total = edges.sum(axis=axis)
        return int((np.diff((total > total.max() * LINE).astype(int)) > 0).sum())

    return "table" if lines(0) > LINES[0] and lines(1) > LINES[1] else "image"


def element_type(data: Column, context: Column) -> Column:
    """The element type of image bytes; words of the text around come before the pixels. ``image`` for what cannot be read."""

    @F.pandas_udf("string")
    def judge(images: pd.Series) -> pd.Series:
        def one(raw: bytes | None) -> str:
            try:
                pixels = read_png(raw)
            except (ValueError, zlib.error, struct.error):
                pixels = None
            return "image" if pixels is None else judge_pixels(pixels)

        return images.map(one)

    low = F.lower(F.coalesce(context, F.lit("")))
    near = lambda words: F.exists(F.array(*map(F.lit, words)), lambda w: F.contains(low, w))
    return F.when(near(DIAGRAM_WORDS), "diagram").when(near(TABLE_WORDS), "table").otherwise(judge(data))
