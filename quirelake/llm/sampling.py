"""Bounded samples of different rows, drawn by the hash of their text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def draw(rows: DataFrame, text_col: str, size: int, more: list[str]) -> DataFrame:
    """At most ``size`` of the rows with a text, all if there are no more, with ``more`` columns and the hash of the text as ``spot``.

    Texts in many copies are drawn once for each different ``more``. The same
    rows are drawn each time: those with the least hashes. Each task keeps no
    more than ``size`` rows, and the texts are read for the drawn rows only.
    """
    keyed = rows.where(F.col(text_col).isNotNull()).withColumn("spot", F.xxhash64(text_col))
    picked = keyed.groupBy("spot", *more).agg(F.count("*").alias("copies")).orderBy("spot", *more).limit(size).drop("copies")
    found = keyed.join(F.broadcast(picked), ["spot", *more], "left_semi")
    return found.groupBy("spot", *more).agg(F.min(text_col).alias(text_col))
