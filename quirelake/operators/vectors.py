"""Similarity of embedding vectors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def top_similar(vectors: DataFrame, query: list[float], k: int = 10, least: float = 0.0, id_col: str = "vec_id", vector_col: str = "embedding", condition: Column | None = None, among: DataFrame | None = None) -> DataFrame:
    """The ``k`` vectors most like ``query`` by cosine of at least ``least``, ties by id. Null vectors and those of length 0 are left out.

    With ``condition`` only rows it holds for are searched, with ``among`` only
    those whose values are in this table under the same names, such as ids of
    documents; both before anything is scored.

    One pass over the table; only each partition's best ``k`` meet.
    """
    q = F.array(*(F.lit(float(x)) for x in query))
    size = float(sum(x * x for x in query)) ** 0.5
    score = F.round(F.try_divide(dot(F.col(vector_col), q), norm(F.col(vector_col)) * size), 6)
    if condition is not None:
        vectors = vectors.where(condition)
    if among is not None:
        vectors = vectors.join(among.distinct(), among.columns, "left_semi")
    return vectors.select(*(c for c in vectors.columns if c != vector_col), score.alias("score")).where(F.col("score") >= least).orderBy(F.desc("score"), id_col).limit(k)
