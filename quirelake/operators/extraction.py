"""Triples from texts by an outside model, in batches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirelake.common import durable
from quirelake.functions import prompts
from quirelake.sources import doctags, models

#: Characters of the text that are kept with what was made of it.
SOURCE_CHARS = 200


def extract_triples(chunks: DataFrame, key: str, text_col: str, model: Callable[[str], str], most: int = 50, language: str = "de", ontology: str | None = None, attempts: int = 3, wait: float = 2.0) -> tuple[DataFrame, DataFrame]:
    """The triples that a model finds in texts, and what became of each text.

    Triples: ``(key, subject, predicate, object, confidence, source_chunk)``.
    Texts: ``(key, success, error, triple_count, average_confidence, seconds)``,
    one row each: a call that fails to the end, or a response without triples
    in it, is a row without success. Null texts are not sent and have neither
    success nor error. Every text is sent once.
    """
    asked = chunks.select(key, F.substring(text_col, 1, SOURCE_CHARS).alias("source_chunk"), prompts.extraction(F.col(text_col), most, language, ontology).alias("prompt"))
    # Written once, so that no text is sent again for the second result or after a loss.
    answered = durable(models.call(asked, model, "prompt", attempts=attempts, wait=wait).drop("prompt"))
    triples = doctags.extraction_triples(answered, key, "response", most)
    counted = triples.groupBy(key).agg(F.count("*").alias("triple_count"), F.round(F.avg("confidence"), 6).alias("average_confidence"))
    readable = F.get_json_object(doctags.json_of(F.col("response")), "$.triples").isNotNull()
    texts = answered.join(counted, key, "left").select(
        key, (F.col("error").isNull() & F.coalesce(readable, F.lit(False))).alias("success"), F.coalesce("error", F.when(F.col("response").isNotNull() & ~F.coalesce(readable, F.lit(False)), "the response holds no triples")).alias("error"),
        F.coalesce("triple_count", F.lit(0)).alias("triple_count"), "average_confidence", "seconds",
    )
    return triples.join(answered.select(key, "source_chunk"), key), texts
