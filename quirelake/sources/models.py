"""Calling an outside model on rows, with retries inside the task."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def call(df: DataFrame, function: Callable[[str], str], prompt_col: str, into: str = "response", attempts: int = 3, wait: float = 2.0, longest: float = 10.0) -> DataFrame:
    """``df`` with ``into``, ``error`` and ``seconds``: what the function made of each prompt.

    A call that raises is tried again after a wait that doubles up to
    ``longest``; what fails to the end is null with its error, and other rows
    go on. A null prompt is not sent.
    """
    kept = [f for f in df.schema.fields if f.name not in (into, "error", "seconds")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            responses, errors, seconds = [], [], []
            for prompt in pdf[prompt_col]:
                began, response, error = time.monotonic(), None, None
                for attempt in range(attempts if prompt is not None else 0):
                    try:
                        response, error = function(prompt), None
                        break
                    except Exception as raised:
                        error = f"{type(raised).__name__}: {raised}"
                        if attempt + 1 < attempts:
                            time.sleep(min(longest, wait * 2**attempt))
                responses.append(response)
                errors.append(error)
                seconds.append(time.monotonic() - began)
            yield pdf.assign(**{into: responses, "error": errors, "seconds": seconds})

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), f"`{into}` string, error string, seconds double"])
    return df.select(*(F.col(f"`{f.name}`") for f in kept)).mapInPandas(run, schema)
