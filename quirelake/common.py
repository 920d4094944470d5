"""Helpers that every layer shares: reading tables, cutting lineage, ordered folds."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table ``name`` below ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def durable(df: DataFrame) -> DataFrame:
    """``df`` with its lineage cut, kept in the checkpoint folder all executors share.

    The folder is the session's ``spark.checkpoint.dir``. Only a local master may
    leave it unset: it takes a temporary folder, removed when Python ends. On a
    cluster a folder of one machine would be lost with it, so there it is an error.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not context.master.startswith("local"):
                raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="quirelake-checkpoint-")
            atexit.register(shutil.rmtree, folder, ignore_errors=True)
        context.setCheckpointDir(folder)
    return df.checkpoint()


#: Rows up to which a table of a few short columns is sent to every task.
SENT_ROWS = 200_000


def sent_if_small(df: DataFrame, rows: int = SENT_ROWS) -> DataFrame:
    """``df`` written once, and marked for broadcasting only where it turned out to have at most ``rows`` rows; beyond that it is joined by shuffle."""
    df = durable(df)
    return F.broadcast(df) if df.count() <= rows else df
