"""Mixing sources to target weights by balanced sampling.

Every document of a source is wanted ``r = wanted tokens / tokens of the source``
times, at most ``max_repeats``. The whole part of ``r`` is given to all its
documents; for the fraction the cube method picks documents so that both the
number of documents and the sum of tokens come out as wanted: inclusion
probabilities move along the null space of those two constraints until they are
0 or 1, large documents first. The flight runs in blocks of bounded size, what a block leaves
undecided is gathered into the blocks of the next level, and the one or two
units left at the end of a source are rounded by the landing, whose miss is
taken back by swapping documents of fitting sizes.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quirelake.common import durable
from quirelake.llm.tokens import VOCABULARY, token_counts

#: Documents in a block of the flight phase.
BLOCK = 4096
_EPS = 1e-9


def source_key(source: Column) -> Column:
    """The one spelling of a source: lower case, without outer blanks, ``_`` for ``-``."""
    return F.regexp_replace(F.lower(F.trim(source)), "-", "_")


def flight(p: np.ndarray, sizes: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Probabilities after the flight phase, balanced on the sum of ``sizes`` and on the number of units.

    Three undecided units at a time move along the vector orthogonal to their
    sizes and to ones, up or down with the odds that keep every probability
    true on average, until one of them is decided. At most two units stay
    undecided.
    """
    q, size, draws = p.tolist(), sizes.tolist(), rng.random(len(p) + 2).tolist()
    active: list[int] = []
    for k, start in enumerate(q):
        if not _EPS < start < 1 - _EPS:
            continue
        active.append(k)
        while len(active) == 3:
            i, j, m = active
            u = (size[j] - size[m], size[m] - size[i], size[i] - size[j])
            if u == (0, 0, 0):
                u = (1.0, -1.0, 0.0)
            up = min((1 - q[n]) / v if v > 0 else q[n] / -v for n, v in zip(active, u, strict=True) if v)
            down = min(q[n] / v if v > 0 else (1 - q[n]) / -v for n, v in zip(active, u, strict=True) if v)
            step = up if (draws.pop() if draws else rng.random()) * (up + down) < down else -down
            for n, v in zip(active, u, strict=True):
                moved = q[n] + step * v
                q[n] = 0.0 if moved < _EPS else 1.0 if moved > 1 - _EPS else moved
            active = [n for n in active if 0.0 < q[n] < 1.0]
    return np.array(q)


def land(p: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The undecided units rounded so that the sums of the sizes stay nearest to the wanted ones."""
    p = p.copy()
    open_ = [k for k in range(len(p)) if 0 < p[k] < 1]
    scale = np.maximum(x.max(axis=0), 1) if len(x) else 1
    best, choice = math.inf, ()
    for bits in range(2 ** len(open_)):
        picked = [bits >> n & 1 for n in range(len(open_))]
        off = sum((b - p[k]) * x[k] / scale for b, k in zip(picked, open_, strict=True)) if open_ else 0
        miss = float(np.abs(off).dot([1, 1e-3])) if open_ else 0.0
        if miss < best:
            best, choice = miss, picked
    for k, b in zip(open_, choice, strict=True):
        p[k] = b
    return p


def settle(p: np.ndarray, sizes: np.ndarray, wanted: float, swaps: int = 3) -> np.ndarray:
    """Decided units with the miss of the landing taken back by swapping a drawn unit for one not drawn.

    A swap keeps the number of units. Each time the pair is taken whose
    difference in size is nearest to the miss, as long as that lessens it.
    """
    p = p.copy()
    for _ in range(swaps):
        miss = float((p * sizes).sum() - wanted)
        drawn, rest = np.flatnonzero(p >= 1), np.flatnonzero(p <= 0)
        if not len(drawn) or not len(rest):
            break
        rest = rest[np.argsort(sizes[rest], kind="stable")]
        at = np.searchsorted(sizes[rest], sizes[drawn] - miss)
        near = np.stack([np.clip(at - 1, 0, len(rest) - 1), np.clip(at, 0, len(rest) - 1)])
        left = np.abs(miss - (sizes[drawn] - sizes[rest[near]]))
        row, k = np.unravel_index(np.argmin(left), left.shape)
        if left[row, k] >= abs(miss):
            break
        p[drawn[k]], p[rest[near[row, k]]] = 0.0, 1.0
    return p


def _fly(pdf: pd.DataFrame, last: bool) -> pd.DataFrame:
    # Large documents first, so that they trade with others of their size.
    pdf = pdf.sort_values(["tokens", "spot", "doc_id"], ascending=[False, True, True], kind="stable", ignore_index=True)
    open_ = pdf.p.between(_EPS, 1 - _EPS).to_numpy()
    x = np.stack([pdf.tokens.to_numpy(float), np.ones(len(pdf))], axis=1)
    p = pdf.p.to_numpy(float).copy()
    if open_.any():
        p[open_] = flight(p[open_], x[open_, 0], np.random.default_rng(abs(int(pdf.spot.iloc[0])) % 2**32))
        if last:
            wanted = float((pdf.p.to_numpy(float) * x[:, 0]).sum())
            p[open_] = settle(land(p[open_], x[open_]), x[open_, 0], wanted - float((p * x[:, 0])[~open_].sum()))
    return pdf.assign(p=p)


def _flier(last: bool):
    return lambda pdf: _fly(pdf.drop(columns="block"), last)


def mix_sources(documents: DataFrame, targets: DataFrame, vocabulary: str = VOCABULARY, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """The mixture ``(doc_id, source, tokens, repeats)`` and the report on each target source.

    ``documents`` has ``doc_id``, ``text`` and ``source``; ``targets`` has
    ``source``, ``target_share`` and ``max_repeats``, one row a source (the
    first by value where one is repeated). Rows of sources not listed, or whose
    source is null, are in no mixture. Null and empty texts have no tokens and
    are drawn like others, since they count as documents. The wanted total is
    the tokens of the listed sources, each document once; what a source cannot
    give within ``max_repeats`` is not given to others but shown as the share
    it really has. Repeated doc_ids are separate documents. The report
    ``(source, target_share, max_repeats, n_documents, source_tokens,
    wanted_tokens, used_documents, used_tokens, actual_share)`` has also the
    listed sources without documents.
    """
    wanted = targets.select(source_key(F.col("source")).alias("source"), "target_share", "max_repeats").where("source IS NOT NULL")
    wanted = wanted.groupBy("source").agg(F.min("target_share").alias("target_share"), F.min("max_repeats").alias("max_repeats"))
    listed = documents.select("doc_id", "text", source_key(F.col("source")).alias("source")).join(F.broadcast(wanted.select("source")), "source", "left_semi")
    sized = durable(token_counts(listed.select("doc_id", "source", "text"), vocabulary=vocabulary))
    totals = sized.groupBy("source").agg(F.sum("tokens").alias("source_tokens"), F.count("*").alias("n_documents"))
    # One row a listed source: the plan of the whole mixture, as small as the table of targets.
    plan = wanted.join(totals, "source", "left").na.fill(0, ["source_tokens", "n_documents"]).toPandas().sort_values("source", ignore_index=True)
    total = int(plan.source_tokens.sum())
    plan["wanted_tokens"] = plan.target_share.fillna(0.0) * total
    caps = plan.max_repeats.fillna(0).clip(lower=0).astype(float)
    rate = np.where(plan.source_tokens > 0, plan.wanted_tokens / plan.source_tokens.clip(lower=1), 0.0)
    rate = np.minimum(rate, caps)
    plan["base"], plan["fraction"] = np.floor(rate).astype(int), rate - np.floor(rate)
    spark = documents.sparkSession
    rates = spark.createDataFrame(plan[["source", "base", "fraction"]], "source string, base bigint, fraction double")

    spot = F.xxhash64("doc_id", "source", "tokens")
    units = sized.join(F.broadcast(rates), "source").select("doc_id", "source", "tokens", "base", F.col("fraction").alias("p"), spot.alias("spot"))
    decided = units.where(f"p <= {_EPS}").withColumn("p", F.lit(0.0))
    left, done = units.where(f"p > {_EPS}"), []
    schema = left.schema.simpleString()[len("struct<") : -1].replace(":", " ")
    remaining = max([0, *plan.n_documents[plan.fraction > _EPS]])
    while True:
        last = remaining <= block
        n_blocks = max(1, math.ceil(remaining / block))
        keyed = left.withColumn("block", F.pmod(F.col("spot"), F.lit(n_blocks)))
        flown = keyed.groupBy("source", "block").applyInPandas(_flier(last), schema)
        if last:
            done.append(flown)
            break
        flown = durable(flown)
        done.append(flown.where("p <= 0 OR p >= 1"))
        left, remaining = flown.where("p > 0 AND p < 1"), 2 * n_blocks
        # Another spread of the rest over the blocks of the next level.
        left = left.withColumn("spot", F.xxhash64("spot", F.lit(n_blocks)))
    mixture = decided
    for part in done:
        mixture = mixture.unionByName(part)
    mixture = mixture.select("doc_id", "source", "tokens", (F.col("base") + F.col("p").cast("bigint")).alias("repeats")).where("repeats > 0")
    used = mixture.groupBy("source").agg(F.sum("repeats").alias("used_documents"), F.sum(F.col("repeats") * F.col("tokens")).alias("used_tokens"))
    head = spark.createDataFrame(
        plan[["source", "target_share", "max_repeats", "n_documents", "source_tokens", "wanted_tokens"]],
        "source string, target_share double, max_repeats int, n_documents bigint, source_tokens bigint, wanted_tokens double",
    )
    report = head.join(F.broadcast(used), "source", "left").na.fill(0, ["used_documents", "used_tokens"])
    # A window over as many rows as there are targets.
    whole = F.sum("used_tokens").over(Window.partitionBy(F.lit(1)))
    return mixture, report.withColumn("actual_share", F.coalesce(F.try_divide("used_tokens", whole), F.lit(0.0)))
