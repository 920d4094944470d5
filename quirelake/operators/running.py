"""Running aggregates inside groups that may be too large for one task.

A group's rows are cut into buckets of neighbouring positions. Buckets are
aggregated first, the few rows of buckets get their running value, and the
rest of the work is a window inside each bucket.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Positions in a bucket.
BUCKET = 4096


def _combine(how: str, before: Column, inside: Column) -> Column:
    if how == "last":
        return F.coalesce(inside, before)
    if how == "min":
        return F.least(before, inside)
    return F.coalesce(before, F.lit(0)) + F.coalesce(inside, F.lit(0))


_WITHIN: dict[str, Callable[[Column], Column]] = {"last": lambda v: F.last(v, ignorenulls=True), "min": F.min, "sum": F.sum}


def running(df: DataFrame, keys: list[str], position: str, order: list[Column], value: Column, into: str, how: str, bucket: int = BUCKET) -> DataFrame:
    """``df`` with ``into``: the ``last`` non-null, ``min`` or ``sum`` of ``value`` over the rows before each row of its group.

    ``order`` is a total order that begins with ``position``, an integer column;
    null positions come first. Null where nothing came before (0 for sums).
    """
    rows = df.withColumn("_run_bucket", F.floor(F.coalesce(F.col(position), F.lit(-1)) / bucket)).withColumn("_run_value", value)
    inside = Window.partitionBy(*keys, "_run_bucket").orderBy(*order)
    # Every bucket has a row, also one without any value, so the rows are read twice and no more: plans of nested calls double with each.
    whole = F.max_by("_run_value", F.when(F.col("_run_value").isNotNull(), F.struct(*order_keys(order)))) if how == "last" else _WITHIN[how](F.col("_run_value"))
    sums = rows.groupBy(*keys, "_run_bucket").agg(whole.alias("_run_whole"))
    earlier = Window.partitionBy(*keys).orderBy("_run_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = sums.select(*keys, "_run_bucket", _WITHIN[how](F.col("_run_whole")).over(earlier).alias("_run_before"))
    same = reduce(lambda a, b: a & b, [F.col(f"r.{k}").eqNullSafe(F.col(f"c.{k}")) for k in [*keys, "_run_bucket"]])
    local = _WITHIN[how](F.col("_run_value")).over(inside.rowsBetween(Window.unboundedPreceding, -1))
    joined = rows.withColumn("_run_inside", local).alias("r").join(carried.alias("c"), same).select("r.*", "c._run_before")
    return joined.withColumn(into, _combine(how, F.col("_run_before"), F.col("_run_inside"))).drop("_run_bucket", "_run_value", "_run_inside", "_run_before")


def before(df: DataFrame, keys: list[str], position: str, order: list[Column], value: Column, into: str, n: int, bucket: int = BUCKET) -> DataFrame:
    """``df`` with ``into``: an array of ``value`` in the up to ``n`` rows before each row of its group, the nearest last; values may be null.

    A bucket holds a bounded number of positions, so the last rows of a bucket
    are picked from all of its own. Every bucket has a row, so the ``n`` buckets
    before one hold all the rows that its first ones look back to.
    """
    rows = df.withColumn("_lag_bucket", F.floor(F.coalesce(F.col(position), F.lit(-1)) / bucket)).withColumn("_lag_value", F.struct(value.alias("v")))
    inside = Window.partitionBy(*keys, "_lag_bucket").orderBy(*order)
    tail = F.transform(F.array_sort(F.collect_list(F.struct(*order_keys(order), "_lag_value"))), lambda x: x["_lag_value"])
    tails = rows.groupBy(*keys, "_lag_bucket").agg(F.slice(F.reverse(tail), 1, n).alias("_lag_tail"))
    w = Window.partitionBy(*keys).orderBy("_lag_bucket").rowsBetween(-n, -1)
    carried = tails.select(*keys, "_lag_bucket", F.slice(F.flatten(F.reverse(F.collect_list("_lag_tail").over(w))), 1, n).alias("_lag_carried"))
    same = reduce(lambda a, b: a & b, [F.col(f"r.{k}").eqNullSafe(F.col(f"c.{k}")) for k in [*keys, "_lag_bucket"]])
    near = F.collect_list("_lag_value").over(inside.rowsBetween(-n, -1))
    joined = rows.withColumn("_lag_near", near).alias("r").join(carried.alias("c"), same).select("r.*", "c._lag_carried")
    missing = F.greatest(F.lit(0), F.lit(n) - F.size("_lag_near"))
    both = F.concat(F.reverse(F.slice("_lag_carried", F.lit(1), missing)), F.col("_lag_near"))
    return joined.withColumn(into, F.transform(both, lambda x: x["v"])).drop("_lag_bucket", "_lag_value", "_lag_near", "_lag_carried")


def order_keys(order: list[Column]) -> list[Column]:
    """The plain columns of an ascending order, nulls first."""
    return [F.col(c) if isinstance(c, str) else c for c in order]
