"""Row with the largest value per key.

* ``argmax_first`` -- one row per key, ties on the value broken by the largest
  ``tie``.  Two scans of the input, hash aggregates only, no sort, no join.
* ``argmax_ties`` -- every row that reaches its key's maximum, by a join with
  the maxima (or, ``method="rank"``, as ``rank() == 1``); null keys dropped.
* ``argmax_window`` -- ``row_number() == 1`` over a fully tie-broken order: one
  scan, but every task sorts its input.  Kept as a variant.

All forms are lazy: building one starts no job, and its result is that of the
source at the time of the action.  The first two share one idea: the least of
all per-key maxima is a single number, a scalar subquery that Spark runs
before the second scan, and no row below it can be a maximum of any key.  What
is left of the input is close to the result, so the aggregate or sort-merge
join behind it moves few rows.  With many keys of very different maxima the
number rules out less; the result is the same.

``at_most`` may give an upper bound of ``value`` that is cheaper to compute:
rows whose bound is below the number are dropped before the value is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _keys(keys) -> list:
    return list(keys) if isinstance(keys, (list, tuple)) else [keys]


def argmax_window(df: DataFrame, keys, order: list[Column], columns: list[str]) -> DataFrame:
    """One row per key (null key included): the first under ``order``."""
    w = Window.partitionBy(*_keys(keys)).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).select(*columns)


def maxima(df: DataFrame, keys, value: str, name: str = "_max_value") -> DataFrame:
    """(keys, largest value) of every key that has a value."""
    return df.groupBy(*_keys(keys)).agg(F.max(value).alias(name)).where(F.col(name).isNotNull())


def near_maximum(df: DataFrame, per_key: DataFrame, value: str, at_most: str | None = None,
                 name: str = "_max_value") -> DataFrame:
    """The rows of ``df`` not below the least of all per-key maxima: among them every row that reaches one."""
    least = per_key.agg(F.min(name)).scalar()
    if at_most is not None:
        df = df.where(F.col(at_most) >= least)
    return df.where(F.col(value) >= least)


def argmax_first(df: DataFrame, keys, value: str, tie: str, at_most: str | None = None) -> DataFrame:
    """(keys, value, tie) of the row with the largest ``value`` of each key
    (null key included), the largest ``tie`` among equals; a key without any
    value has no row."""
    ks = _keys(keys)
    near = near_maximum(df, maxima(df, ks, value), value, at_most)
    # Equal values become one row in their tasks, so a third of all rows may tie.
    best_ties = near.groupBy(*ks, value).agg(F.max(tie).alias(tie))
    return best_ties.groupBy(*ks).agg(F.max(value).alias("_best"), F.max_by(tie, value).alias(tie)).select(
        *ks, F.col("_best").alias(value), tie)


def argmax_ties(df: DataFrame, keys, value: str, columns: list[str], method: str = "join",
                at_most: str | None = None) -> DataFrame:
    """All rows whose ``value`` equals the per-key maximum; null keys dropped.

    ``method="join"`` joins the rows near a maximum to the per-key maxima: two
    scans.  ``method="rank"`` scans once, but sorts, and rows tied at a maximum
    meet in one task.
    """
    ks = _keys(keys)
    keyed = F.lit(True)
    for k in ks:
        keyed = keyed & F.col(k).isNotNull()
    keyed_rows = df.where(keyed)
    if method == "join":
        per_key = maxima(keyed_rows, ks, value)
        # Grouped apart from the rows, so the columns of both sides stay distinct.
        best = per_key.select(*[F.col(k).alias(f"_max_key_{i}") for i, k in enumerate(ks)], "_max_value")
        reached = F.col(value) == F.col("_max_value")
        for i, k in enumerate(ks):
            reached = reached & (F.col(k) == F.col(f"_max_key_{i}"))
        # Neither side has a proven bound: no broadcast from an estimate; AQE splits a value that many rows tie at.
        return near_maximum(keyed_rows, per_key, value, at_most).join(best.hint("merge"), reached).select(*columns)
    # Nulls sort last, so a null value reaches rank 1 only when the key has no
    # value at all; that row is dropped after the window.
    w = Window.partitionBy(*ks).orderBy(F.col(value).desc_nulls_last())
    ranked = keyed_rows.withColumn("_rk", F.rank().over(w))
    return ranked.where((F.col("_rk") == 1) & F.col(value).isNotNull()).select(*columns)
