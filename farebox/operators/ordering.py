"""Global sorts and top-k.  ``orderBy`` + ``limit`` plans as
``TakeOrderedAndProject`` (per-task top-k, then a k-row merge), so a top-k
never sorts the whole input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _spread_sort(df: DataFrame, order: list[Column]) -> DataFrame:
    """Global sort with a hash of the row as the last key.

    A range partitioner cannot split one key value, so a value holding a third
    of all rows would land in one sort task.  The hash makes the sort keys of
    different rows distinct, so equal values spread over the range partitions.
    It depends on the row alone: a retried task sorts its rows alike.
    """
    row = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    return df.withColumn("_row", row).orderBy(*order, F.col("_row").asc()).drop("_row")


def sort_asc(df: DataFrame, *keys: str) -> DataFrame:
    """Ascending, nulls first (Spark's default)."""
    return _spread_sort(df, [F.col(k).asc() for k in keys])


def sort_desc(df: DataFrame, measure: str, *tie_break: str) -> DataFrame:
    """Descending by ``measure`` (nulls last), then ascending tie-break keys."""
    return _spread_sort(df, [F.col(measure).desc(), *[F.col(k).asc() for k in tie_break]])


def top_k(df: DataFrame, k: int, order: list[Column]) -> DataFrame:
    """First ``k`` rows under a total ``order`` (give a tie-break, or row k varies)."""
    return df.orderBy(*order).limit(k)


def head(df: DataFrame, n: int, order: list[Column]) -> DataFrame:
    """Display preview: first ``n`` rows under a deterministic order."""
    return top_k(df, n, order)
