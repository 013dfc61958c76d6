"""Grouped aggregates.  All are decomposable, so Spark combines map-side
(partial HashAggregate) and only per-task partials cross the shuffle -- a hot
key costs one partial row per task, not a third of the table in one task."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Digits after the point that an exact sum keeps of each amount, and the bits
# of its lower half: 2^43 rows of a group fit before a half could overflow.
EXACT_DIGITS = 4
LOW_BITS = 20


def _keys(keys) -> list:
    return list(keys) if isinstance(keys, (list, tuple)) else [keys]


def count_by(df: DataFrame, keys, name: str = "count") -> DataFrame:
    """Row count per key; a null key is its own group."""
    return df.groupBy(*_keys(keys)).agg(F.count(F.lit(1)).alias(name))


def sum_by(df: DataFrame, keys, columns: list[tuple[str, str]]) -> DataFrame:
    """``sum`` of each (column, alias); nulls skipped, an all-null group gives null."""
    return df.groupBy(*_keys(keys)).agg(*[F.sum(c).alias(a) for c, a in columns])


def exact_parts(columns: list[tuple[str, str]], digits: int = EXACT_DIGITS) -> list[Column]:
    """Aggregates whose merge, in any order, is an exact sum of each (column, alias).

    A sum of doubles depends on the order of its rows, so on the partitioning.
    Here each amount is a whole number of units of 10^-``digits`` (rounded half
    to even), split into two integers that are summed apart: integer sums of
    whole-stage code, no decimal object a row.  Amounts of 2^53 units or more,
    infinities and NaN are summed as doubles.
    """
    out = []
    for column, alias in columns:
        scaled = f"rint(`{column}` * {float(10**digits)!r}D)"
        whole = f"abs({scaled}) < {1 << 53}D"
        units = f"CASE WHEN {whole} THEN CAST({scaled} AS BIGINT) END"
        out += [F.expr(f"sum(shiftright({units}, {LOW_BITS})) AS `{alias}_high`"),
                F.expr(f"sum({units} & {(1 << LOW_BITS) - 1}L) AS `{alias}_low`"),
                F.expr(f"sum(CASE WHEN NOT {whole} THEN `{column}` END) AS `{alias}_rest`")]
    return out


def merged_parts(names: list[str]) -> list[Column]:
    """The parts of ``exact_parts`` of several groups as those of their union."""
    return [F.expr(f"sum(`{name}_{part}`) AS `{name}_{part}`") for name in names for part in ("high", "low", "rest")]


def exact_total(name: str, digits: int = EXACT_DIGITS) -> Column:
    """The sum of one alias of ``exact_parts`` as double: the exact total, rounded once."""
    high, low, rest = (f"`{name}_{part}`" for part in ("high", "low", "rest"))
    units = f"(CAST({high} AS DECIMAL(25, 0)) * {1 << LOW_BITS} + CAST({low} AS DECIMAL(20, 0)))"
    total = f"CAST({units} * {Decimal(1).scaleb(-digits):f}BD AS DOUBLE)"
    return F.expr(f"CASE WHEN {high} IS NULL THEN {rest} ELSE {total} + coalesce({rest}, 0D) END AS `{name}`")


def exact_sum_by(df: DataFrame, keys, columns: list[tuple[str, str]], digits: int = EXACT_DIGITS) -> DataFrame:
    """Like ``sum_by``, bit-equal under every partitioning (see ``exact_parts``)."""
    ks = _keys(keys)
    parts = df.groupBy(*ks).agg(*exact_parts(columns, digits))
    return parts.select(*ks, *[exact_total(alias, digits) for _, alias in columns])


def avg_by(df: DataFrame, keys, columns: list[tuple[str, str]]) -> DataFrame:
    return df.groupBy(*_keys(keys)).agg(*[F.avg(c).alias(a) for c, a in columns])


def mean_from_sums(df: DataFrame, keys, columns: list[tuple[str, str]]) -> DataFrame:
    """Mean as explicit mergeable (sum, count) pairs, divided after the merge.

    Counts only rows where every averaged column is present, as a per-row
    (sum, sum, 1) triple does.
    """
    present = None
    for c, _ in columns:
        present = F.col(c).isNotNull() if present is None else present & F.col(c).isNotNull()
    sums = df.where(present).groupBy(*_keys(keys)).agg(
        *[F.sum(c).alias(f"_sum_{a}") for c, a in columns], F.count(F.lit(1)).alias("_n"))
    return sums.select(*_keys(keys), *[(F.col(f"_sum_{a}") / F.col("_n")).alias(a) for _, a in columns])


def max_by_key(df: DataFrame, keys, column: str | Column, name: str) -> DataFrame:
    col = F.col(column) if isinstance(column, str) else column
    return df.groupBy(*_keys(keys)).agg(F.max(col).alias(name))
