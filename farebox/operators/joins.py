"""Joins of a fact relation with small lookup relations.

Only a relation whose size is *measured* small is broadcast.  The check is
one aggregate pass over the lookup that counts its rows and sums their bytes
(fixed-width sizes plus the actual byte length of every string), combined
map-side so each task ships one partial row; the lookup is broadcast when it
has at most ``max_rows`` rows and at most ``max_bytes`` bytes.  Above either bound the join is a sort-merge
join (shuffle both sides; spills; AQE splits skewed partitions).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Session settings that override the bounds below.
MAX_ROWS_CONF = "farebox.broadcast.maxRows"
MAX_BYTES_CONF = "farebox.broadcast.maxBytes"
DEFAULT_MAX_BROADCAST_ROWS = 1_000_000
DEFAULT_MAX_BROADCAST_BYTES = 32 * 1024 * 1024

_FIXED_WIDTH = {
    T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.LongType: 8, T.FloatType: 4,
    T.DoubleType: 8, T.DateType: 4, T.TimestampType: 8, T.TimestampNTZType: 8, T.DecimalType: 16,
}


def max_broadcast_rows(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get(MAX_ROWS_CONF, str(DEFAULT_MAX_BROADCAST_ROWS)))


def max_broadcast_bytes(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get(MAX_BYTES_CONF, str(DEFAULT_MAX_BROADCAST_BYTES)))


def _row_bytes(df: DataFrame) -> Column | None:
    """Bytes of one row as a row-wise expression; None for nested types."""
    total: Column = F.lit(8)  # row header / null bits
    for field in df.schema.fields:
        width = _FIXED_WIDTH.get(type(field.dataType))
        if width is not None:
            total = total + F.lit(width + 8)  # value slot
        elif isinstance(field.dataType, (T.StringType, T.BinaryType)):
            total = total + F.lit(8) + F.coalesce(F.octet_length(F.col(f"`{field.name}`")), F.lit(0))
        else:
            return None
    return total


def fits_broadcast(df: DataFrame, max_rows: int | None = None, max_bytes: int | None = None) -> bool:
    """True when ``df`` has at most ``max_rows`` rows and ``max_bytes`` bytes.

    Meant for lookups (dimension scans, joins of small scans, checkpointed
    results): one narrow scan of the lookup with a map-side-combined count,
    so its cost follows the lookup's size, never the fact's, and no task
    receives more than one partial row per scan task.  (A ``limit`` before
    the count would not stop early on a cluster: every scan task would still
    run and send up to ``max_rows`` rows into the single task of the global
    limit.)  Measured at every call: a file overwritten in place keeps its name,
    so a remembered answer could let a grown lookup through.
    """
    max_rows = max_broadcast_rows(df) if max_rows is None else max_rows
    max_bytes = max_broadcast_bytes(df) if max_bytes is None else max_bytes
    width = _row_bytes(df)
    if width is None:
        return False
    seen = df.select(width.alias("_b")).agg(
        F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum("_b"), F.lit(0)).alias("bytes")).first()
    return seen["rows"] <= max_rows and seen["bytes"] <= max_bytes


def lookup_join(fact: DataFrame, lookup: DataFrame, on: Column | str | list[str], how: str = "inner",
                max_rows: int | None = None, small: bool | None = None) -> DataFrame:
    """Fact-dimension equi join; the fact side is never broadcast.

    ``small`` skips the size check when the caller already ran it.
    """
    if small is None:
        small = fits_broadcast(lookup, max_rows)
    return fact.join(lookup_side(lookup, small), on, how)


def lookup_side(lookup: DataFrame, small: bool) -> DataFrame:
    """The lookup with its join strategy: broadcast when proven small, else
    sort-merge -- so the planner cannot broadcast it from a file-size estimate
    (compressed Parquet sizes understate rows in memory)."""
    return F.broadcast(lookup) if small else lookup.hint("merge")


def role_playing_join(fact: DataFrame, lookup: DataFrame, lookup_key: str,
                      roles: list[tuple[str, str]], extra: Column | None = None,
                      max_rows: int | None = None, small: bool | None = None) -> DataFrame:
    """Join one lookup several times under role names.

    ``roles`` = [(fact key column, role alias), ...]; the lookup's columns are
    then addressable as ``alias.column``.  ``extra`` is added to the *last*
    join condition, so a cross-role equality (``pu.Borough == dz.Borough``)
    becomes a second equi key and an inequality a residual of that join.
    """
    if small is None:
        small = fits_broadcast(lookup, max_rows)
    out = fact
    for i, (fact_key, alias) in enumerate(roles):
        cond = F.col(fact_key) == F.col(f"{alias}.{lookup_key}")
        if extra is not None and i == len(roles) - 1:
            cond = cond & extra
        out = lookup_join(out, lookup.alias(alias), cond, small=small)
    return out
