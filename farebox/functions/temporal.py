"""Time expressions: hour of day, elapsed minutes, wrap-around hour ranges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hour_of(ts: str | Column) -> Column:
    """Hour of day (0-23) in the session zone; wall-clock hour for TIMESTAMP_NTZ."""
    return F.hour(_col(ts))


def minutes_between(start: str | Column, end: str | Column) -> Column:
    """Elapsed minutes as double: whole epoch seconds difference / 60."""
    return (F.unix_timestamp(_col(end)) - F.unix_timestamp(_col(start))) / F.lit(60.0)


def add_seconds(ts: str | Column, seconds: str | Column) -> Column:
    """``ts`` shifted by an integral number of seconds (keeps the timestamp flavour)."""
    return F.timestamp_add("SECOND", _col(seconds), _col(ts))


def pickup_before_dropoff(pickup: str | Column, dropoff: str | Column) -> Column:
    return _col(pickup) < _col(dropoff)


def in_wrapped_range(h: Column, start_hour: int, end_hour: int) -> Column:
    """``h`` in ``[start_hour, end_hour)``, a range that may wrap midnight."""
    if start_hour <= end_hour:
        return (h >= start_hour) & (h < end_hour)
    return (h >= start_hour) | (h < end_hour)


def hour_in_wrapped_range(ts: str | Column, start_hour: int, end_hour: int) -> Column:
    """Hour of ``ts`` in ``[start_hour, end_hour)`` where the range may wrap midnight.

    ``(23, 7)`` is 23:00-06:59.  A null timestamp gives null (the row drops).
    """
    return in_wrapped_range(hour_of(ts), start_hour, end_hour)


def _zone(df: DataFrame, ts: str) -> str:
    """The zone that the hour of ``ts`` depends on; none for a wall-clock time."""
    wall_clock = isinstance(df.schema[ts].dataType, TimestampNTZType)
    return "none" if wall_clock else df.sparkSession.conf.get("spark.sql.session.timeZone")


def hour_name(ts: str) -> str:
    return f"{ts}_hour"


def with_stored_hour(df: DataFrame, ts: str) -> DataFrame:
    """``df`` with the hour of ``ts`` as a column of its own.

    A filter on ``hour(ts)`` cannot reach a Parquet scan, one on this column
    can.  The column's metadata, which Parquet files keep, say which column and
    which session zone it was taken from.
    """
    marks = {"hour_of": ts, "time_zone": _zone(df, ts)}
    return df.withColumn(hour_name(ts), hour_of(ts)).withMetadata(hour_name(ts), marks)


def stored_hour(df: DataFrame, ts: str) -> Column:
    """The hour of ``ts``: the stored column if ``df`` has it and it was taken
    in the zone of this session, else computed."""
    for field in df.schema.fields:
        if field.name == hour_name(ts) and field.metadata == {"hour_of": ts, "time_zone": _zone(df, ts)}:
            return F.col(field.name)
    return hour_of(ts)
