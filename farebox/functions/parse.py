"""Lenient field parsing of comma-separated text lines, entirely in SQL functions.

A field that is missing (short line) or does not parse becomes null instead of
raising; callers then drop rows whose required fields are null.  ``get`` is
used rather than ``arr[i]`` because the latter raises under ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A plain decimal number (optional sign, digits, fraction, exponent) or a
# NaN/Infinity word.  It rejects Java-style type suffixes such as "1d"/"2f"
# that a string-to-double cast would otherwise accept.
_DOUBLE_TEXT = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:nan|inf|infinity))\s*$"


def fields(line: str | Column = "value", sep: str = ",") -> Column:
    """Split a line on ``sep`` with no quote handling (as the raw parsers do)."""
    return F.split(F.col(line) if isinstance(line, str) else line, sep, -1)


def to_int(text: Column) -> Column:
    """64-bit integer or null; "1.0" and "" are not integers."""
    return text.try_cast("bigint")


def to_double(text: Column) -> Column:
    """Double or null; accepts what a decimal literal looks like."""
    return F.when(text.rlike(_DOUBLE_TEXT), text.try_cast("double"))


# Four-digit year from 0001; month, day, hour, minute and second of one or two
# digits, seconds below 60.  Between date and time stands white space, and a
# one-digit day may have a blank before it.
_WALL_CLOCK_TEXT = r"^(?!0000)\d{4}-\d{1,2}-(\d{1,2}| [1-9])[\s\x1c-\x1f]+\d{1,2}:\d{1,2}:[0-5]?\d\z"
_PLAIN_GAP = r"^\S+ \S+$"


def to_wall_clock(text: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` as a zone-free TIMESTAMP_NTZ, or null.

    One-digit fields are taken as well (``2015-1-5 7:05:09``), as ``strptime``
    takes them, in ASCII digits.  No time zone is involved, so hour() is the
    written hour and differences are wall-clock differences in every session
    zone (no DST shifts); an impossible date such as Feb 30 gives null.
    """
    # The pattern pins the layout; the cast then only rejects impossible dates.
    gap = F.regexp_replace(F.regexp_replace(text, "- ", "-"), r"[\s\x1c-\x1f]+", " ")
    plain = F.when(text.rlike(_PLAIN_GAP), text).otherwise(gap)
    return F.when(text.rlike(_WALL_CLOCK_TEXT), plain.try_cast("timestamp_ntz"))


PARSERS = {"int": to_int, "double": to_double, "timestamp": to_wall_clock}
