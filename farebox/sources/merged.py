"""One table from files whose schemas differ.

Monthly files of one and the same table drift: a column changes the case of
its name (``airport_fee`` / ``Airport_fee``), its type (an integer that later
files hold as double), its place, or is missing in older files.  Columns are
matched by name without case; the first file's spelling and order count,
further columns follow.  Types are widened to one that holds all values of
both (see ``wider``).  Files of equal schema are read together, so a scan per
distinct schema, not per file, is united, and filters and column pruning reach
every scan.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farebox.sources.csv import read_csv_inferred

# Each numeric type holds the values of those before it; long to double and
# decimal to double keep about 15 digits.
_NUMBERS = [T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType]
_EXACT_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}


def wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type for a column that is ``a`` in one file and ``b`` in another.

    Numbers widen to the wider one (an integer of 32 bits or more and a float
    to double; integers and decimals to a decimal of enough digits, or double
    if there is none), dates to timestamps, an all-null column to the other
    side; anything else is read as text.
    """
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if type(a) in _NUMBERS and type(b) in _NUMBERS:
        low, high = sorted((a, b), key=lambda t: _NUMBERS.index(type(t)))
        exact = not isinstance(high, T.FloatType) or isinstance(low, (T.ByteType, T.ShortType))
        return high if exact else T.DoubleType()
    if isinstance(a, T.DecimalType) or isinstance(b, T.DecimalType):
        sides = [t if isinstance(t, T.DecimalType) else T.DecimalType(_EXACT_DIGITS[type(t)], 0)
                 for t in (a, b) if isinstance(t, T.DecimalType) or type(t) in _EXACT_DIGITS]
        if len(sides) == 2:
            scale = max(t.scale for t in sides)
            whole = max(t.precision - t.scale for t in sides)
            return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else T.DoubleType()
        if all(isinstance(t, (T.DecimalType, T.FloatType, T.DoubleType)) for t in (a, b)):
            return T.DoubleType()
    times = {T.DateType, T.TimestampType, T.TimestampNTZType}
    if {type(a), type(b)} <= times:
        return next(t for t in (a, b) if not isinstance(t, T.DateType)) if T.DateType in (type(a), type(b)) else T.TimestampType()
    return T.StringType()


def merged_schema(schemas: list[T.StructType]) -> T.StructType:
    """Columns of all schemas, matched without case, each of a type that holds all its values."""
    fields: dict[str, T.StructField] = {}
    for schema in schemas:
        seen = [f.name.lower() for f in schema.fields]
        if len(set(seen)) < len(seen):
            raise ValueError(f"columns of one file differ in case only: {schema.names}")
        for f in schema.fields:
            known = fields.get(f.name.lower())
            fields[f.name.lower()] = T.StructField(f.name, f.dataType) if known is None else T.StructField(
                known.name, wider(known.dataType, f.dataType))
    return T.StructType(list(fields.values()))


def _conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    own = {c.lower(): c for c in df.columns}
    return df.select(*[(F.col(f"`{own[f.name.lower()]}`") if f.name.lower() in own else F.lit(None)).cast(f.dataType).alias(f.name)
                       for f in schema.fields])


def read_merged(spark: SparkSession, paths: list[str], fmt: str = "parquet",
                read: Callable[[SparkSession, str], DataFrame] | None = None) -> DataFrame:
    """The rows of all ``paths`` (files or folders of Parquet, or CSV with a
    header) under one schema; a column that a file lacks is null there."""
    read = read or (read_csv_inferred if fmt == "csv" else lambda s, p: s.read.parquet(p))
    frames = [read(spark, path) for path in paths]
    if not frames:
        raise ValueError("no paths")
    alike: dict[str, list[int]] = {}
    for i, frame in enumerate(frames):
        alike.setdefault(frame.schema.json(), []).append(i)
    schema = merged_schema([f.schema for f in frames])
    groups = []
    for members in alike.values():
        first = frames[members[0]]
        if len(members) == 1:
            groups.append(first)
            continue
        reader = spark.read.schema(first.schema)
        own = [paths[i] for i in members]
        groups.append(reader.csv(own, header=True) if fmt == "csv" else reader.parquet(*own))
    return reduce(DataFrame.unionByName, [_conform(g, schema) for g in groups])
