"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from farebox.session import scratch_path

# Rows turned into Python objects at a time; bounds the memory of a text pass.
ROWS_AT_ONCE = 128

# Bytes of a batch that goes to a Python worker.  Spark's own bound is 64 MB,
# several times of which a worker and its task hold at once.
BATCH_BYTES = 6 << 20
BATCH_BYTES_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded(df: DataFrame) -> DataFrame:
    """``df``, whose session from now on sends texts to Python in batches of
    BATCH_BYTES (the one setting this package changes; a smaller one stays)."""
    conf = df.sparkSession.conf
    if int(re.sub(r"\D", "", conf.get(BATCH_BYTES_KEY, None) or str(1 << 40))) > BATCH_BYTES:
        conf.set(BATCH_BYTES_KEY, str(BATCH_BYTES))
    return df


def utf8_values(column: pa.Array) -> Iterator[bytes | None]:
    """The UTF-8 bytes of a string column, a few rows at a time."""
    raw = column.cast(pa.binary())
    for start in range(0, len(raw), ROWS_AT_ONCE):
        yield from raw.slice(start, ROWS_AT_ONCE).to_pylist()


def struct_array(rows: list[tuple], kind: T.StructType) -> pa.Array:
    """Python rows as an Arrow struct column of the Spark type ``kind``."""
    columns = list(zip(*rows)) or [()] * len(kind)
    arrow = to_arrow_type(kind)
    return pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)],
                                      names=[f.name for f in kind])


def fresh_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base = "_" + base
    return base


def materialise(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the session's shared checkpoint folder:
    computed once, lineage cut, safe when an executor is lost."""
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(modulus: int, id_col: str = "doc_id") -> Column:
    """crc32 of the document id as text, modulo ``modulus``."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % modulus
