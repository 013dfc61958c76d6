"""CSV readers: a fixed positional schema, or header + inferred schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from farebox.schemas import TRIP_SCHEMA


def read_csv_with_schema(spark: SparkSession, path: str, schema: StructType = TRIP_SCHEMA,
                         check_header: bool = False) -> DataFrame:
    """Header line skipped, columns bound **by position** to ``schema``.

    PERMISSIVE mode: a bad cell becomes null, the row stays.  With
    ``check_header`` the read fails when the header names differ from the
    schema instead of silently binding by position.
    """
    reader = spark.read.format("csv").option("header", "true").schema(schema)
    if check_header:
        reader = reader.option("enforceSchema", "false")
    return reader.load(path)


def read_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """Header names + inferred types.  Inference is an extra pass over all of
    the data (types from a sample would turn cells that do not fit into nulls);
    prefer an explicit schema or Parquet for large inputs."""
    return spark.read.csv(path, header=True, inferSchema=True, samplingRatio=1.0)
