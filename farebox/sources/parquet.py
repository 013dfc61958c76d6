"""Parquet reader: columnar, vectorised, with filter pushdown and column pruning."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    return spark.read.parquet(*paths)
