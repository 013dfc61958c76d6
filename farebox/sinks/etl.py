"""CSV -> Parquet conversion job over several (name, source, destination) files.

Each file is converted on its own: a failure is recorded and the other files
still run.  The returned status frame counts the rows of every written
table (read back from Parquet, so it reflects what landed on storage).
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from farebox.functions.temporal import hour_name, with_stored_hour
from farebox.sinks.writers import write_parquet
from farebox.sources.csv import read_csv_inferred
from farebox.sources.schema_store import read_csv_remembered

STATUS_SCHEMA = StructType([
    StructField("name", StringType()),
    StructField("rows", LongType()),
    StructField("error", StringType()),
])


def _convert(spark: SparkSession, name: str, src: str, dst: str, files: int | None, schema, hour_of: str | None,
             remember: bool) -> DataFrame:
    if schema is not None:
        frame = spark.read.csv(src, header=True, schema=schema)
    else:
        frame = read_csv_remembered(spark, src) if remember else read_csv_inferred(spark, src)
    if hour_of is not None:
        frame = with_stored_hour(frame, hour_of)
    write_parquet(frame, dst, files=files, balance=True, cluster=hour_name(hour_of) if hour_of else None)
    return (spark.read.parquet(dst).groupBy().count()
            .select(F.lit(name).alias("name"), F.col("count").alias("rows"), F.lit(None).cast("string").alias("error")))


def csv_to_parquet(spark: SparkSession, jobs: list[tuple[str, str, str]], files: int | None = None,
                   schemas: dict | None = None, parallel: int = 4, hours: dict[str, str] | None = None,
                   remember: bool = False) -> DataFrame:
    """Convert each CSV (header; schema inferred unless given) to Parquet.

    Files are balanced in size (see ``write_parquet``) unless ``files`` says
    how many.  ``hours`` names, by table, a time column whose hour of day is
    stored as a column of its own; the rows are clustered by it, so a filter
    on the hour skips files and row groups.  ``remember`` keeps an inferred
    schema beside its source for the next run.

    Up to ``parallel`` files are converted at once (one Spark job each,
    submitted from separate driver threads), so many modest files keep the
    cluster busy; each file succeeds or fails on its own.
    """
    parts: list[DataFrame] = []
    failures: list[tuple[str, None, str]] = []
    with ThreadPoolExecutor(max_workers=max(1, min(parallel, len(jobs) or 1))) as pool:
        futures = [(name, pool.submit(_convert, spark, name, src, dst, files, (schemas or {}).get(name),
                                      (hours or {}).get(name), remember)) for name, src, dst in jobs]
        for name, future in futures:
            try:
                parts.append(future.result())
            except Exception as exc:  # one bad file must not stop the others
                failures.append((name, None, f"{type(exc).__name__}: {exc}"))
    status = spark.createDataFrame(failures, STATUS_SCHEMA)
    for part in parts:
        status = status.unionByName(part)
    return status
