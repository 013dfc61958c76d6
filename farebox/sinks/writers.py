"""Writers for results and converted tables.

Outputs keep Spark's natural parallelism (one file per task) unless a file
count or balanced files are asked for.  A single file is written after ``repartition(1)``: only
the writing is one task, the stages before it keep theirs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farebox.session import app_id

# Fixed value: timestamp layout of the raw trip files.
TRIP_TS_FORMAT = "yyyy-MM-dd HH:mm:ss"


def run_scoped_path(spark: SparkSession, base: str, name: str) -> str:
    """``<base>/<name>_<applicationId>`` -- one output folder per run."""
    return f"{base.rstrip('/')}/{name}_{app_id(spark)}"


def _csv_writer(df: DataFrame, mode: str, header: bool):
    return (df.write.mode(mode).option("header", str(header).lower())
            .option("timestampFormat", TRIP_TS_FORMAT).option("timestampNTZFormat", TRIP_TS_FORMAT))


def _one_file(df: DataFrame, order: list[str] | None) -> DataFrame:
    """All rows in one partition, in the given order."""
    one = df.repartition(1)
    return one.sortWithinPartitions(*order) if order else one


def write_csv_single(df: DataFrame, path: str, header: bool = True, mode: str = "errorifexists",
                     order: list[str] | None = None) -> str:
    """One CSV part file with a header, rows by ``order``; fails if ``path``
    exists (default mode).  For results, not for tables."""
    _csv_writer(_one_file(df, order), mode, header).csv(path)
    return path


def write_csv(df: DataFrame, path: str, header: bool = True, mode: str = "overwrite", compression: str = "none",
              max_records_per_file: int = 0) -> str:
    """CSV with a header, natural part count, overwrite by default; ``compression``
    names a codec.  As a gzip part is read by one task, ``max_records_per_file``
    (0: no bound) lets a writing task start further parts."""
    writer = _csv_writer(df, mode, header).option("compression", compression)
    writer.option("maxRecordsPerFile", str(max_records_per_file)).csv(path)
    return path


def balanced(df: DataFrame, *by: str) -> DataFrame:
    """``df`` dealt anew so that each task writes about the session's advisory
    partition size (``spark.sql.adaptive.advisoryPartitionSizeInBytes``).

    A ``rebalance`` exchange that AQE plans from the real sizes: many small
    tasks are joined, large ones split, with ``by`` also those of a hot value,
    whose rows lie together otherwise.
    """
    return df.hint("rebalance", *[F.col(f"`{c}`") for c in by])


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", files: int | None = None,
                  max_records_per_file: int | None = None, balance: bool = False, cluster: str | None = None) -> str:
    """Parquet.  By default one file per task (parallel writers); ``files=n``
    repartitions to n writers; ``balance`` writes files of about the session's
    advisory partition size; ``cluster`` does so with the rows of one value of
    a column together, and sorted by it in each file, so that a filter on it
    skips files and row groups."""
    if files:
        df = df.repartition(files)
    elif balance or cluster:
        df = balanced(df, *([cluster] if cluster else []))
    if cluster:
        df = df.sortWithinPartitions(F.col(f"`{cluster}`"))
    writer = df.write.mode(mode)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", str(max_records_per_file))
    writer.parquet(path)
    return path


def write_text(df: DataFrame, path: str, record: Column, single: bool = False, mode: str = "errorifexists",
               order: list[str] | None = None) -> str:
    """One text line per row, built by ``record`` (see ``functions.format``);
    ``single`` writes one file, rows by ``order``."""
    out = _one_file(df, order) if single else df
    out.select(record.alias("value")).write.mode(mode).text(path)
    return path
