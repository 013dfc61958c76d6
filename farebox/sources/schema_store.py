"""Inferred CSV schemas, kept beside their source.

Inferring the types of a CSV reads all of it once more.  The schema found is
kept in a small file beside the source, under a name that Spark's readers
pass over, together with the path, length and modification time of every file
it was inferred from.  As long as these agree, later reads take the schema
from there and start no job; any new, changed or missing file means inferring
again.  Where the source cannot be written to, every read infers.
"""

from __future__ import annotations

import json
import zlib

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from farebox.sources.csv import read_csv_inferred

FORMAT = 1


def _hadoop(spark: SparkSession, path: str):
    """(file system, path) in Spark's own file system layer, so any store that Spark reads will do."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _hidden(name: str) -> bool:
    return name.startswith(("_", "."))


def source_files(spark: SparkSession, path: str) -> list[list]:
    """[path, length, modification time] of every data file at ``path`` (a file,
    a folder or a pattern), in order; what Spark's readers pass over is left out."""
    fs, where = _hadoop(spark, path)
    found, todo = [], [(status, False) for status in (fs.globStatus(where) or [])]
    while todo:
        status, nested = todo.pop()
        name = status.getPath().getName()
        if nested and _hidden(name):
            continue
        if status.isDirectory():
            todo += [(s, True) for s in fs.listStatus(status.getPath())]
        else:
            found.append([status.getPath().toString(), status.getLen(), status.getModificationTime()])
    return sorted(found)


def schema_path(spark: SparkSession, path: str) -> str:
    """Where the schema of ``path`` is kept: in a folder itself, else next to the file (or pattern)."""
    fs, where = _hadoop(spark, path)
    name = f"_schema_{zlib.crc32(path.rstrip('/').encode()):08x}.json"
    folder = where if fs.exists(where) and fs.getFileStatus(where).isDirectory() else where.getParent()
    return spark._jvm.org.apache.hadoop.fs.Path(folder, name).toString()


def _read(spark: SparkSession, path: str) -> str | None:
    fs, where = _hadoop(spark, path)
    if not fs.exists(where):
        return None
    stream = fs.open(where)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def _write(spark: SparkSession, path: str, text: str) -> None:
    fs, where = _hadoop(spark, path)
    stream = fs.create(where, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def remembered_schema(spark: SparkSession, path: str) -> StructType | None:
    """The schema kept for ``path``, or None if there is none or a file has changed."""
    text = _read(spark, schema_path(spark, path))
    if text is None:
        return None
    try:
        kept = json.loads(text)
    except ValueError:  # cut short by a lost writer
        return None
    if kept.get("format") != FORMAT or kept.get("files") != source_files(spark, path):
        return None
    return StructType.fromJson(kept["schema"])


def read_csv_remembered(spark: SparkSession, path: str) -> DataFrame:
    """Like ``read_csv_inferred``, without its extra pass when the schema is known."""
    schema = remembered_schema(spark, path)
    if schema is not None:
        return spark.read.csv(path, header=True, schema=schema)
    files = source_files(spark, path)  # listed first: a file added meanwhile makes the schema stale
    frame = read_csv_inferred(spark, path)
    try:
        _write(spark, schema_path(spark, path), json.dumps({"format": FORMAT, "files": files, "schema": frame.schema.jsonValue()}))
    except Exception as exc:
        if not _refused(exc):
            raise
    return frame


def _refused(exc: Exception) -> bool:
    """True if a store refused to be written to."""
    text = str(exc)
    return not isinstance(exc, PySparkException) and ("java.io" in text or "AccessControlException" in text)
