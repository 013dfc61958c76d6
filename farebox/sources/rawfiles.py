"""Raw trip files (CSV / text) written from the driver-table views.

The CSV and text variants of the queries need files in the layout of the raw
trip and zone files; these are written by Spark, in parallel, below the
session's shared checkpoint folder, from the same views the Parquet variants
read.  Each file is written once per application and input
folder, gzipped (the CSVs are several times as large as the tables they come
from) in parts small enough that reading them stays parallel, and goes with
the application's scratch data.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from farebox.schemas import TRIP_COLUMNS_19
from farebox.session import scratch_path, scratch_root
from farebox.sinks.writers import write_csv
from farebox.sources import tables


RECORDS_PER_PART = 250_000  # some 15 to 35 MB of lines

# Paths of the files written so far, by scratch folder of the application.
_WRITTEN: dict[tuple[str, str, str], str] = {}


def _once(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> str:
    """The path of the CSV of this name and input folder, written at the first call."""
    root = scratch_root(spark)
    key = (root, sf_dir.rstrip("/"), name)
    if key not in _WRITTEN:
        _WRITTEN[key] = write_csv(build(), scratch_path(spark, name), compression="gzip",
                                  max_records_per_file=RECORDS_PER_PART)
    return _WRITTEN[key]


def forget(spark: SparkSession) -> None:
    """Write anew from now on (the application's scratch data have been deleted)."""
    for key in [k for k in _WRITTEN if k[0] == scratch_root(spark)]:
        del _WRITTEN[key]


def write_geo_csv(spark: SparkSession, sf_dir: str) -> str:
    """19-column coordinate trip CSV with header, ``yyyy-MM-dd HH:mm:ss`` times."""
    return _once(spark, sf_dir, "geo_trips_csv",
                 lambda: tables.geo_trips(spark, sf_dir).select(*[name for name, _ in TRIP_COLUMNS_19]))


def write_geo_edge_csv(spark: SparkSession, sf_dir: str) -> str:
    """The same layout with fixes that are not finite and tied longest trips."""
    return _once(spark, sf_dir, "geo_edge_csv",
                 lambda: tables.geo_edge_trips(spark, sf_dir).select(*[name for name, _ in TRIP_COLUMNS_19]))


def write_loc_csv(spark: SparkSession, sf_dir: str) -> str:
    return _once(spark, sf_dir, "loc_trips_csv", lambda: tables.loc_trips(spark, sf_dir))


def write_zones_csv(spark: SparkSession, sf_dir: str) -> str:
    return _once(spark, sf_dir, "zones_csv", lambda: tables.zones(spark, sf_dir))
