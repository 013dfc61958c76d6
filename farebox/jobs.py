"""Command-line jobs: one subcommand per analysis, over the caller's files.

    python -m farebox.jobs q3 --trips /data/trips_2024.parquet --zones /data/zones.parquet --out /out/q3
    python -m farebox.jobs q1 --trips /data/trips_2015.csv --format csv --out /out/q1 --run-scoped
    python -m farebox.jobs convert --input trips=/data/trips.csv --input zones=/data/zones.csv --out /data/parquet

Each job reads its inputs, writes its result and prints the first rows of what
it wrote (with ``--explain`` also the plan):
single-file CSV (fails if the folder exists) for the hourly means and the
window form of the longest trip, CSV in overwrite mode for the others, text
lines for the raw-text forms, which also print how many lines were dropped and why.  This module is an application entry point, so
it (and only it) gets or creates the session, and stops it at the end.  The exit
code is 1 when a job, or any file of a conversion, failed.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, Observation, SparkSession

from farebox.functions.format import VENDOR_RECORD, csv_record, fixed_record
from farebox.plans import q1, q2
from farebox.plans import zones as zq
from farebox.schemas import TRIP_SCHEMA
from farebox.sinks import csv_to_parquet, run_scoped_path, write_csv, write_csv_single, write_text
from farebox.sources import (line_counts, read_csv_inferred, read_csv_remembered, read_csv_with_schema, read_lines,
                             read_merged, read_parquet)


def _trips(spark: SparkSession, args, fixed_schema: bool) -> DataFrame:
    paths = args.trips.split(",")
    if len(paths) > 1 and not fixed_schema:  # months whose schemas may differ
        return read_merged(spark, paths, args.format, None if args.format == "parquet" else _inferred(args))
    if args.format == "parquet":
        return read_parquet(spark, *paths)
    if fixed_schema:
        return read_csv_with_schema(spark, args.trips, TRIP_SCHEMA, check_header=args.check_header)
    return _inferred(args)(spark, args.trips)


def _inferred(args):
    return read_csv_remembered if args.remember_schema else read_csv_inferred


def _zones(spark: SparkSession, args) -> DataFrame:
    if args.zones is None:
        raise SystemExit("--zones is required for this job")
    return read_parquet(spark, args.zones) if args.format == "parquet" else _inferred(args)(spark, args.zones)


# job name -> (builder(spark, args) -> DataFrame, output kind)
JOBS = {
    "q1": (lambda s, a: q1.hourly_avg(_trips(s, a, True)), "csv-single"),
    "q1-udf": (lambda s, a: q1.hourly_avg_udf(_trips(s, a, True)), "csv-single"),
    "q1-text": (lambda s, a: q1.hourly_avg_text(read_lines(s, a.trips), seen=a.seen), "text-full"),
    "q2": (lambda s, a: q2.longest(_trips(s, a, True)), "csv-single"),
    "q2-sql": (lambda s, a: q2.longest_sql(s, _trips(s, a, False)), "csv"),
    "q2-text": (lambda s, a: q2.longest_text(read_lines(s, a.trips), seen=a.seen), "text-fixed"),
    "q3": (lambda s, a: zq.same_borough(_trips(s, a, False), _zones(s, a)), "csv"),
    "q3-sql": (lambda s, a: zq.same_borough_sql(s, _trips(s, a, False), _zones(s, a)), "csv"),
    "q4": (lambda s, a: zq.night_trips_sql(s, _trips(s, a, False)), "csv"),
    "q5": (lambda s, a: zq.top_zone_pairs(_trips(s, a, False), _zones(s, a)), "csv"),
    "q6": (lambda s, a: zq.revenue_by_borough(_trips(s, a, False), _zones(s, a)), "csv"),
}


def _write(result: DataFrame, kind: str, out: str) -> DataFrame:
    """Write the result; returns what was written, read back."""
    spark = result.sparkSession
    if kind == "csv-single":
        write_csv_single(result, out, order=result.columns[:1])
    elif kind == "csv":
        write_csv(result, out, mode="overwrite")
    else:
        record = csv_record(*result.columns) if kind == "text-full" else fixed_record(VENDOR_RECORD, *result.columns)
        write_text(result, out, record, single=True, order=result.columns[:1])  # a result of few rows
        return spark.read.text(out)
    return spark.read.csv(out, header=True, schema=result.schema)


def parse_args(argv: list[str]) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="python -m farebox.jobs", description=__doc__.split("\n\n")[0])
    parser.add_argument("job", choices=sorted(JOBS) + ["convert"])
    parser.add_argument("--trips", help="trip file: CSV with header, Parquet, or raw text lines; several, with commas "
                        "between them, are merged under one schema")
    parser.add_argument("--zones", help="zone lookup (LocationID, Borough, Zone)")
    parser.add_argument("--format", choices=["csv", "parquet"], default="csv", help="format of --trips/--zones")
    parser.add_argument("--input", action="append", default=[], metavar="NAME=CSV", help="convert: a CSV to convert")
    parser.add_argument("--files", type=int, default=None,
                        help="convert: Parquet files per table (default: files of the session's advisory size)")
    parser.add_argument("--hour-of", action="append", default=[], metavar="NAME=COLUMN",
                        help="convert: store the hour of a time column and cluster the table by it")
    parser.add_argument("--remember-schema", action="store_true",
                        help="keep an inferred CSV schema beside its source; later runs skip the inference")
    parser.add_argument("--out", required=True, help="output folder")
    parser.add_argument("--run-scoped", action="store_true", help="append _<application id> to --out")
    parser.add_argument("--show", type=int, default=20, help="rows to print (0: none)")
    parser.add_argument("--shuffle-partitions", type=int, default=None)
    parser.add_argument("--explain", action="store_true", help="print the physical plan of the job")
    parser.add_argument("--check-header", action="store_true",
                        help="fixed-schema CSV: fail when the header names differ instead of binding by position")
    return parser.parse_args(argv)


def run(spark: SparkSession, args: argparse.Namespace) -> str:
    """Run one job on an existing session; returns the output folder."""
    out = args.out.rstrip("/")
    if args.run_scoped:
        base, _, name = out.rpartition("/")
        out = run_scoped_path(spark, base or ".", name)
    if args.shuffle_partitions:
        spark.conf.set("spark.sql.shuffle.partitions", str(args.shuffle_partitions))
    if args.job == "convert":
        jobs = []
        for item in args.input:
            name, _, src = item.partition("=")
            jobs.append((name, src, f"{out}/{name}"))
        hours = dict(item.split("=", 1) for item in args.hour_of)
        status = csv_to_parquet(spark, jobs, files=args.files, hours=hours, remember=args.remember_schema).collect()  # a row per file
        for row in status if args.show else []:
            print(f"{row['name']}: {row['rows']} rows")
        failed = [row for row in status if row["error"] is not None]
        if failed:
            raise RuntimeError("not converted: " + "; ".join(f"{row['name']}: {row['error']}" for row in failed))
        return out
    if not args.trips:
        raise SystemExit("--trips is required for this job")
    build, kind = JOBS[args.job]
    args.seen = Observation() if args.job.endswith("-text") else None
    result = build(spark, args)
    if args.explain:
        result.explain("formatted")
    written = _write(result, kind, out)
    if args.show:
        written.show(args.show, truncate=False)
    for reason, n in line_counts(args.seen) if args.seen is not None and args.show else []:
        print(f"lines {reason}: {n}")
    return out


def main(argv: list[str] | None = None) -> int:
    args = parse_args(sys.argv[1:] if argv is None else argv)
    spark = SparkSession.builder.appName(f"farebox {args.job}").getOrCreate()
    try:
        out = run(spark, args)
        print(f"{args.job}: written to {out}")
        return 0
    except Exception as exc:  # report and fail the application
        print(f"{args.job} failed: {type(exc).__name__}: {exc}", file=sys.stderr)
        return 1
    finally:
        spark.stop()


if __name__ == "__main__":
    raise SystemExit(main())
