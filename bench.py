"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line.  Steps:

* ``prepare`` -- derive the trip / zone tables from the driver tables and
  write them as Parquet (the CSV -> Parquet conversion step of the original
  workflow); later steps read these files.
* ``q1`` ... ``q6`` -- each whole query on the Parquet trip tables, timed
  around a full action (collect of the small result), median of 5 runs
  after two warm-up runs.
* ``q3_csv`` / ``q4_csv`` -- the same queries reading CSV with inferred
  schemas (inference scan included); ``q1_text`` / ``q2_text`` -- from raw
  text lines (header removal + lenient parsing).
* ``etl`` -- the CSV -> Parquet conversion job over the three raw files.
* ``q6_from_tables`` -- Q6 straight from the driver tables (the view joins
  line items, orders, customers and suppliers).
* ``q2_sql_csv``, ``q3_sql``, ``q3_sql_csv``, ``q5_csv`` and ``q6_csv_32`` /
  ``_64`` / ``_128`` (shuffle partitions) -- the other timed forms.
* ``q4_stored_hour`` -- Q4 over a table converted with its pickup hour.
* ``big_*`` -- Q2, Q5 and Q6 over ``$BENCH_COPIES`` shifted copies of the trips
  (millions of rows), two timed runs each, so that plan changes show.

``value`` is the sum of the Q1-Q6 medians (``q1``, ``q2``, ``q2_sql``, ``q3``,
``q4``, ``q5``, ``q6``); ``prepare`` and the CSV / raw-table variants are
reported next to it in ``queries``.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "5"))

    from pyspark.sql import functions as F

    from farebox.session import delete_scratch, local_session, scratch_path

    # Scratch files go below the session's spark.checkpoint.dir (a private
    # folder only if none is configured; see farebox.session.checkpoint_root).
    spark = local_session("farebox-bench", cores=cpus, shuffle_partitions=int(cpus))

    from farebox.functions.temporal import hour_name, with_stored_hour
    from farebox.plans import q1, q2
    from farebox.plans import zones as zq
    from farebox.sinks.writers import write_parquet
    from farebox.sources import rawfiles, tables
    from farebox.sinks.etl import csv_to_parquet
    from farebox.sources.csv import read_csv_inferred
    from farebox.sources.text import read_lines

    timings: dict[str, float] = {}
    # JVM start-up and first-job class loading are not part of any step.
    spark.range(1000).selectExpr("sum(id)").collect()

    t0 = time.perf_counter()
    geo_path = write_parquet(tables.geo_trips(spark, sf_dir), scratch_path(spark, "geo_trips"))
    loc_path = write_parquet(tables.loc_trips(spark, sf_dir), scratch_path(spark, "loc_trips"))
    zones_path = write_parquet(tables.zones(spark, sf_dir), scratch_path(spark, "zones"), files=1)
    timings["prepare"] = time.perf_counter() - t0

    geo = spark.read.parquet(geo_path)
    geo_hours = spark.read.parquet(write_parquet(with_stored_hour(geo, "tpep_pickup_datetime"), scratch_path(spark, "geo_hours"),
                                                 cluster=hour_name("tpep_pickup_datetime")))
    loc = spark.read.parquet(loc_path)
    zones = spark.read.parquet(zones_path)
    geo_csv = rawfiles.write_geo_csv(spark, sf_dir)
    loc_csv = rawfiles.write_loc_csv(spark, sf_dir)
    zones_csv = rawfiles.write_zones_csv(spark, sf_dir)

    def with_partitions(n: int, build):
        def run():
            before = spark.conf.get("spark.sql.shuffle.partitions")
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            try:
                return build().collect()
            finally:
                spark.conf.set("spark.sql.shuffle.partitions", before)
        return run

    def csv_zones():
        return read_csv_inferred(spark, loc_csv), read_csv_inferred(spark, zones_csv)

    cases = {
        "q1": lambda: q1.hourly_avg(geo),
        "q2": lambda: q2.longest(geo),
        "q2_window": lambda: q2.longest_window(geo),
        "q2_sql": lambda: q2.longest_sql(spark, geo),
        "q3": lambda: zq.same_borough(loc, zones),
        "q4": lambda: zq.night_trips_sql(spark, geo),
        "q4_stored_hour": lambda: zq.night_trips_sql(spark, geo_hours),
        "q5": lambda: zq.top_zone_pairs(loc, zones),
        "q6": lambda: zq.revenue_by_borough(loc, zones),
        "q3_csv": lambda: zq.same_borough(read_csv_inferred(spark, loc_csv), read_csv_inferred(spark, zones_csv)),
        "q4_csv": lambda: zq.night_trips_sql(spark, read_csv_inferred(spark, geo_csv)),
        "q6_from_tables": lambda: zq.revenue_by_borough(tables.loc_trips(spark, sf_dir), tables.zones(spark, sf_dir)),
        "q1_text": lambda: q1.hourly_avg_text(read_lines(spark, geo_csv)),
        "q2_text": lambda: q2.longest_text(read_lines(spark, geo_csv)),
        "q2_sql_csv": lambda: q2.longest_sql(spark, read_csv_inferred(spark, geo_csv)),
        "q3_sql": lambda: zq.same_borough_sql(spark, loc, zones),
        "q3_sql_csv": lambda: zq.same_borough_sql(spark, *csv_zones()),
        "q5_csv": lambda: zq.top_zone_pairs(*csv_zones()),
        **{f"q6_csv_{n}": with_partitions(n, lambda: zq.revenue_by_borough(*csv_zones())) for n in (32, 64, 128)},
        "etl": lambda: csv_to_parquet(spark, [(name, src, scratch_path(spark, name + "_pq")) for name, src in
                                              (("geo", geo_csv), ("loc", loc_csv), ("zones", zones_csv))]),
    }
    def collected(build) -> list:
        out = build()
        return out if isinstance(out, list) else out.collect()

    rows = {}
    for name, build in cases.items():
        for _ in range(2):  # warm-up: codegen, file listing, JIT
            collected(build)
        samples = []
        for _ in range(runs):
            t = time.perf_counter()
            rows[name] = len(collected(build))  # plan building + size checks + execution
            samples.append(time.perf_counter() - t)
        timings[name] = statistics.median(samples)

    copies = int(os.environ.get("BENCH_COPIES", "60"))
    many = F.explode(F.sequence(F.lit(1), F.lit(copies)))
    nudge = F.col("copy") / F.lit(1e6)
    big_geo = spark.read.parquet(write_parquet(
        geo.withColumn("copy", many).withColumn("pickup_latitude", F.when(F.col("pickup_latitude") == 0, 0.0).otherwise(
            F.col("pickup_latitude") + nudge)).drop("copy"), scratch_path(spark, "big_geo")))
    big_loc = spark.read.parquet(write_parquet(loc.withColumn("copy", many).drop("copy"), scratch_path(spark, "big_loc")))
    big = {
        "big_q2": lambda: q2.longest(big_geo),
        "big_q2_window": lambda: q2.longest_window(big_geo),
        "big_q2_sql": lambda: q2.longest_sql(spark, big_geo),
        "big_q5": lambda: zq.top_zone_pairs(big_loc, zones),
        "big_q6": lambda: zq.revenue_by_borough(big_loc, zones),
    }
    for name, build in big.items():
        samples = []
        for _ in range(3):  # the first warms up
            t = time.perf_counter()
            rows[name] = len(build().collect())
            samples.append(time.perf_counter() - t)
        timings[name] = min(samples[1:])
    big_rows = {"geo": big_geo.count(), "loc": big_loc.count()}

    delete_scratch(spark)
    spark.stop()
    headline = ["q1", "q2", "q2_sql", "q3", "q4", "q5", "q6"]
    print(json.dumps({
        "metric": "headline_query_seconds",
        "value": round(sum(timings[k] for k in headline), 3),
        "total_with_prepare_and_variants": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in timings.items()},
        "rows": rows,
        "big_rows": big_rows,
        "sf": os.path.basename(sf_dir).replace("sf", ""),
        "cpus": int(cpus),
    }))


if __name__ == "__main__":
    main()
