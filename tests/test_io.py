"""Sources, sinks and the conversion job."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from farebox.functions.format import VENDOR_RECORD, fixed_record, vendor_line
from farebox.plans import q1, q2
from farebox.sinks import csv_to_parquet, run_scoped_path, write_csv_single, write_parquet, write_text
from farebox.sources import rawfiles, tables
from farebox.sources.csv import read_csv_inferred
from tests.conftest import SF_MID, SF_SMALL


def test_single_csv_keeps_sort_order_and_refuses_existing(spark, scratch):
    result = q1.hourly_avg(tables.geo_trips(spark, SF_SMALL))
    path = run_scoped_path(spark, scratch("out"), "q1")
    assert path.endswith("q1_" + spark.sparkContext.applicationId)
    write_csv_single(result, path, order=["hour"])
    parts = glob.glob(os.path.join(path, "part-*.csv"))
    assert len(parts) == 1
    hours = [int(line.split(",")[0]) for line in open(parts[0]).read().splitlines()[1:]]
    assert hours == list(range(24))
    with pytest.raises(Exception):
        write_csv_single(result, path)


def test_parquet_file_count_parameter(spark, scratch):
    loc = tables.loc_trips(spark, SF_SMALL)
    one = write_parquet(loc, scratch("one"), files=1)
    three = write_parquet(loc, scratch("three"), files=3)
    assert len(glob.glob(os.path.join(one, "*.parquet"))) == 1
    assert len(glob.glob(os.path.join(three, "*.parquet"))) == 3
    assert spark.read.parquet(one).count() == spark.read.parquet(three).count() == loc.count()


def test_fixed_format_text(spark, scratch):
    result = q2.longest_window(tables.geo_trips(spark, SF_SMALL)).where(F.col("VendorID").isNotNull())
    path = write_text(result.orderBy("VendorID"), scratch("q2txt"), fixed_record(VENDOR_RECORD, "VendorID",
                                                                                  "haversine_km", "duration_min"))
    lines = [r.value for r in spark.read.text(path).collect()]
    assert len(lines) == 2 and all(len(l.split(",")) == 3 for l in lines)
    assert all(len(l.split(",")[1].split(".")[1]) == 3 for l in lines)
    report = result.select(vendor_line("VendorID", "haversine_km", "duration_min").alias("l")).collect()
    assert all(r.l.startswith("VendorID: ") and r.l.endswith(" min") for r in report)


def test_csv_round_trip_queries(spark):
    loc = read_csv_inferred(spark, rawfiles.write_loc_csv(spark, SF_SMALL))
    assert dict(loc.dtypes) == {"PULocationID": "int", "DOLocationID": "int", "fare_amount": "double",
                                "tip_amount": "double", "tolls_amount": "double", "extra": "double",
                                "mta_tax": "double", "congestion_surcharge": "double", "airport_fee": "double",
                                "total_amount": "double"}
    assert loc.count() == tables.loc_trips(spark, SF_SMALL).count()


def test_conversion_job_survives_a_bad_file(spark, scratch):
    good = rawfiles.write_zones_csv(spark, SF_SMALL)
    jobs = [("zones", good, scratch("zones_pq")), ("missing", scratch("does-not-exist"), scratch("missing_pq"))]
    status = {r.name: r for r in csv_to_parquet(spark, jobs).collect()}
    assert status["zones"].rows == 25 and status["zones"].error is None
    assert status["missing"].rows is None and status["missing"].error


def test_writers_leave_the_scan_its_tasks(spark, scratch):
    from farebox.functions.format import csv_record

    rows = spark.range(0, 1000, 1, 6)
    path = write_text(rows, scratch("text"), csv_record("id"))
    assert len(glob.glob(os.path.join(path, "part-*"))) == 6
    marked = rows.select("id", F.spark_partition_id().alias("task"))
    for write in (lambda p: write_text(marked, p, csv_record("task"), single=True, order=["id"]),
                  lambda p: write_csv_single(marked.select("task"), p, header=False)):
        out = write(scratch("one"))
        assert len(glob.glob(os.path.join(out, "part-*"))) == 1
        assert {r.value for r in spark.read.text(out).collect()} == set("012345")
    one = spark.read.parquet(write_parquet(marked, scratch("pq"), files=1))
    assert one.select("task").distinct().count() == 6


def test_scratch_needs_a_shared_folder_on_a_cluster(monkeypatch):
    from types import SimpleNamespace

    from farebox.session import checkpoint_root

    def session(master):
        context = SimpleNamespace(master=master, getCheckpointDir=lambda: None, setCheckpointDir=lambda d: None)
        return SimpleNamespace(conf=SimpleNamespace(get=lambda k, d: d), sparkContext=context)

    for master in ("yarn", "spark://host:7077", "k8s://host", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            checkpoint_root(session(master))


def test_raw_files_are_written_once_and_scratch_can_be_deleted(spark):
    from farebox.session import delete_scratch, scratch_root

    path = rawfiles.write_zones_csv(spark, SF_SMALL)
    assert rawfiles.write_zones_csv(spark, SF_SMALL + "/") == path
    delete_scratch(spark)
    rawfiles.forget(spark)
    assert not os.path.exists(scratch_root(spark).removeprefix("file:"))
    again = rawfiles.write_zones_csv(spark, SF_SMALL)
    assert again != path and spark.read.csv(again, header=True).count() == 25


def test_balanced_files(spark, scratch):
    """Many small tasks write few files; a hot value's rows are split over several."""
    many = spark.range(0, 50_000, 1, 1000)
    out = write_parquet(many, scratch("many"), balance=True)
    assert len(glob.glob(os.path.join(out, "*.parquet"))) <= 8
    assert len(glob.glob(os.path.join(write_parquet(many, scratch("plain")), "*.parquet"))) == 1000
    assert spark.read.parquet(out).count() == 50_000
    hot = spark.range(0, 400_000, 1, 16).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 1000).alias("k"),
                                                F.sha2(F.col("id").cast("string"), 256).alias("pad"))
    sizes = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": str(1 << 20),
             "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false", "spark.sql.shuffle.partitions": "200"}
    before = spark.conf.get("spark.sql.shuffle.partitions")
    for key, value in sizes.items():
        spark.conf.set(key, value)
    try:
        out = write_parquet(hot, scratch("hot"), cluster="k")
    finally:
        for key in sizes:
            spark.conf.unset(key)
        spark.conf.set("spark.sql.shuffle.partitions", before)
    rows = spark.read.parquet(out).select("k", F.input_file_name().alias("f"))
    assert rows.count() == 400_000 and rows.where("k = 5").select("f").distinct().count() > 3
    assert rows.groupBy("f").count().agg(F.max("count")).first()[0] < 100_000
    files = rows.groupBy("k").agg(F.count_distinct("f").alias("n"))
    assert files.where("n = 1").count() > 600  # the rows of one value lie together, but for those dealt with the hot one


def test_convert_job_options(spark, scratch):
    from farebox import jobs

    trips, out = rawfiles.write_geo_csv(spark, SF_SMALL), scratch("converted")
    jobs.run(spark, jobs.parse_args(["convert", "--input", f"trips={trips}", "--hour-of", "trips=tpep_pickup_datetime",
                                     "--remember-schema", "--out", out, "--show", "0"]))
    table = spark.read.parquet(out + "/trips")
    assert table.where("tpep_pickup_datetime_hour <> hour(tpep_pickup_datetime)").count() == 0
    from farebox.sources.schema_store import remembered_schema
    assert remembered_schema(spark, trips) is not None
    paths = ",".join([out + "/trips", out + "/trips"])
    night = jobs.run(spark, jobs.parse_args(["q4", "--format", "parquet", "--trips", paths, "--out", scratch("q4"), "--show", "0"]))
    got = spark.read.csv(night, header=True, inferSchema=True).agg(F.sum("NightTrips")).first()[0]
    assert got == 2 * table.where("tpep_pickup_datetime_hour >= 23 OR tpep_pickup_datetime_hour < 7").count()


def test_text_jobs_say_what_they_dropped(spark, scratch, capsys):
    from farebox import jobs

    trips = rawfiles.write_geo_csv(spark, SF_SMALL)
    jobs.run(spark, jobs.parse_args(["q2-text", "--trips", trips, "--out", scratch("q2t")]))
    printed = capsys.readouterr().out
    nulls = tables.geo_trips(spark, SF_SMALL).where("VendorID IS NULL").count()
    assert f"lines VendorID: no int: {nulls}\n" in printed and "lines kept: " in printed


def test_raw_files_are_small_parts(spark, monkeypatch):
    """The raw CSVs take under 40 bytes a row, and one writing task leaves several parts to read in parallel."""
    monkeypatch.setattr(rawfiles, "RECORDS_PER_PART", 2_000)
    rawfiles.forget(spark)
    try:
        for write, frame in ((rawfiles.write_geo_csv, tables.geo_trips), (rawfiles.write_loc_csv, tables.loc_trips)):
            path, n = write(spark, SF_MID), frame(spark, SF_MID).count()
            parts = [f"{path}/{f}" for f in os.listdir(path) if f.startswith("part-")]
            assert len(parts) >= n / 2_000 and sum(map(os.path.getsize, parts)) < 40 * n
            assert spark.read.csv(path, header=True).count() == n
    finally:
        rawfiles.forget(spark)
