"""The command-line jobs, run on the test session over files written from the test tables."""

import os

import pytest
from pyspark.sql import functions as F

from farebox import jobs
from farebox.plans import q1
from farebox.plans import zones as zq
from farebox.sinks.writers import write_parquet
from farebox.sources import rawfiles, tables
from tests.conftest import SF_SMALL


def _run(spark, *argv):
    return jobs.run(spark, jobs.parse_args(list(argv) + ["--show", "0"]))


def test_q1_from_fixed_schema_csv(spark, scratch):
    trips = rawfiles.write_geo_csv(spark, SF_SMALL)
    out = _run(spark, "q1", "--trips", trips, "--out", scratch("q1"), "--run-scoped")
    assert out.endswith("_" + spark.conf.get("spark.app.id"))
    assert len([f for f in os.listdir(out) if f.endswith(".csv")]) == 1
    got = spark.read.csv(out, header=True, inferSchema=True).orderBy("hour").collect()
    want = q1.hourly_avg(tables.geo_trips(spark, SF_SMALL)).collect()
    assert [r.hour for r in got] == [r.hour for r in want]
    assert all(abs(a.avg_latitude - b.avg_latitude) < 1e-9 for a, b in zip(got, want))
    with pytest.raises(Exception):  # single-file outputs refuse an existing folder
        _run(spark, "q1", "--trips", trips, "--out", out)


def test_q3_and_q6_from_parquet(spark, scratch):
    loc = write_parquet(tables.loc_trips(spark, SF_SMALL), scratch("loc"))
    zones = write_parquet(tables.zones(spark, SF_SMALL), scratch("zones"), files=1)
    out = _run(spark, "q3", "--format", "parquet", "--trips", loc, "--zones", zones, "--out", scratch("q3"))
    got = sorted(tuple(r) for r in spark.read.csv(out, header=True, inferSchema=True).collect())
    want = sorted(tuple(r) for r in zq.same_borough(tables.loc_trips(spark, SF_SMALL), tables.zones(spark, SF_SMALL)).collect())
    assert got == want
    out6 = _run(spark, "q6", "--format", "parquet", "--trips", loc, "--zones", zones, "--out", scratch("q6"),
                "--shuffle-partitions", "16")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert spark.read.csv(out6, header=True).count() == 6


def test_q2_text_fixed_format(spark, scratch):
    trips = rawfiles.write_geo_csv(spark, SF_SMALL)
    out = _run(spark, "q2-text", "--trips", trips, "--out", scratch("q2t"))
    lines = sorted(r.value for r in spark.read.text(out).collect())
    assert len(lines) == 2
    for line in lines:
        vendor, km, minutes = line.split(",")
        assert vendor in {"1", "2"} and len(km.split(".")[1]) == 3 and len(minutes.split(".")[1]) == 1


def test_convert_job(spark, scratch):
    trips = rawfiles.write_loc_csv(spark, SF_SMALL)
    zones = rawfiles.write_zones_csv(spark, SF_SMALL)
    out = _run(spark, "convert", "--input", f"trips={trips}", "--input", f"zones={zones}", "--files", "1",
               "--out", scratch("pq"))
    assert spark.read.parquet(f"{out}/trips").count() == tables.loc_trips(spark, SF_SMALL).count()
    assert spark.read.parquet(f"{out}/zones").where(F.col("Borough").isNull()).count() == 1


@pytest.fixture()
def main(spark, monkeypatch):
    """``jobs.main`` on the test session, which it must stop exactly once."""
    stops = []
    monkeypatch.setattr(type(spark), "stop", lambda self: stops.append(1))

    def call(*argv):
        stops.clear()
        code = jobs.main(list(argv))
        assert stops == [1]
        return code

    return call


def test_main_reports_failure_and_stops(main, scratch, capsys):
    assert main("q3", "--trips", scratch("missing"), "--zones", scratch("missing2"), "--out", scratch("x")) == 1
    assert "q3 failed" in capsys.readouterr().err


def test_convert_fails_after_trying_every_file(main, spark, scratch, capsys):
    zones, out = rawfiles.write_zones_csv(spark, SF_SMALL), scratch("pq")
    missing = scratch("a" * 150)
    assert main("convert", "--input", f"gone={missing}", "--input", f"zones={zones}", "--out", out) == 1
    assert spark.read.parquet(f"{out}/zones").count() == 25
    said = capsys.readouterr()
    assert "gone" in said.err and missing in said.err and "zones: 25 rows" in said.out
    assert main("convert", "--input", f"zones={zones}", "--out", scratch("pq2"), "--show", "0") == 0


def test_explain_and_show_what_was_written(main, spark, scratch, capfd):
    trips = rawfiles.write_geo_csv(spark, SF_SMALL)
    out = scratch("q1")
    assert main("q1", "--trips", trips, "--out", out, "--explain", "--show", "3") == 0
    said = capfd.readouterr().out
    assert "== Physical Plan ==" in said and "avg_latitude" in said
    lines = [r.value for r in spark.read.text(out).collect()]
    assert [x.split(",")[0] for x in lines[1:]] == [str(h) for h in range(24)]


def test_check_header_option(spark, scratch, tmp_path):
    from farebox.schemas import TRIP_COLUMNS_19

    header = ",".join(n for n, _ in TRIP_COLUMNS_19).replace("pickup_latitude", "pickup_lat")
    row = "1,2015-01-15 19:05:39,2015-01-15 19:23:42,1,1.59,-73.99,40.75,1,N,-73.97,40.76,1,12,1,0.5,3.25,0,0.3,17.05"
    p = tmp_path / "renamed.csv"
    p.write_text(header + "\n" + row + "\n")
    out = _run(spark, "q1", "--trips", str(p), "--out", scratch("ok"))  # binds by position
    assert spark.read.csv(out, header=True).count() == 1
    with pytest.raises(Exception):
        _run(spark, "q1", "--trips", str(p), "--out", scratch("strict"), "--check-header")
