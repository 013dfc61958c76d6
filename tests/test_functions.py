"""Column expressions in isolation."""

import math

import pytest
from pyspark.sql import functions as F

from farebox.functions.format import hourly_line, vendor_line
from farebox.functions.geo import haversine_km_asin, haversine_km_atan2, nonzero_points
from farebox.functions.parse import to_double, to_int, to_wall_clock
from farebox.functions.temporal import hour_in_wrapped_range, minutes_between


def _py_haversine(lat1, lon1, lat2, lon2):
    dlat, dlon = math.radians(lat2 - lat1), math.radians(lon2 - lon1)
    a = math.sin(dlat / 2) ** 2 + math.cos(math.radians(lat1)) * math.cos(math.radians(lat2)) * math.sin(dlon / 2) ** 2
    return 6371.0 * 2 * math.atan2(math.sqrt(a), math.sqrt(1 - a))


def test_haversine_forms_agree_and_clamp(spark):
    pts = [(40.75, -73.99, 40.64, -73.78), (0.0, 0.0, 0.0, 180.0), (10.0, 20.0, 10.0, 20.0)]
    df = spark.createDataFrame(pts, "a double, b double, c double, d double")
    rows = df.select(haversine_km_atan2("a", "b", "c", "d").alias("t"), haversine_km_asin("a", "b", "c", "d").alias("s")).collect()
    for (lat1, lon1, lat2, lon2), r in zip(pts, rows):
        assert r.t == pytest.approx(_py_haversine(lat1, lon1, lat2, lon2), rel=1e-12)
        assert r.s == pytest.approx(r.t, rel=1e-9)
        assert not math.isnan(r.t)
    assert rows[1].t == pytest.approx(math.pi * 6371.0)  # antipodal: clamped, no NaN


def test_nonzero_points_null_drops(spark):
    df = spark.createDataFrame([(1.0, 2.0), (0.0, 2.0), (None, 2.0), (-0.0, 1.0)], "a double, b double")
    assert df.where(nonzero_points("a", "b")).count() == 1


def test_wrapped_hour_range(spark):
    df = spark.createDataFrame([(f"2024-01-01 {h:02d}:30:00",) for h in range(24)], "v string")
    ts = df.select(to_wall_clock(F.col("v")).alias("ts"))
    night = sorted(r[0] for r in ts.where(hour_in_wrapped_range("ts", 23, 7)).select(F.hour("ts")).collect())
    assert night == [0, 1, 2, 3, 4, 5, 6, 23]
    day = sorted(r[0] for r in ts.where(hour_in_wrapped_range("ts", 9, 17)).select(F.hour("ts")).collect())
    assert day == list(range(9, 17))


def test_wall_clock_minutes_ignore_dst(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([("2024-03-10 01:30:00", "2024-03-10 03:30:00")], "a string, b string")
        got = df.select(minutes_between(to_wall_clock(F.col("a")), to_wall_clock(F.col("b")))).first()[0]
        assert got == 120.0  # naive wall-clock difference, as a naive datetime subtraction gives
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_lenient_numbers(spark):
    vals = ["1", "1.0", "", " 7 ", "1e3", "nan", "2.5d", "1_000", "-0.5", None]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    rows = df.select(to_int(F.col("v")).alias("i"), to_double(F.col("v")).alias("d")).collect()
    ints = [r.i for r in rows]
    assert ints == [1, None, None, 7, None, None, None, None, None, None]
    doubles = [r.d for r in rows]
    assert doubles[:5] == [1.0, 1.0, None, 7.0, 1000.0]
    assert math.isnan(doubles[5]) and doubles[6] is None and doubles[7] is None and doubles[8] == -0.5


def test_report_formats(spark):
    df = spark.createDataFrame([(7, 40.1234564, -73.5, 1, 12.345, 5.0)], "h int, lat double, lon double, v int, km double, m double")
    row = df.select(hourly_line("h", "lat", "lon").alias("a"), vendor_line("v", "km", "m").alias("b")).first()
    assert row.a == "Hour: 07 | Avg Latitude: 40.123456 | Avg Longitude: -73.500000"
    assert row.b == "VendorID: 1 | Distance: 12.35 km | Duration: 5.00 min"


def test_udf_hour_follows_session_zone_like_hour(spark):
    from farebox.functions.udfs import hour_udf

    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([("2015-01-15 19:05:39",), ("2015-07-01 00:30:00",)], "v string")
        ltz = df.select(F.to_timestamp("v").alias("t"))          # session-zone timestamp
        ntz = df.select(to_wall_clock(F.col("v")).alias("t"))    # zone-free timestamp
        for frame in (ltz, ntz):
            rows = frame.select(F.hour("t").alias("a"), hour_udf("t").alias("b")).collect()
            assert [r.a for r in rows] == [r.b for r in rows] == [19, 0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
