"""The same question in several APIs / formats gives the same answer."""

from pyspark.sql import functions as F

from farebox.plans import q1, q2
from farebox.plans import zones as zq
from farebox.sources import rawfiles, tables, text
from farebox.sources.csv import read_csv_inferred, read_csv_with_schema
from tests.conftest import SF_MID, SF_SMALL


def _rounded(df, digits=6):
    cols = [F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]
    return sorted((tuple(r) for r in df.select(*cols).collect()),
                  key=lambda t: tuple((x is None, x if x is not None else 0) for x in t))


def test_q1_native_udf_text_agree(spark):
    geo = tables.geo_trips(spark, SF_SMALL)
    native = _rounded(q1.hourly_avg(geo))
    assert native == _rounded(q1.hourly_avg_udf(geo))
    assert native == _rounded(q1.hourly_avg_text(text.read_lines(spark, rawfiles.write_geo_csv(spark, SF_SMALL))))
    assert [r[0] for r in native] == list(range(24))


def test_q1_csv_fixed_schema_agrees(spark):
    path = rawfiles.write_geo_csv(spark, SF_SMALL)
    from_csv = q1.hourly_avg(read_csv_with_schema(spark, path))
    assert _rounded(from_csv) == _rounded(q1.hourly_avg(tables.geo_trips(spark, SF_SMALL)))


def test_q2_forms_agree_on_ties_and_odd_fixes(spark):
    for geo in (tables.geo_trips(spark, SF_MID), tables.geo_edge_trips(spark, SF_MID)):
        assert _rounded(q2.longest_window(geo)) == _rounded(q2.longest(geo))
    trips = [(1, "2024-01-01 00:00:00", end, 40.0, -74.0, lat, -73.0) for end, lat in
             (("2024-01-01 00:05:00", 41.0), ("2024-01-01 00:09:00", 41.0), ("2024-01-01 00:07:00", 41.0),
              ("2024-01-01 01:00:00", float("nan")), ("2024-01-01 01:00:00", float("inf")))]
    names = ["VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime", "pickup_latitude", "pickup_longitude",
             "dropoff_latitude", "dropoff_longitude"]
    for rows in (trips, trips[::-1]):  # the input order plays no part
        df = spark.createDataFrame(rows, names)
        df = df.withColumns({c: F.col(c).cast("timestamp") for c in names[1:3]})
        for form in (q2.longest, q2.longest_window):
            got = form(df).collect()
            assert len(got) == 1 and got[0].duration_min == 9.0 and got[0].haversine_km < 200
        assert [r["Duration (min)"] for r in q2.longest_sql(spark, df).collect()] == [5.0, 7.0, 9.0]


def test_q2_text_drops_null_vendor_only(spark):
    geo = tables.geo_trips(spark, SF_MID)
    window = [r for r in _rounded(q2.longest_window(geo)) if r[0] is not None]
    lines = text.read_lines(spark, rawfiles.write_geo_csv(spark, SF_MID))
    assert _rounded(q2.longest_text(lines)) == window


def test_q2_sql_keeps_forward_trips_and_rounds(spark):
    rows = q2.longest_sql(spark, tables.geo_trips(spark, SF_MID)).collect()
    assert [tuple(r) for r in rows] == [(1, 51.54, 30.5), (2, 52.41, 69.0)]
    assert rows[0].__fields__ == ["VendorID", "Max Haversine Distance (km)", "Duration (min)"]


def test_q3_df_sql_csv_agree(spark):
    loc, zones = tables.loc_trips(spark, SF_SMALL), tables.zones(spark, SF_SMALL)
    expected = [("EUROPE", 341), ("AFRICA", 180), ("AMERICA", 106), ("MIDDLE EAST", 96), ("ASIA", 86)]
    assert [tuple(r) for r in zq.same_borough(loc, zones).collect()] == expected
    assert [tuple(r) for r in zq.same_borough_sql(spark, loc, zones).collect()] == expected
    loc_csv = read_csv_inferred(spark, rawfiles.write_loc_csv(spark, SF_SMALL))
    zones_csv = read_csv_inferred(spark, rawfiles.write_zones_csv(spark, SF_SMALL))
    assert [tuple(r) for r in zq.same_borough(loc_csv, zones_csv).collect()] == expected


def test_q4_sql_and_dataframe_agree(spark):
    geo = tables.geo_trips(spark, SF_MID)
    expected = [(2, 1631), (1, 1629), (None, 38)]
    assert [tuple(r) for r in zq.night_trips_sql(spark, geo).collect()] == expected
    assert [tuple(r) for r in zq.night_trips(geo).collect()] == expected


def test_q5_tie_break_is_total(spark):
    rows = [tuple(r) for r in zq.top_zone_pairs(tables.loc_trips(spark, SF_SMALL), tables.zones(spark, SF_SMALL)).collect()]
    assert len(rows) == 10
    assert rows == sorted(rows, key=lambda r: (-r[2], r[0], r[1]))
    assert all(a != b for a, b, _ in rows)


def test_argmax_ties_rank_and_join_agree(spark):
    from farebox.operators.argmax import argmax_ties

    d = q2.with_distance(tables.geo_trips(spark, SF_MID))
    a = argmax_ties(d, "VendorID", "haversine_km", q2.OUTPUT)
    b = argmax_ties(d, "VendorID", "haversine_km", q2.OUTPUT, method="join")
    assert _rounded(a) == _rounded(b) and len(_rounded(a)) == 2
    # a key whose maximum is shared by many rows, one all-null key, a null key
    rows = [(1, 5.0, i) for i in range(300)] + [(1, 4.0, 0), (2, None, 0), (None, 9.0, 0), (3, 1.0, 0)]
    df = spark.createDataFrame(rows, "k int, v double, i int")
    for method in ("rank", "join"):
        got = argmax_ties(df, "k", "v", ["k", "v", "i"], method=method).collect()
        assert sorted((r.k, r.v) for r in got) == [(1, 5.0)] * 300 + [(3, 1.0)]
