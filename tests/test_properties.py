"""Property tests: Spark expressions against plain Python on generated batches
(one Spark job per batch, a handful of batches)."""

import math

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from farebox.functions.geo import haversine_km_atan2
from farebox.functions.parse import to_double, to_int, to_wall_clock
from farebox.functions.temporal import hour_in_wrapped_range

NUMBER_TEXT = st.one_of(
    st.integers(-10**9, 10**9).map(str),
    st.floats(allow_nan=False, allow_infinity=False, width=64).map(repr),
    st.from_regex(r"\A[+-]?[0-9]{1,6}(\.[0-9]{0,6})?([eE][+-]?[0-9]{1,2})?\Z"),
    st.sampled_from(["\u0660", "\u0663.5", "\uff11"]),  # non-ASCII digits
    st.sampled_from(["", " ", "1.0", "1d", "2F", "0x10", "1_000", "--1", "1e", ".", "nan", "inf", "-0"]),
)


def _py_int(s):
    try:
        return int(s)
    except ValueError:
        return None


def _py_float(s):
    try:
        return float(s)
    except ValueError:
        return None


@settings(max_examples=5, deadline=None, derandomize=True)
@given(st.lists(NUMBER_TEXT, min_size=50, max_size=200))
def test_number_parsing_matches_python_where_both_accept(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select("t", to_int(F.col("t")).alias("i"), to_double(F.col("t")).alias("d")).collect()
    for r in rows:
        if r.i is not None:
            assert _py_int(r.t) == r.i, r.t
        if r.d is not None:
            py = _py_float(r.t.replace("_", "#"))  # underscores are Python-only syntax
            assert py is not None, r.t
            assert (math.isnan(py) and math.isnan(r.d)) or py == r.d, r.t
        elif _py_float(r.t) is not None and "_" not in r.t:
            # Python accepts it and the SQL rules do not: only non-ASCII digits
            assert not r.t.isascii(), r.t


@settings(max_examples=5, deadline=None, derandomize=True)
@given(st.lists(st.tuples(st.floats(-89, 89), st.floats(-179, 179), st.floats(-89, 89), st.floats(-179, 179)),
                min_size=20, max_size=100))
def test_haversine_matches_python(spark, pts):
    df = spark.createDataFrame(pts, "a double, b double, c double, d double")
    got = [r[0] for r in df.select(haversine_km_atan2("a", "b", "c", "d")).collect()]
    for (lat1, lon1, lat2, lon2), km in zip(pts, got):
        dlat, dlon = math.radians(lat2 - lat1), math.radians(lon2 - lon1)
        a = math.sin(dlat / 2) ** 2 + math.cos(math.radians(lat1)) * math.cos(math.radians(lat2)) * math.sin(dlon / 2) ** 2
        a = min(max(a, 0.0), 1.0)
        want = 6371.0 * 2 * math.atan2(math.sqrt(a), math.sqrt(1 - a))
        assert math.isclose(km, want, rel_tol=1e-9, abs_tol=1e-9)


@settings(max_examples=5, deadline=None, derandomize=True)
@given(st.integers(0, 23), st.integers(0, 23))
def test_wrapped_hour_range_matches_predicate(spark, start, end):
    df = spark.createDataFrame([(f"2024-01-01 {h:02d}:10:00",) for h in range(24)], "v string")
    got = sorted(r[0] for r in df.select(F.hour(to_wall_clock(F.col("v"))).alias("h"))
                 .where(hour_in_wrapped_range(to_wall_clock(F.col("v")), start, end)).collect())
    want = [h for h in range(24) if (start <= h < end if start <= end else (h >= start or h < end))]
    assert got == want


TIME_TEXT = st.one_of(
    st.builds("{}-{}-{} {}:{}:{}".format, st.sampled_from(["2015", "0001", "0000", "9999", "215", "20150"]),
              *[st.one_of(st.integers(0, 62).map(str), st.integers(0, 62).map("{:02d}".format)) for _ in range(5)]),
    st.builds("{:04d}-{:02d}-{:02d}{}{:02d}:{:02d}:{:02d}".format, st.integers(1, 9999), st.integers(1, 12), st.integers(1, 31),
              st.sampled_from([" ", "  ", "\t", " \t ", "T", ""]), st.integers(0, 23), st.integers(0, 59), st.integers(0, 61)),
    st.sampled_from(["2015-01- 5 1:2:3", "2015- 1-05 1:2:3", "2015-1-5 1:2:3.5", " 2015-1-5 1:2:3", "2015-1-5 1:2:3 ", "2015-1-5",
                     "2015-01-05 01:02", "+2015-1-5 1:2:3", "-2015-1-5 1:2:3", "2016-2-29 0:0:0", "2015-2-29 0:0:0", "",
                     "2015-1-5 1:2:60", "2015-1-5 24:0:0", "2015-001-5 1:2:3", "2015-1-5 1:2:3Z", "2015-1-5 001:2:3"]),
)


@settings(max_examples=10, deadline=None, derandomize=True)
@given(st.lists(TIME_TEXT, min_size=100, max_size=300))
def test_times_are_parsed_as_strptime_does(spark, texts):
    from datetime import datetime

    def python(s):
        try:
            return datetime.strptime(s, "%Y-%m-%d %H:%M:%S")
        except ValueError:
            return None

    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", to_wall_clock(F.col("t")).alias("w")).collect():
        assert r.w == python(r.t), repr(r.t)
