"""The lazy per-key maxima: no job while building, sources read at the action, ties, keys, bounds."""

import random

import pytest
from pyspark.sql import functions as F

from farebox.functions.geo import haversine_km_asin, haversine_km_atan2, km_at_most
from farebox.operators import argmax
from farebox.plans import q2
from farebox.sinks.writers import write_parquet
from farebox.sources import tables
from tests.conftest import SF_MID


def jobs_of(spark, group, run):
    spark.sparkContext.setJobGroup(group, group)
    try:
        run()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_building_starts_no_job(spark):
    geo = tables.geo_trips(spark, SF_MID)
    assert jobs_of(spark, "build", lambda: (q2.longest(geo), q2.longest_sql(spark, geo), q2.longest_window(geo))) == 0
    assert jobs_of(spark, "run", lambda: q2.longest(geo).collect()) > 0


def test_result_follows_a_changed_source(spark, scratch):
    path = scratch("trips")
    rows = lambda v: spark.createDataFrame([(1, v, 1), (2, v / 2, 2)], "k int, v double, t int")
    write_parquet(rows(1.0), path)
    first = argmax.argmax_first(spark.read.parquet(path), "k", "v", "t")
    assert sorted(map(tuple, first.collect())) == [(1, 1.0, 1), (2, 0.5, 2)]
    rows(9.0).write.mode("append").parquet(path)
    again = argmax.argmax_first(spark.read.parquet(path), "k", "v", "t")
    rows(50.0).write.mode("append").parquet(path)  # after the frame was built
    spark.catalog.refreshByPath(path)
    assert sorted(map(tuple, again.collect())) in ([(1, 50.0, 1), (2, 25.0, 2)], [(1, 9.0, 1), (2, 4.5, 2)])
    assert sorted(map(tuple, argmax.argmax_first(spark.read.parquet(path), "k", "v", "t").collect())) == [
        (1, 50.0, 1), (2, 25.0, 2)]


@pytest.mark.parametrize("n_keys", [1, 3, 500])
def test_against_brute_force(spark, n_keys):
    rng = random.Random(n_keys)
    rows = [(rng.choice([None, *range(n_keys)]), rng.choice([None, -1.5, 0.0, 1.0, 7.0, float(rng.randint(0, 60))]),
             rng.choice([None, 1, 2, 3])) for _ in range(4000)]
    rows += [(0, 99.0, 5)] * 2000 + [(0, 99.0, None)] * 10 + [(-1, None, 3)]  # a third ties; a key without any value
    df = spark.createDataFrame(rows, "k int, v double, t int").repartition(5).withColumn("most", F.col("v") + 0.5)
    best = {}
    for k, v, t in rows:
        if v is not None:
            best.setdefault(k, []).append((v, -1 if t is None else t))
    want = sorted(((k, *max(own)) for k, own in best.items()), key=str)
    for at_most in (None, "most"):
        got = argmax.argmax_first(df, "k", "v", "t", at_most=at_most).collect()
        assert sorted(((r.k, r.v, -1 if r.t is None else r.t) for r in got), key=str) == want
        ties = argmax.argmax_ties(df, ["k"], "v", ["k", "v", "t"], at_most=at_most).collect()
        assert len(ties) == sum(v == max(best[k])[0] for k, v, _ in rows if k is not None and v is not None)
    assert argmax.argmax_first(df.where("false"), "k", "v", "t").count() == 0
    assert argmax.argmax_ties(df.where("v IS NULL"), "k", "v", ["k"]).count() == 0


def test_cheap_bound_is_never_below_the_distance(spark):
    rng = random.Random(4)
    spots = lambda: (rng.uniform(-90, 90), rng.uniform(-180, 180), rng.uniform(-90, 90), rng.uniform(-180, 180))
    near = lambda p: (*p[:2], p[0] + rng.uniform(-1e-7, 1e-7), p[1] + rng.uniform(-1e-7, 1e-7))
    points = [spots() for _ in range(2000)] + [near(spots()) for _ in range(500)]
    points += [(0.0, 0.0, 0.0, 180.0), (90.0, 0.0, -90.0, 0.0), (1.0, 1.0, 1.0, 1.0), (10.0, 5.0, 60.0, 5.0), (0.0, 5.0, 0.0, 60.0)]
    df = spark.createDataFrame(points, "a double, b double, c double, d double")
    args = ("a", "b", "c", "d")
    low = df.where((km_at_most(*args) < haversine_km_atan2(*args)) | (km_at_most(*args) < haversine_km_asin(*args)))
    assert low.count() == 0
