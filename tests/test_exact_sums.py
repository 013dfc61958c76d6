"""Exact money sums: the same bits under every partitioning and order."""

import math
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from farebox.operators.aggregates import exact_sum_by, sum_by
from farebox.plans import zones as zq
from farebox.schemas import MONEY_TOTALS
from farebox.sinks.writers import write_parquet
from farebox.sources import tables
from tests.conftest import SF_MID

SUMS = [("v", "total")]


def test_equal_to_decimals_in_any_order(spark):
    rng = random.Random(8)
    values = [round(rng.uniform(-1e6, 1e6), 4) for _ in range(5000)] + [1e9, -1e9, 0.0001, -0.0001, 123456789.1234]
    rows = [(rng.choice("ab"), rng.choice([v, None])) for v in values] + [("c", None)]
    want = {}
    for k, v in rows:
        if v is not None:
            want[k] = want.get(k, Decimal(0)) + Decimal(repr(v))
    for seed, parts in ((0, 1), (1, 3), (2, 17)):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, "k string, v double").repartition(parts)
        got = {r.k: r.total for r in exact_sum_by(df, "k", SUMS).collect()}
        assert got == {"a": float(want["a"]), "b": float(want["b"]), "c": None}


def test_values_that_are_no_units(spark):
    rows = [("nan", math.nan), ("nan", 1.0), ("inf", math.inf), ("inf", 2.5), ("both", math.inf), ("both", -math.inf),
            ("big", 1e300), ("big", 1.5), ("half", 0.00005), ("half", 0.00025)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r.k: r.total for r in exact_sum_by(df, "k", SUMS).collect()}
    assert math.isnan(got["nan"]) and got["inf"] == math.inf and math.isnan(got["both"]) and got["big"] == 1e300
    assert got["half"] == 0.0002  # each rounded half to even at the fourth digit
    whole = {r.k: r.total for r in exact_sum_by(df.where("k = 'half'"), "k", SUMS, digits=6).collect()}
    assert whole == {"half": 0.0003}


def test_halves_hold_many_rows(spark):
    df = spark.range(3_000_000).select(F.lit(1).alias("k"), F.when(F.col("id") % 2 == 0, 104857.5999).otherwise(-0.0001).alias("v"))
    assert exact_sum_by(df, "k", SUMS).first().total == float(Decimal("104857.5999") * 1_500_000 - 150)


@pytest.mark.parametrize("n", [8, 32, 64, 128])
def test_revenue_is_bit_equal_unrounded(spark, scratch, n):
    loc, zones = tables.loc_trips(spark, SF_MID), tables.zones(spark, SF_MID)
    path = write_parquet(loc.repartition(n), scratch(f"loc{n}"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    try:
        got = sorted(map(tuple, zq.revenue_by_borough(spark.read.parquet(path), zones).collect()), key=str)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == sorted(map(tuple, zq.revenue_by_borough(loc, zones).collect()), key=str)
    named = loc.join(zones, loc.PULocationID == zones.LocationID)
    plain = {r[0]: r[1:] for r in sum_by(named, "Borough", MONEY_TOTALS).collect()}
    assert all(math.isclose(a, b, rel_tol=1e-9) for r in got for a, b in zip(r[1:], plain[r[0]]))
