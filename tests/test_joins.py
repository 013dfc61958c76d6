"""The broadcast size proof."""

from pyspark.sql import functions as F

from farebox.operators import joins
from farebox.sources import tables
from tests.conftest import SF_SMALL


def test_small_lookup_fits(spark):
    zones = tables.zones(spark, SF_SMALL)
    assert joins.fits_broadcast(zones)
    assert not joins.fits_broadcast(zones, max_rows=24)      # 25 rows
    assert joins.fits_broadcast(zones, max_rows=25)


def test_byte_bound_counts_string_bytes(spark):
    df = spark.createDataFrame([(i, "x" * 1000) for i in range(10)], "k int, s string")
    # 10 rows x (8 header + 12 int slot + 8 + 1000 string) = 10280 bytes
    assert joins.fits_broadcast(df, max_bytes=10_280)
    assert not joins.fits_broadcast(df, max_bytes=10_279)


def test_nested_types_are_not_broadcast(spark):
    df = spark.range(3).select(F.array("id").alias("a"))
    assert not joins.fits_broadcast(df)


def test_lookup_join_same_rows_either_way(spark):
    from tests.conftest import explain_text

    loc, zones = tables.loc_trips(spark, SF_SMALL), tables.zones(spark, SF_SMALL)
    cond = F.col("PULocationID") == F.col("LocationID")
    hinted = joins.lookup_join(loc, zones, cond)
    assert "BroadcastHashJoin" in explain_text(hinted, "simple")
    unhinted = joins.lookup_join(loc, zones, cond, max_rows=10)  # check fails: sort-merge join
    plan = explain_text(unhinted, "simple")
    assert "SortMergeJoin [PULocationID" in plan and "BroadcastHashJoin [PULocationID" not in plan
    assert hinted.count() == unhinted.count() > 0


def test_trip_view_without_broadcasts_is_identical(spark):
    from farebox.plans import zones as zq
    from tests.conftest import explain_text

    def q6():
        rows = zq.revenue_by_borough(tables.loc_trips(spark, SF_SMALL), tables.zones(spark, SF_SMALL)).collect()
        return [tuple(round(x, 2) if isinstance(x, float) else x for x in r) for r in rows]

    expected = q6()
    spark.conf.set("farebox.broadcast.maxRows", "5")  # region (5 rows) still fits, nothing else does
    try:
        plan = explain_text(tables.loc_trips(spark, SF_SMALL), "simple")
        assert "BroadcastHashJoin [l_suppkey" not in plan and "SortMergeJoin [l_suppkey" in plan
        assert "SortMergeJoin [o_custkey" in plan
        assert q6() == expected
    finally:
        spark.conf.unset("farebox.broadcast.maxRows")


def test_size_check_measures_a_lookup_overwritten_in_place(spark, tmp_path):
    import shutil

    lookup, file = tmp_path / "lookup", tmp_path / "lookup" / "part-0.csv"
    lookup.mkdir()
    file.write_text("".join(f"{i},a\n" for i in range(3)))
    read = lambda: spark.read.csv(str(lookup), schema="k int, s string")
    assert joins.fits_broadcast(read(), max_rows=10)
    (tmp_path / "new.csv").write_text("".join(f"{i},a\n" for i in range(1000)))
    shutil.copy(tmp_path / "new.csv", file)
    assert not joins.fits_broadcast(read(), max_rows=10)
