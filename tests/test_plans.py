"""Physical-plan properties that matter at scale."""

import re

from farebox import jobs
from farebox.functions.geo import nonzero_points
from farebox.plans import q1, q2
from farebox.plans import zones as zq
from farebox.sinks.etl import csv_to_parquet
from farebox.sinks.writers import write_parquet
from farebox.sources import rawfiles, read_csv_inferred, tables, text
from tests.conftest import SF_MID, SF_SMALL, explain_text


def test_top_k_is_fused(spark):
    plan = explain_text(zq.top_zone_pairs(tables.loc_trips(spark, SF_SMALL), tables.zones(spark, SF_SMALL)))
    assert "TakeOrderedAndProject" in plan


def test_window_top1_limits_before_shuffle(spark):
    plan = explain_text(q2.longest_window(tables.geo_trips(spark, SF_SMALL)), "simple")
    partial = plan.index("WindowGroupLimit") if "Partial" in plan else -1
    assert "Partial" in plan and "Final" in plan
    # the partial limit sits below (after, in text order) the hash exchange
    assert plan.index("Exchange hashpartitioning") < plan.rindex("Partial") and partial >= 0


def test_longest_trip_forms_do_not_sort_trips(spark):
    geo = tables.geo_trips(spark, SF_SMALL)
    lines = text.read_lines(spark, rawfiles.write_geo_csv(spark, SF_SMALL))
    for form in (q2.longest(geo), q2.longest_text(lines)):
        plan = explain_text(form, "simple")
        assert not re.findall(r"[ +:-]Sort \[", plan) and "Window" not in plan and "Join" not in plan
        assert "Subquery subquery" in plan and "partial_max" in plan
    # the SQL form joins the few trips near a maximum to the maxima; nothing is broadcast from an estimate
    plan = explain_text(q2.longest_sql(spark, geo), "simple")
    assert "Window" not in plan and "Subquery subquery" in plan and "Broadcast" not in plan
    assert len(re.findall("SortMergeJoin", plan)) == 1
    assert "longest" in jobs.JOBS["q2"][0].__code__.co_names


def test_sql_forms_join_in_sql(spark):
    loc, zones = tables.loc_trips(spark, SF_SMALL), tables.zones(spark, SF_SMALL)
    for max_rows, strategy in (("1", "SortMergeJoin"), ("1000000", "BroadcastHashJoin")):
        spark.conf.set("farebox.broadcast.maxRows", max_rows)
        try:
            plan = explain_text(zq.same_borough_sql(spark, loc, zones), "simple")
        finally:
            spark.conf.unset("farebox.broadcast.maxRows")
        assert len(re.findall(rf"{strategy} \[(origin_id|target_id)", plan)) == 2
    assert zq.SAME_BOROUGH_SQL.count("JOIN") == 2 and " JOIN peak " in q2.REPORT_SQL


def test_night_test_reaches_the_scan_of_converted_files(spark, scratch):
    import glob

    import pyarrow.parquet as pq

    path = scratch("hours")
    geo = rawfiles.write_geo_csv(spark, SF_MID)
    csv_to_parquet(spark, [("trips", geo, path)], hours={"trips": "tpep_pickup_datetime"}).collect()
    converted = spark.read.parquet(path)
    want = sorted(map(tuple, zq.night_trips_sql(spark, read_csv_inferred(spark, geo)).collect()), key=str)
    for form in (zq.night_trips_sql(spark, converted), zq.night_trips(converted)):
        plan = explain_text(form, "simple")
        assert ("PushedFilters: [Or(GreaterThanOrEqual(tpep_pickup_datetime_hour,23),LessThan(tpep_pickup_datetime_hour,7))]"
                in plan)
        assert sorted(map(tuple, form.collect()), key=str) == want
    # rows are sorted by the hour, so day-time row groups can be told from night ones
    for f in glob.glob(path + "/*.parquet"):
        hours = [h for h in pq.read_table(f, columns=["tpep_pickup_datetime_hour"]).column(0).to_pylist() if h is not None]
        assert hours == sorted(hours)
    # an hour taken in another zone is not used
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert "tpep_pickup_datetime_hour" not in explain_text(zq.night_trips(spark.read.parquet(path)), "simple")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_only_lookups_are_broadcast(spark):
    plan = explain_text(zq.revenue_by_borough(tables.loc_trips(spark, SF_SMALL), tables.zones(spark, SF_SMALL)),
                        "simple")
    assert "SortMergeJoin" in plan  # line items x orders: both grow with the data
    for block in plan.split("BroadcastExchange")[1:]:
        scanned = block.split("FileScan parquet")[1].split("]")[0] if "FileScan parquet" in block else ""
        assert "l_orderkey" not in scanned and "o_orderkey" not in scanned


def test_aggregates_combine_map_side(spark):
    plan = explain_text(zq.revenue_by_borough(tables.loc_trips(spark, SF_SMALL), tables.zones(spark, SF_SMALL)),
                        "simple")
    assert "partial_sum" in plan
    plan1 = explain_text(q1.hourly_avg(tables.geo_trips(spark, SF_SMALL)), "simple")
    assert "partial_avg" in plan1


def test_no_python_outside_udf(spark):
    geo = tables.geo_trips(spark, SF_SMALL)
    for df in (q1.hourly_avg(geo), q2.longest_window(geo), q2.longest(geo), zq.night_trips_sql(spark, geo)):
        plan = explain_text(df, "simple")
        assert "EvalPython" not in plan and "PythonUDF" not in plan
    assert "ArrowEvalPython" in explain_text(q1.hourly_avg_udf(geo), "simple")


def test_filter_and_columns_reach_parquet_scan(spark, scratch):
    path = write_parquet(tables.geo_trips(spark, SF_SMALL), scratch("geo"))
    df = spark.read.parquet(path)
    plan = explain_text(q1.hourly_avg(df), "simple")
    assert "PushedFilters: [IsNotNull(pickup_latitude), IsNotNull(pickup_longitude), Not(EqualTo(pickup_latitude,0.0))" in plan
    assert "ReadSchema: struct<tpep_pickup_datetime:timestamp_ntz,pickup_longitude:double,pickup_latitude:double>" in plan
    plan2 = explain_text(df.where(nonzero_points("pickup_latitude")).select("VendorID"), "simple")
    assert "ReadSchema: struct<VendorID:int,pickup_latitude:double>" in plan2


def test_trips_are_aggregated_before_the_lookup_joins(spark):
    loc, zones = tables.loc_trips(spark, SF_SMALL), tables.zones(spark, SF_SMALL)
    rounded = lambda df: [tuple(round(x, 2) if isinstance(x, float) else x for x in r) for r in df.collect()]
    build = {"q3": lambda: zq.same_borough(loc, zones), "q3_sql": lambda: zq.same_borough_sql(spark, loc, zones),
             "q5": lambda: zq.top_zone_pairs(loc, zones), "q6": lambda: zq.revenue_by_borough(loc, zones)}
    expected = {k: rounded(b()) for k, b in build.items()}
    for max_rows, join in (("1", "SortMergeJoin ["), ("1000000", "BroadcastHashJoin [")):
        spark.conf.set("farebox.broadcast.maxRows", max_rows)
        try:
            for k, b in build.items():
                plan = explain_text(b(), "simple")
                partial = "partial_sum" if k == "q6" else "partial_count"
                key = "origin_id" if k == "q3_sql" else "PULocationID"
                assert plan.index(join + key) < plan.rindex(partial), k  # the aggregate is below the join
                assert rounded(b()) == expected[k]
        finally:
            spark.conf.unset("farebox.broadcast.maxRows")
