"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator / whole query.  Each reads the driver tables (or files Spark writes
from them), runs over all rows, and rounds floating results the same way as
its SQL twin in ``farebox.oracle``."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from farebox import jobs
from farebox.functions.format import VENDOR_RECORD, csv_record, fixed_record, vendor_line
from farebox.functions.geo import haversine_km_asin, haversine_km_atan2, nonzero_points
from farebox.functions.parse import fields, to_double, to_int, to_wall_clock
from farebox.functions.temporal import hour_in_wrapped_range, hour_of, minutes_between, pickup_before_dropoff
from farebox.functions.udfs import hour_udf
from farebox.operators import aggregates as agg
from farebox.operators import argmax, joins, ordering
from farebox.plans import q1, q2
from farebox.plans import zones as zq
from farebox.schemas import FIELD, MONEY_TOTALS, TRIP_COLUMNS_19, TRIP_SCHEMA
from farebox.session import checkpoint_root, scratch_path
from farebox.sinks import writers
from farebox.sinks.etl import csv_to_parquet
from farebox.sources import csv as csv_src
from farebox.sources import rawfiles, read_csv_remembered, read_merged, tables, text

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def wrap(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return wrap


TS_SEC = "yyyy-MM-dd HH:mm:ss"
TS_MICRO = "yyyy-MM-dd HH:mm:ss.SSSSSS"
Q1_SCHEMA = StructType([StructField("hour", IntegerType()), StructField("avg_latitude", DoubleType()),
                        StructField("avg_longitude", DoubleType())])
Q3_SCHEMA = StructType([StructField("Borough", StringType()), StructField("TotalTrips", LongType())])


def _r(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    """Round the named double columns (order of float sums differs by engine)."""
    return df.withColumns({c: F.round(c, d) for c, d in digits.items()})


def _r_q1(df: DataFrame) -> DataFrame:
    return _r(df, {"avg_latitude": 6, "avg_longitude": 6})


def _r_q2(df: DataFrame) -> DataFrame:
    return _r(df, {"haversine_km": 6, "duration_min": 4})


def _r_money(df: DataFrame) -> DataFrame:
    return _r(df, {a: 2 for _, a in MONEY_TOTALS if a in df.columns})


def _geo(spark, sf):
    return tables.geo_trips(spark, sf)


def _loc(spark, sf):
    return tables.loc_trips(spark, sf)


def _zones(spark, sf):
    return tables.zones(spark, sf)


def _geo_lines(spark, sf) -> DataFrame:
    return text.read_lines(spark, rawfiles.write_geo_csv(spark, sf))


def _loc_csv(spark, sf) -> tuple[DataFrame, DataFrame]:
    trips = csv_src.read_csv_inferred(spark, rawfiles.write_loc_csv(spark, sf))
    zones = csv_src.read_csv_inferred(spark, rawfiles.write_zones_csv(spark, sf))
    return trips, zones


def _geo_csv_fixed(spark, sf) -> DataFrame:
    return csv_src.read_csv_with_schema(spark, rawfiles.write_geo_csv(spark, sf), TRIP_SCHEMA)


def _geo_text_rows(spark, sf) -> DataFrame:
    parsed = text.parse_lines(text.strip_header(_geo_lines(spark, sf)), q2.TEXT_SPEC)
    return parsed.select(
        "VendorID",
        F.date_format("tpep_pickup_datetime", TS_SEC).alias("pickup"),
        F.date_format("tpep_dropoff_datetime", TS_SEC).alias("dropoff"),
        "pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude")


def _role_rows(spark, sf, columns: list[str], extra=None) -> DataFrame:
    return joins.role_playing_join(_loc(spark, sf), _zones(spark, sf).select("LocationID", *columns), "LocationID",
                                   [("PULocationID", "pu"), ("DOLocationID", "dz")], extra=extra)


# ---------------------------------------------------------------- sources
@register("src_csv_schema")
def src_csv_schema(spark, sf):
    df = csv_src.read_csv_with_schema(spark, rawfiles.write_geo_csv(spark, sf), TRIP_SCHEMA)
    return df.select("VendorID", F.date_format("tpep_pickup_datetime", TS_SEC).alias("pickup"),
                     F.date_format("tpep_dropoff_datetime", TS_SEC).alias("dropoff"), "passenger_count",
                     "trip_distance", "pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude",
                     "total_amount")


@register("src_csv_infer")
def src_csv_infer(spark, sf):
    return csv_src.read_csv_inferred(spark, rawfiles.write_loc_csv(spark, sf))


@register("src_parquet")
def src_parquet(spark, sf):
    return _geo(spark, sf).select("event_id", "VendorID", F.date_format("tpep_pickup_datetime", TS_MICRO).alias("pickup"),
                                  "trip_distance", "pickup_latitude", "pickup_longitude")


@register("src_text_lenient")
def src_text_lenient(spark, sf):
    return _geo_text_rows(spark, sf)


@register("src_text_strip_header")
def src_text_strip_header(spark, sf):
    """Every remaining line, split whole into its 19 typed fields."""
    lines = text.strip_header(_geo_lines(spark, sf))
    parts = fields("value")
    typed = []
    for idx, (name, dtype) in enumerate(TRIP_COLUMNS_19):
        raw = F.get(parts, idx)
        if dtype.typeName() == "timestamp":
            typed.append(F.date_format(to_wall_clock(raw), TS_SEC).alias(name))
        elif dtype.typeName() == "string":
            typed.append(raw.alias(name))
        else:
            typed.append(raw.try_cast(dtype).alias(name))
    return lines.select(*typed)


@register("view_sql")
def view_sql(spark, sf):
    return spark.sql("""
        SELECT VendorID,
               HOUR(tpep_pickup_datetime) AS pickup_hour,
               (unix_timestamp(tpep_dropoff_datetime) - unix_timestamp(tpep_pickup_datetime)) / 60 AS duration_min
        FROM {trips}""", trips=_geo(spark, sf))


DAMAGED_SPEC = [(0, "VendorID", "int"), (1, "pickup", "timestamp"), (3, "latitude", "int")]


@register("src_text_drops")
def src_text_drops(spark, sf):
    """Lines of events, some damaged: how many are kept, and why the others go, counted while they are parsed."""
    eid = F.col("event_id")
    vendor = F.when(eid % 7 == 0, "x").otherwise((eid % 3).cast("string"))
    pickup = F.when(eid % 11 == 0, "2015-13-01 00:00:00").when(eid % 5 == 0, "2015-1-5 7:05:9").otherwise("2015-01-05 07:05:09")
    whole = F.concat_ws(",", vendor, pickup, F.lit("N"), eid.cast("string"))
    line = F.when(eid % 13 == 0, F.substring_index(whole, ",", 3)).otherwise(whole)
    path = writers.write_text(tables.table(spark, sf, "events"), scratch_path(spark, "damaged"), line)
    seen = Observation()
    parsed = text.parse_lines(text.read_lines(spark, path), DAMAGED_SPEC, seen=seen)
    writers.write_parquet(parsed, scratch_path(spark, "parsed"))  # the one pass that parses, counts and keeps
    return spark.createDataFrame(text.line_counts(seen), "reason string, lines long")


@register("src_csv_remembered")
def src_csv_remembered(spark, sf):
    """The second read takes the schema that the first one left beside the file."""
    path = writers.write_csv(_loc(spark, sf), scratch_path(spark, "loc_csv"))
    read_csv_remembered(spark, path)
    return read_csv_remembered(spark, path)


def _months(spark, sf) -> list[str]:
    """The trips in three files that spell, type, order and have their columns differently."""
    loc = _loc(spark, sf).withColumn("pick", F.coalesce("PULocationID", F.lit(0)) % 3)
    first = loc.where("pick = 0").drop("pick")
    second = loc.where("pick = 1").drop("pick").withColumnRenamed("airport_fee", "Airport_fee").withColumns(
        {"PULocationID": F.col("PULocationID").cast("long"), "DOLocationID": F.col("DOLocationID").cast("double")})
    third = loc.where("pick = 2").select(
        *[F.col(c) for c in reversed(loc.columns) if c not in ("pick", "airport_fee")], F.col("airport_fee").alias("AIRPORT_FEE"),
        F.lit("x").alias("note"))
    return [writers.write_parquet(df, scratch_path(spark, f"month{i}")) for i, df in enumerate((first, second, third))]


@register("src_merged_schemas")
def src_merged_schemas(spark, sf):
    return read_merged(spark, _months(spark, sf))


# ---------------------------------------------------------------- sinks
@register("sink_csv_single")
def sink_csv_single(spark, sf):
    base = scratch_path(spark, "outputs")
    path = writers.write_csv_single(q1.hourly_avg(_geo(spark, sf)), writers.run_scoped_path(spark, base, "q1"))
    return _r_q1(spark.read.csv(path, header=True, schema=Q1_SCHEMA))


@register("sink_csv_overwrite")
def sink_csv_overwrite(spark, sf):
    path = scratch_path(spark, "q3_out")
    writers.write_csv(_zones(spark, sf), path)  # something already at the path
    writers.write_csv(zq.same_borough(_loc(spark, sf), _zones(spark, sf)), path)  # replaces it
    return spark.read.csv(path, header=True, schema=Q3_SCHEMA)


@register("sink_parquet")
def sink_parquet(spark, sf):
    return spark.read.parquet(writers.write_parquet(_loc(spark, sf), scratch_path(spark, "loc_parquet")))


@register("sink_text")
def sink_text(spark, sf):
    result = q1.hourly_avg(_geo(spark, sf))
    path = writers.write_text(result, scratch_path(spark, "q1_text"), csv_record("hour", "avg_latitude", "avg_longitude"))
    parts = fields("value")
    back = spark.read.text(path).select(to_int(F.get(parts, 0)).alias("hour"),
                                        to_double(F.get(parts, 1)).alias("avg_latitude"),
                                        to_double(F.get(parts, 2)).alias("avg_longitude"))
    return _r_q1(back)


@register("sink_text_fixed")
def sink_text_fixed(spark, sf):
    """Longest trips as fixed-format text records, read back as numbers."""
    result = q2.longest_text(_geo_lines(spark, sf))
    path = writers.write_text(result, scratch_path(spark, "q2_text"),
                              fixed_record(VENDOR_RECORD, "VendorID", "haversine_km", "duration_min"))
    parts = fields("value")
    return spark.read.text(path).select(to_int(F.get(parts, 0)).alias("VendorID"),
                                        to_double(F.get(parts, 1)).alias("haversine_km"),
                                        to_double(F.get(parts, 2)).alias("duration_min"))


@register("sink_parquet_balanced")
def sink_parquet_balanced(spark, sf):
    return spark.read.parquet(writers.write_parquet(_loc(spark, sf), scratch_path(spark, "loc_parquet"), balance=True))


@register("etl_csv_to_parquet")
def etl_csv_to_parquet(spark, sf):
    jobs = [(name, writer(spark, sf), scratch_path(spark, f"{name}_parquet"))
            for name, writer in [("geo_trips", rawfiles.write_geo_csv), ("loc_trips", rawfiles.write_loc_csv),
                                 ("zones", rawfiles.write_zones_csv)]]
    return csv_to_parquet(spark, jobs)


@register("preview_take")
def preview_take(spark, sf):
    rows = _geo_text_rows(spark, sf)
    order = ["pickup", "dropoff", "VendorID", "pickup_longitude", "pickup_latitude", "dropoff_longitude",
             "dropoff_latitude"]
    return ordering.head(rows, 5, [F.col(c).asc() for c in order])


# ---------------------------------------------------------------- projections / expressions
@register("proj_hour")
def proj_hour(spark, sf):
    return _geo(spark, sf).select("VendorID", hour_of("tpep_pickup_datetime").alias("hour"))


@register("proj_duration_min")
def proj_duration_min(spark, sf):
    return _geo(spark, sf).select("VendorID", minutes_between("tpep_pickup_datetime", "tpep_dropoff_datetime")
                                  .alias("duration_min"))


POINT_ARGS = ("pickup_latitude", "pickup_longitude", "dropoff_latitude", "dropoff_longitude")


@register("proj_haversine_atan2")
def proj_haversine_atan2(spark, sf):
    return _geo(spark, sf).select("VendorID", F.round(haversine_km_atan2(*POINT_ARGS), 6).alias("haversine_km"))


@register("proj_haversine_asin")
def proj_haversine_asin(spark, sf):
    return _geo(spark, sf).select("VendorID", F.round(haversine_km_asin(*POINT_ARGS), 6).alias("haversine_km"))


@register("proj_rounded_alias")
def proj_rounded_alias(spark, sf):
    return _geo(spark, sf).select(
        "VendorID",
        F.round(haversine_km_asin(*POINT_ARGS), 2).alias("Haversine Distance (km)"),
        F.round(minutes_between("tpep_pickup_datetime", "tpep_dropoff_datetime"), 1).alias("Duration (min)"))


@register("fn_parse")
def fn_parse(spark, sf):
    parts = fields("value")
    lines = text.strip_header(_geo_lines(spark, sf))
    return lines.select(
        to_int(F.get(parts, FIELD["VendorID"])).alias("VendorID"),
        F.date_format(to_wall_clock(F.get(parts, FIELD["tpep_pickup_datetime"])), TS_SEC).alias("pickup"),
        to_double(F.get(parts, FIELD["pickup_latitude"])).alias("pickup_latitude"),
        to_double(F.get(parts, FIELD["pickup_longitude"])).alias("pickup_longitude"))


@register("fn_format")
def fn_format(spark, sf):
    return q1.report_lines(q1.hourly_avg(_geo(spark, sf)))


@register("fn_format_vendor")
def fn_format_vendor(spark, sf):
    result = q2.longest_text(_geo_lines(spark, sf))
    return result.select("VendorID", vendor_line("VendorID", "haversine_km", "duration_min").alias("line"))


@register("udf_hour")
def udf_hour(spark, sf):
    return _geo(spark, sf).select("VendorID", hour_udf("tpep_pickup_datetime").alias("hour"))


# ---------------------------------------------------------------- filters
@register("filter_nonzero_pickup")
def filter_nonzero_pickup(spark, sf):
    return (_geo(spark, sf).where(nonzero_points("pickup_latitude", "pickup_longitude"))
            .select("VendorID", "pickup_latitude", "pickup_longitude"))


@register("filter_nonzero_all")
def filter_nonzero_all(spark, sf):
    return _geo(spark, sf).where(nonzero_points(*q2.POINTS)).select("VendorID", *q2.POINTS)


@register("filter_forward_time")
def filter_forward_time(spark, sf):
    return (_geo(spark, sf).where(pickup_before_dropoff("tpep_pickup_datetime", "tpep_dropoff_datetime"))
            .select("VendorID", minutes_between("tpep_pickup_datetime", "tpep_dropoff_datetime").alias("duration_min")))


@register("filter_night_wrap")
def filter_night_wrap(spark, sf):
    return (_geo(spark, sf).where(hour_in_wrapped_range("tpep_pickup_datetime", 23, 7))
            .select("VendorID", hour_of("tpep_pickup_datetime").alias("hour")))


@register("filter_same_attr")
def filter_same_attr(spark, sf):
    rows = _role_rows(spark, sf, ["Borough"])
    return (rows.where(F.col("pu.Borough") == F.col("dz.Borough"))
            .select("PULocationID", "DOLocationID", F.col("pu.Borough").alias("Borough"), "fare_amount"))


@register("filter_diff_attr")
def filter_diff_attr(spark, sf):
    rows = _role_rows(spark, sf, ["Zone"])
    return (rows.where(F.col("pu.Zone") != F.col("dz.Zone"))
            .select("PULocationID", "DOLocationID", F.col("pu.Zone").alias("Pickup_Zone"),
                    F.col("dz.Zone").alias("Dropoff_Zone")))


# ---------------------------------------------------------------- joins
@register("join_lookup")
def join_lookup(spark, sf):
    z = _zones(spark, sf).select("LocationID", "Borough")
    return (joins.lookup_join(_loc(spark, sf), z, F.col("PULocationID") == F.col("LocationID"))
            .select("PULocationID", "Borough", "fare_amount", "total_amount"))


@register("join_role_playing")
def join_role_playing(spark, sf):
    return _role_rows(spark, sf, ["Borough", "Zone"]).select(
        "PULocationID", "DOLocationID", F.col("pu.Borough").alias("pickup_borough"),
        F.col("dz.Borough").alias("dropoff_borough"), F.col("pu.Zone").alias("pickup_zone"),
        F.col("dz.Zone").alias("dropoff_zone"))


@register("join_cross_dim_equi")
def join_cross_dim_equi(spark, sf):
    rows = _role_rows(spark, sf, ["Borough"], extra=F.col("pu.Borough") == F.col("dz.Borough"))
    return rows.select("PULocationID", "DOLocationID", F.col("pu.Borough").alias("Borough"), "total_amount")


@register("join_theta_residual")
def join_theta_residual(spark, sf):
    rows = _role_rows(spark, sf, ["Zone"], extra=F.col("pu.Zone") != F.col("dz.Zone"))
    return rows.select("PULocationID", "DOLocationID", F.col("pu.Zone").alias("Pickup_Zone"),
                       F.col("dz.Zone").alias("Dropoff_Zone"), "total_amount")


@register("join_argmax_back")
def join_argmax_back(spark, sf):
    return _r_q2(argmax.argmax_ties(q2.with_distance(_geo(spark, sf)), "VendorID", "haversine_km", q2.OUTPUT,
                                    method="join", at_most="km_at_most"))


@register("join_argmax_back_rank")
def join_argmax_back_rank(spark, sf):
    return _r_q2(argmax.argmax_ties(q2.with_distance(_geo(spark, sf)), "VendorID", "haversine_km", q2.OUTPUT,
                                    method="rank"))


# ---------------------------------------------------------------- aggregates
@register("agg_avg_by_hour")
def agg_avg_by_hour(spark, sf):
    rows = _geo(spark, sf).select(hour_of("tpep_pickup_datetime").alias("hour"), "pickup_latitude", "pickup_longitude")
    return _r_q1(agg.avg_by(rows, "hour", q1.MEANS))


@register("agg_count_by_key")
def agg_count_by_key(spark, sf):
    return agg.count_by(_geo(spark, sf), "VendorID", "trips")


@register("agg_count_by_pair")
def agg_count_by_pair(spark, sf):
    return zq.pair_counts(_loc(spark, sf))


@register("agg_sum_multi")
def agg_sum_multi(spark, sf):
    return _r_money(agg.sum_by(_loc(spark, sf), "PULocationID", MONEY_TOTALS))


@register("agg_sum_exact")
def agg_sum_exact(spark, sf):
    """Not rounded: the exact sums equal those of decimals, bit by bit."""
    return agg.exact_sum_by(_loc(spark, sf), "PULocationID", MONEY_TOTALS)


@register("agg_max_by_key")
def agg_max_by_key(spark, sf):
    return _r(agg.max_by_key(q2.with_distance(_geo(spark, sf)), "VendorID", "haversine_km", "max_km"), {"max_km": 6})


@register("agg_mean_from_sums")
def agg_mean_from_sums(spark, sf):
    geo = _geo(spark, sf).where(nonzero_points("pickup_latitude", "pickup_longitude"))
    rows = geo.select(hour_of("tpep_pickup_datetime").alias("hour"), "pickup_latitude", "pickup_longitude")
    return _r_q1(agg.mean_from_sums(rows, "hour", q1.MEANS))


@register("argmax_window")
def argmax_window(spark, sf):
    return _r_q2(q2.longest_window(_geo(spark, sf)))


@register("argmax_max_by")
def argmax_max_by(spark, sf):
    return _r_q2(q2.longest(_geo(spark, sf)))


# ---------------------------------------------------------------- ordering
@register("sort_key_asc")
def sort_key_asc(spark, sf):
    ordered = ordering.sort_asc(_geo(spark, sf), "tpep_pickup_datetime")
    return ordered.select(F.date_format("tpep_pickup_datetime", TS_MICRO).alias("pickup"), "VendorID", "trip_distance")


@register("sort_measure_desc")
def sort_measure_desc(spark, sf):
    return ordering.sort_desc(_loc(spark, sf), "total_amount").select("PULocationID", "DOLocationID", "total_amount")


@register("topk_pairs")
def topk_pairs(spark, sf):
    return zq.top_zone_pairs(_loc(spark, sf), _zones(spark, sf))


@register("topk_display")
def topk_display(spark, sf):
    result = zq.revenue_by_borough(_loc(spark, sf), _zones(spark, sf))
    top = ordering.head(result, 5, [F.col("Total_Revenue").desc(), F.col("Borough").asc()])
    return _r_money(top.select("Borough", "Total_Revenue"))


# ---------------------------------------------------------------- whole queries
@register("q1_hourly_avg")
def q1_hourly_avg(spark, sf):
    return _r_q1(q1.hourly_avg(_geo(spark, sf)))


@register("q1_udf")
def q1_udf(spark, sf):
    return _r_q1(q1.hourly_avg_udf(_geo(spark, sf)))


@register("q1_text")
def q1_text(spark, sf):
    return _r_q1(q1.hourly_avg_text(_geo_lines(spark, sf)))


@register("q1_hourly_avg_csv")
def q1_hourly_avg_csv(spark, sf):
    """Q1 from the raw trip CSV read with the fixed positional schema."""
    return _r_q1(q1.hourly_avg(_geo_csv_fixed(spark, sf)))


@register("q1_udf_csv")
def q1_udf_csv(spark, sf):
    return _r_q1(q1.hourly_avg_udf(_geo_csv_fixed(spark, sf)))


@register("q2_window")
def q2_window(spark, sf):
    return _r_q2(q2.longest_window(_geo(spark, sf)))


@register("q2_window_csv")
def q2_window_csv(spark, sf):
    return _r_q2(q2.longest_window(_geo_csv_fixed(spark, sf)))


@register("q2_sql")
def q2_sql(spark, sf):
    return q2.longest_sql(spark, _geo(spark, sf))


@register("q2_sql_csv")
def q2_sql_csv(spark, sf):
    """Q2 SQL over the raw trip CSV with an inferred schema."""
    return q2.longest_sql(spark, csv_src.read_csv_inferred(spark, rawfiles.write_geo_csv(spark, sf)))


@register("q2_text")
def q2_text(spark, sf):
    return _r_q2(q2.longest_text(_geo_lines(spark, sf)))


@register("q2_edge")
def q2_edge(spark, sf):
    """Q2 where fixes are not finite and many trips tie at the maximum."""
    return _r_q2(q2.longest(tables.geo_edge_trips(spark, sf)))


@register("q2_edge_window")
def q2_edge_window(spark, sf):
    return _r_q2(q2.longest_window(tables.geo_edge_trips(spark, sf)))


@register("q2_edge_sql")
def q2_edge_sql(spark, sf):
    return q2.longest_sql(spark, tables.geo_edge_trips(spark, sf))


@register("q2_edge_text")
def q2_edge_text(spark, sf):
    return _r_q2(q2.longest_text(text.read_lines(spark, rawfiles.write_geo_edge_csv(spark, sf))))


@register("proj_haversine_edge")
def proj_haversine_edge(spark, sf):
    """Both distance forms; null where a coordinate is not finite."""
    return tables.geo_edge_trips(spark, sf).select(
        "event_id", F.round(haversine_km_atan2(*POINT_ARGS), 6).alias("km_atan2"),
        F.round(haversine_km_asin(*POINT_ARGS), 6).alias("km_asin"))


@register("q3_df")
def q3_df(spark, sf):
    return zq.same_borough(_loc(spark, sf), _zones(spark, sf))


@register("q3_df_csv")
def q3_df_csv(spark, sf):
    return zq.same_borough(*_loc_csv(spark, sf))


@register("q3_sql")
def q3_sql(spark, sf):
    return zq.same_borough_sql(spark, _loc(spark, sf), _zones(spark, sf))


@register("q3_sql_csv")
def q3_sql_csv(spark, sf):
    return zq.same_borough_sql(spark, *_loc_csv(spark, sf))


@register("q4_night")
def q4_night(spark, sf):
    return zq.night_trips_sql(spark, _geo(spark, sf))


@register("q4_night_csv")
def q4_night_csv(spark, sf):
    return zq.night_trips_sql(spark, csv_src.read_csv_inferred(spark, rawfiles.write_geo_csv(spark, sf)))


@register("q4_night_converted")
def q4_night_converted(spark, sf):
    """Q4 over a converted table that stores the pickup hour; the hour test reaches the scan."""
    path = scratch_path(spark, "geo_hours_parquet")
    csv_to_parquet(spark, [("trips", rawfiles.write_geo_csv(spark, sf), path)], hours={"trips": "tpep_pickup_datetime"})
    return zq.night_trips_sql(spark, spark.read.parquet(path))


@register("q5_top_pairs")
def q5_top_pairs(spark, sf):
    return zq.top_zone_pairs(_loc(spark, sf), _zones(spark, sf))


@register("q5_top_pairs_csv")
def q5_top_pairs_csv(spark, sf):
    return zq.top_zone_pairs(*_loc_csv(spark, sf))


@register("q6_revenue")
def q6_revenue(spark, sf):
    return _r_money(zq.revenue_by_borough(_loc(spark, sf), _zones(spark, sf)))


@register("q6_revenue_csv")
def q6_revenue_csv(spark, sf):
    """Q6 over trip and zone CSV files with inferred schemas."""
    return _r_money(zq.revenue_by_borough(*_loc_csv(spark, sf)))


@register("q6_merged_months")
def q6_merged_months(spark, sf):
    """Q6 over files whose schemas differ."""
    return _r_money(zq.revenue_by_borough(read_merged(spark, _months(spark, sf)), _zones(spark, sf)))


# Job, its input file, and whether it needs the zones.
JOB_INPUTS = [("q1", "geo", False), ("q1-udf", "geo", False), ("q1-text", "geo", False), ("q2", "geo", False), ("q2-sql", "geo", False),
              ("q2-text", "geo", False), ("q3", "loc", True), ("q3-sql", "loc", True), ("q4", "geo", False), ("q5", "loc", True),
              ("q6", "loc", True)]


@register("jobs_all_udf")
def jobs_all_udf(spark, sf):
    """Every command-line job over the raw files: rows of what it wrote below a run-scoped folder."""
    files = {"geo": rawfiles.write_geo_csv(spark, sf), "loc": rawfiles.write_loc_csv(spark, sf)}
    counts = []
    for job, trips, zones in JOB_INPUTS:
        named = ["--zones", rawfiles.write_zones_csv(spark, sf)] if zones else []
        args = jobs.parse_args([job, "--trips", files[trips], *named, "--out", f"{scratch_path(spark, 'jobs')}/{job}", "--run-scoped",
                                "--show", "0"])
        out = jobs.run(spark, args)
        written = spark.read.text(out) if job.endswith("-text") else spark.read.csv(out, header=True)
        counts.append(written.agg(F.lit(job).alias("job"), F.count(F.lit(1)).alias("rows")))
    return reduce(DataFrame.unionByName, counts)


SHUFFLE_PARTITION_SETTINGS = (8, 32, 64, 128)


@register("q6_partitions_invariant")
def q6_partitions_invariant(spark, sf):
    """Q6 run once per shuffle-partition setting; each run is materialised
    (reliable checkpoint in the shared folder) while its setting is active."""
    checkpoint_root(spark)  # checkpoints go to the session's shared folder
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    runs = []
    try:
        for n in SHUFFLE_PARTITION_SETTINGS:
            spark.conf.set(key, str(n))
            run = _r_money(zq.revenue_by_borough(_loc(spark, sf), _zones(spark, sf)))
            runs.append(run.checkpoint(eager=True).select(F.lit(n).alias("shuffle_partitions"), "*"))
    finally:
        spark.conf.set(key, before)
    out = runs[0]
    for run in runs[1:]:
        out = out.unionByName(run)
    return out
