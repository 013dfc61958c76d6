"""Q1: mean pickup latitude / longitude per hour of day.

Plan: scan (2 coordinates + pickup time, zero filter pushed into the scan) ->
partial avg per task -> shuffle of at most 24 rows per task -> final avg ->
24-row sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from farebox.functions.geo import nonzero_points
from farebox.functions.temporal import hour_of
from farebox.functions.udfs import hour_udf
from farebox.operators.aggregates import avg_by, mean_from_sums
from farebox.schemas import FIELD
from farebox.sources.text import parse_lines, strip_header

MEANS = [("pickup_latitude", "avg_latitude"), ("pickup_longitude", "avg_longitude")]

# Fields read by the text form: pickup time, pickup latitude, pickup longitude.
TEXT_SPEC = [
    (FIELD["tpep_pickup_datetime"], "tpep_pickup_datetime", "timestamp"),
    (FIELD["pickup_latitude"], "pickup_latitude", "double"),
    (FIELD["pickup_longitude"], "pickup_longitude", "double"),
]


def _valid(trips: DataFrame) -> DataFrame:
    return trips.where(nonzero_points("pickup_latitude", "pickup_longitude"))


def hourly_avg(trips: DataFrame) -> DataFrame:
    """Native: ``hour()`` + ``avg``.  A null pickup time forms a null hour group."""
    with_hour = _valid(trips).select(hour_of("tpep_pickup_datetime").alias("hour"), *[c for c, _ in MEANS])
    return avg_by(with_hour, "hour", MEANS).orderBy("hour")


def hourly_avg_udf(trips: DataFrame) -> DataFrame:
    """Same, with the hour computed by the Arrow-batched Python UDF (slow path)."""
    with_hour = _valid(trips).select(hour_udf("tpep_pickup_datetime").alias("hour"), *[c for c, _ in MEANS])
    return avg_by(with_hour, "hour", MEANS).orderBy("hour")


def hourly_avg_text(lines: DataFrame, header: str | None = None, seen: Observation | None = None) -> DataFrame:
    """From raw lines: a line whose pickup time or pickup point does not parse
    is dropped (no null-hour group); means merged from (sum, sum, count)."""
    parsed = parse_lines(strip_header(lines, header), TEXT_SPEC, seen=seen)
    with_hour = _valid(parsed).select(hour_of("tpep_pickup_datetime").alias("hour"), *[c for c, _ in MEANS])
    return mean_from_sums(with_hour, "hour", MEANS).orderBy("hour")


def report_lines(result: DataFrame) -> DataFrame:
    """``Hour: 07 | Avg Latitude: ... | Avg Longitude: ...`` per row, hour order."""
    from farebox.functions.format import hourly_line

    return result.select(F.col("hour"), hourly_line("hour", "avg_latitude", "avg_longitude").alias("line")).orderBy("hour")
