"""Q2: longest great-circle trip per vendor, with its duration.

A trip with a null or non-finite coordinate has no distance and never wins.
Trips tied on distance: the longest duration counts, in every one-row form.

* ``longest`` -- per-vendor maxima, then the trips not below the least of them;
  no sort.  Keeps the null-vendor group; no pickup<drop-off condition.
* ``longest_window`` -- the same as ``row_number() == 1`` by (km desc, minutes
  desc); a vendor without any distance gets a row of nulls here.
* ``longest_sql`` -- additionally requires pickup before drop-off, uses the
  asin distance, keeps every tied row and drops the null vendor; rounds km to
  2 and minutes to 1 digit under quoted display names.
* ``longest_text`` -- from raw lines; a line whose vendor, times or points do
  not parse is dropped (so is the null vendor).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from farebox.functions.geo import haversine_km_asin, haversine_km_atan2, km_at_most, nonzero_points
from farebox.functions.temporal import minutes_between, pickup_before_dropoff
from farebox.operators.argmax import argmax_first, argmax_window
from farebox.schemas import FIELD
from farebox.sources.text import parse_lines, strip_header

POINTS = ["pickup_latitude", "pickup_longitude", "dropoff_latitude", "dropoff_longitude"]
OUTPUT = ["VendorID", "haversine_km", "duration_min"]

TEXT_SPEC = [
    (FIELD["VendorID"], "VendorID", "int"),
    (FIELD["tpep_pickup_datetime"], "tpep_pickup_datetime", "timestamp"),
    (FIELD["tpep_dropoff_datetime"], "tpep_dropoff_datetime", "timestamp"),
    (FIELD["pickup_longitude"], "pickup_longitude", "double"),
    (FIELD["pickup_latitude"], "pickup_latitude", "double"),
    (FIELD["dropoff_longitude"], "dropoff_longitude", "double"),
    (FIELD["dropoff_latitude"], "dropoff_latitude", "double"),
]


def _measures(distance) -> list:
    return ["VendorID", distance(*POINTS).alias("haversine_km"), km_at_most(*POINTS).alias("km_at_most"),
            minutes_between("tpep_pickup_datetime", "tpep_dropoff_datetime").alias("duration_min")]


def with_distance(trips: DataFrame) -> DataFrame:
    """Non-zero points only; adds ``haversine_km`` (atan2 form), ``km_at_most`` and ``duration_min``."""
    return trips.where(nonzero_points(*POINTS)).select(*_measures(haversine_km_atan2))


def longest_window(trips: DataFrame) -> DataFrame:
    order = [F.col("haversine_km").desc_nulls_last(), F.col("duration_min").desc_nulls_last()]
    return argmax_window(with_distance(trips), "VendorID", order, OUTPUT)


def longest(trips: DataFrame) -> DataFrame:
    return argmax_first(with_distance(trips), "VendorID", "haversine_km", "duration_min", "km_at_most").select(*OUTPUT)


def longest_text(lines: DataFrame, header: str | None = None, seen: Observation | None = None) -> DataFrame:
    return longest(parse_lines(strip_header(lines, header), TEXT_SPEC, seen=seen))


# The display names of the SQL form's output.  A trip below the
# least of all per-vendor maxima cannot win.
REPORT_SQL = """
WITH peak AS (
    SELECT VendorID AS vendor, MAX(haversine_km) AS km FROM {trips} WHERE VendorID IS NOT NULL GROUP BY VendorID
),
near AS (
    SELECT VendorID, haversine_km, duration_min FROM {trips}
    WHERE km_at_most >= (SELECT MIN(km) FROM peak) AND haversine_km >= (SELECT MIN(km) FROM peak)
)
SELECT /*+ MERGE(peak) */ VendorID,
       CAST(ROUND(haversine_km, 2) AS DOUBLE) AS `Max Haversine Distance (km)`,
       CAST(ROUND(duration_min, 1) AS DOUBLE) AS `Duration (min)`
FROM near JOIN peak ON VendorID = vendor AND haversine_km = km
ORDER BY VendorID, duration_min
"""


def longest_sql(spark: SparkSession, trips: DataFrame) -> DataFrame:
    forward = trips.where(nonzero_points(*POINTS) & pickup_before_dropoff("tpep_pickup_datetime", "tpep_dropoff_datetime"))
    return spark.sql(REPORT_SQL, trips=forward.select(*_measures(haversine_km_asin)))
