"""Q3, Q5, Q6 (trip aggregates by zone attributes) and Q4 (night trips).

Trips are aggregated by their zone ids first (partial aggregate per task,
shuffle of partials only), and the zone lookup joins those few rows: their
number is bounded by the zone ids, not by the trips.  The lookup is broadcast
behind its size check, else the join is a sort-merge join of two small
relations; the plan is the same either way.  The trips are never shuffled
whole and a hot zone costs one partial row per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farebox.functions.temporal import in_wrapped_range, stored_hour
from farebox.operators.aggregates import count_by, exact_parts, exact_total, merged_parts, sum_by
from farebox.operators.joins import fits_broadcast, lookup_join, role_playing_join
from farebox.operators.ordering import top_k
from farebox.schemas import MONEY_TOTALS

ROLES = [("PULocationID", "pu"), ("DOLocationID", "dz")]


def pair_counts(trips: DataFrame) -> DataFrame:
    """Trips per (PULocationID, DOLocationID); null ids kept as their own pairs."""
    return count_by(trips, ["PULocationID", "DOLocationID"], "n")


def _pairs_with_roles(trips: DataFrame, zones: DataFrame, columns: list[str], extra=None) -> DataFrame:
    """Counted id pairs joined to the zone lookup as pickup ``pu`` and drop-off ``dz``."""
    return role_playing_join(pair_counts(trips), zones.select("LocationID", *columns), "LocationID", ROLES, extra=extra)


def same_borough(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Q3: trips that start and end in the same borough, per borough, most first."""
    pairs = _pairs_with_roles(trips, zones, ["Borough"], extra=F.col("pu.Borough") == F.col("dz.Borough"))
    named = pairs.select(F.col("pu.Borough").alias("Borough"), "n")
    return sum_by(named, "Borough", [("n", "TotalTrips")]).orderBy(F.col("TotalTrips").desc())


def top_zone_pairs(trips: DataFrame, zones: DataFrame, k: int = 10) -> DataFrame:
    """Q5: the ``k`` most frequent ordered pairs of different zones.

    Ties on the count are broken by (Pickup_Zone, Dropoff_Zone) so row k is
    stable.  ``orderBy + limit`` runs as a per-task top-k plus a k-row merge.
    """
    pairs = _pairs_with_roles(trips, zones, ["Zone"], extra=F.col("pu.Zone") != F.col("dz.Zone"))
    named = pairs.select(F.col("pu.Zone").alias("Pickup_Zone"), F.col("dz.Zone").alias("Dropoff_Zone"), "n")
    counted = sum_by(named, ["Pickup_Zone", "Dropoff_Zone"], [("n", "Total_Trips")])
    return top_k(counted, k, [F.col("Total_Trips").desc(), F.col("Pickup_Zone").asc(), F.col("Dropoff_Zone").asc()])


def revenue_by_borough(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Q6: eight money totals per pickup borough, largest revenue first; exact, so equal under every partitioning."""
    names = [alias for _, alias in MONEY_TOTALS]
    per_zone = trips.groupBy("PULocationID").agg(*exact_parts(MONEY_TOTALS))
    joined = lookup_join(per_zone, zones.select("LocationID", "Borough"), F.col("PULocationID") == F.col("LocationID"))
    totals = joined.groupBy("Borough").agg(*merged_parts(names)).select("Borough", *map(exact_total, names))
    return totals.orderBy(F.col("Total_Revenue").desc())


# Trips counted by their pair of zone ids, then named twice; {{hint}} is the
# join strategy that the measured size of the zones allows.
SAME_BOROUGH_SQL = """
WITH moves AS (
    SELECT PULocationID AS origin_id, DOLocationID AS target_id, COUNT(*) AS n
    FROM {trips} GROUP BY PULocationID, DOLocationID
)
SELECT /*+ {{hint}}(origin, target) */ origin.Borough AS Borough, SUM(moves.n) AS TotalTrips
FROM moves
JOIN {zones} AS origin ON moves.origin_id = origin.LocationID
JOIN {zones} AS target ON moves.target_id = target.LocationID AND origin.Borough = target.Borough
GROUP BY origin.Borough
ORDER BY TotalTrips DESC
"""


def same_borough_sql(spark: SparkSession, trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Q3 as one SQL text: count, two named joins, final sum."""
    lookup = zones.select("LocationID", "Borough")
    hint = "BROADCAST" if fits_broadcast(lookup) else "MERGE"
    return spark.sql(SAME_BOROUGH_SQL.replace("{{hint}}", hint), trips=trips, zones=lookup)


def _at_night(trips: DataFrame, start_hour: int, end_hour: int) -> DataFrame:
    return trips.where(in_wrapped_range(stored_hour(trips, "tpep_pickup_datetime"), start_hour, end_hour))


def night_trips_sql(spark: SparkSession, trips: DataFrame, start_hour: int = 23, end_hour: int = 7) -> DataFrame:
    """Q4: trips picked up 23:00-06:59 per vendor, most first (null vendor kept), counted in SQL.

    On converted files the test is on the stored hour and reaches the scan."""
    return spark.sql("SELECT VendorID, COUNT(*) AS NightTrips FROM {night} GROUP BY VendorID ORDER BY NightTrips DESC",
                     night=_at_night(trips, start_hour, end_hour).select("VendorID"))


def night_trips(trips: DataFrame) -> DataFrame:
    """Q4 in the DataFrame API."""
    return count_by(_at_night(trips, 23, 7), "VendorID", "NightTrips").orderBy(F.col("NightTrips").desc())
