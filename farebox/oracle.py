"""Independent SQL (DuckDB dialect) for every registered query.

The views of ``farebox.sources.tables`` are restated as CTEs over the raw
driver tables, and each query is written the plain way (row-level joins,
joins back to per-key maxima), so the oracle does not share the plan shapes
that the Spark side uses.
"""

from __future__ import annotations

GEO = """geo AS (
    SELECT event_id,
           CASE WHEN event_id % 97 = 0 THEN NULL ELSE CAST(1 + event_id % 2 AS INTEGER) END AS VendorID,
           ts AS tpep_pickup_datetime,
           ts + to_seconds((event_id * 37) % 5400 - 300) AS tpep_dropoff_datetime,
           CAST(1 + event_id % 4 AS INTEGER) AS passenger_count,
           value AS trip_distance,
           CASE WHEN event_id % 50 = 0 THEN CAST(0 AS DOUBLE)
                ELSE CAST(-74.1 AS DOUBLE) + CAST((event_id * 7919) % 10007 AS DOUBLE) / CAST(25000 AS DOUBLE) END
               AS pickup_longitude,
           CASE WHEN event_id % 51 = 0 THEN CAST(0 AS DOUBLE)
                ELSE CAST(40.5 AS DOUBLE) + CAST((event_id * 6101) % 10009 AS DOUBLE) / CAST(25000 AS DOUBLE) END
               AS pickup_latitude,
           CASE WHEN event_id % 52 = 0 THEN CAST(0 AS DOUBLE)
                ELSE CAST(-74.1 AS DOUBLE) + CAST((event_id * 4801) % 10037 AS DOUBLE) / CAST(25000 AS DOUBLE) END
               AS dropoff_longitude,
           CASE WHEN event_id % 53 = 0 THEN CAST(0 AS DOUBLE)
                ELSE CAST(40.5 AS DOUBLE) + CAST((event_id * 3571) % 10039 AS DOUBLE) / CAST(25000 AS DOUBLE) END
               AS dropoff_latitude,
           CAST(1 AS INTEGER) AS RateCodeID,
           'N' AS store_and_fwd_flag,
           CAST(1 + event_id % 2 AS INTEGER) AS payment_type,
           value AS fare_amount,
           CAST(0.5 AS DOUBLE) AS extra,
           CAST(0.5 AS DOUBLE) AS mta_tax,
           CAST(0 AS DOUBLE) AS tip_amount,
           CAST(0 AS DOUBLE) AS tolls_amount,
           CAST(0.3 AS DOUBLE) AS improvement_surcharge,
           value + CAST(1.3 AS DOUBLE) AS total_amount
    FROM events
)"""

ZONES = """zones AS (
    SELECT n_nationkey AS LocationID,
           CASE WHEN n_nationkey = 24 THEN NULL ELSE r_name END AS Borough,
           CASE WHEN n_nationkey = 23 THEN NULL ELSE n_name END AS Zone
    FROM nation JOIN region ON n_regionkey = r_regionkey
)"""

LOC = """loc AS (
    SELECT CASE WHEN l_linenumber = 7 THEN 99 ELSE s_nationkey END AS PULocationID,
           CASE WHEN l_quantity = 50 THEN NULL ELSE c_nationkey END AS DOLocationID,
           l_extendedprice AS fare_amount,
           l_discount AS tip_amount,
           l_tax AS tolls_amount,
           l_quantity AS extra,
           CAST(l_linenumber AS DOUBLE) / 2 AS mta_tax,
           CASE WHEN l_returnflag = 'R' THEN NULL ELSE CAST(2.5 AS DOUBLE) END AS congestion_surcharge,
           CASE WHEN l_linestatus = 'O' THEN CAST(1.75 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS airport_fee,
           l_extendedprice + l_discount + l_tax + l_quantity AS total_amount
    FROM lineitem
    JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey
    JOIN supplier ON l_suppkey = s_suppkey
)"""

FIXTURES = {"geo": GEO, "zones": ZONES, "loc": LOC}

# Reusable expressions over ``geo``.
TS_SEC = "'%Y-%m-%d %H:%M:%S'"
HOUR = "CAST(hour(tpep_pickup_datetime) AS INTEGER)"
MINUTES = "(floor(epoch(tpep_dropoff_datetime)) - floor(epoch(tpep_pickup_datetime))) / 60"
NONZERO_PICKUP = "pickup_latitude != 0 AND pickup_longitude != 0"
NONZERO_ALL = NONZERO_PICKUP + " AND dropoff_latitude != 0 AND dropoff_longitude != 0"
A_TERM = ("least(CAST(1 AS DOUBLE), greatest(CAST(0 AS DOUBLE), "
          "pow(sin(radians(dropoff_latitude - pickup_latitude) / 2), 2) "
          "+ cos(radians(pickup_latitude)) * cos(radians(dropoff_latitude)) "
          "* pow(sin(radians(dropoff_longitude - pickup_longitude) / 2), 2)))")
KM_ATAN2 = f"CAST(6371.0 AS DOUBLE) * (2 * atan2(sqrt({A_TERM}), sqrt(1 - {A_TERM})))"
KM_ASIN = f"CAST(12742.0 AS DOUBLE) * asin(sqrt({A_TERM}))"


def with_fixtures(body: str, *names: str, ctes: str = "") -> str:
    """``WITH <fixture views>[, <ctes>] <body>``."""
    parts = [FIXTURES[n] for n in names] + ([ctes.strip()] if ctes else [])
    return "WITH " + ",\n".join(parts) + "\n" + body


def round6(expr: str, name: str) -> str:
    return f"round({expr}, 6) AS {name}"


Q1 = with_fixtures(f"""
SELECT {HOUR} AS hour,
       round(avg(pickup_latitude), 6) AS avg_latitude,
       round(avg(pickup_longitude), 6) AS avg_longitude
FROM geo WHERE {NONZERO_PICKUP}
GROUP BY 1 ORDER BY 1""", "geo")

Q2_WINDOW = with_fixtures(f"""
SELECT VendorID, round(km, 6) AS haversine_km, round(duration_min, 4) AS duration_min
FROM (
    SELECT VendorID, km, duration_min,
           row_number() OVER (PARTITION BY VendorID ORDER BY km DESC, duration_min DESC NULLS LAST) AS rn
    FROM (SELECT VendorID, {KM_ATAN2} AS km, {MINUTES} AS duration_min FROM geo WHERE {NONZERO_ALL})
) WHERE rn = 1""", "geo")

# Literal join back to the per-vendor maximum (ties kept, null vendor lost).
Q2_SQL = with_fixtures(f"""
SELECT d.VendorID,
       CAST(round(d.max_km, 2) AS DOUBLE) AS "Max Haversine Distance (km)",
       CAST(round(t.duration_minutes, 1) AS DOUBLE) AS "Duration (min)"
FROM mx d JOIN valid t ON d.VendorID = t.VendorID AND d.max_km = t.km
ORDER BY d.VendorID""", "geo", ctes=f"""
valid AS (
    SELECT VendorID, {MINUTES} AS duration_minutes, {KM_ASIN} AS km
    FROM geo WHERE {NONZERO_ALL} AND tpep_pickup_datetime < tpep_dropoff_datetime
),
mx AS (SELECT VendorID, max(km) AS max_km FROM valid GROUP BY VendorID)""")

Q2_TEXT = with_fixtures(f"""
SELECT CAST(VendorID AS BIGINT) AS VendorID, round(max(km), 6) AS haversine_km, round(arg_max(duration_min, km), 4) AS duration_min
FROM (SELECT VendorID, {KM_ATAN2} AS km, {MINUTES} AS duration_min FROM geo
      WHERE VendorID IS NOT NULL AND {NONZERO_ALL})
GROUP BY VendorID""", "geo")

# Trips with odd fixes; the oracle turns every non-finite coordinate into NULL
# before any arithmetic.
ODD_FIXES = {
    "pickup_latitude": ("event_id % 11 = 3", "'NaN'", "40.0"), "pickup_longitude": ("false", "'NaN'", "-74.5"),
    "dropoff_latitude": ("event_id % 17 = 5", "'-Infinity'", "41.5"),
    "dropoff_longitude": ("event_id % 13 = 4", "'Infinity'", "-73.0"),
}
EDGE_COORDS = ",\n           ".join(
    f"CASE WHEN {when} THEN CAST({odd} AS DOUBLE) WHEN event_id % 19 = 6 THEN CAST({tied} AS DOUBLE) ELSE {c} END AS {c}"
    for c, (when, odd, tied) in ODD_FIXES.items())
FINITE_COORDS = ",\n           ".join(f"CASE WHEN isfinite({c}) THEN {c} END AS {c}" for c in ODD_FIXES)
EDGE_REST = "event_id, VendorID, tpep_pickup_datetime, tpep_dropoff_datetime"
EDGE = f"""odd AS (SELECT {EDGE_REST}, {EDGE_COORDS} FROM geo),
edge AS (
    SELECT {EDGE_REST}, {FINITE_COORDS},
           NOT ({NONZERO_ALL}) AS has_zero
    FROM odd
)"""
# least() and greatest() pass over NULLs in DuckDB, so the distance asks for all four.
ALL_FINITE = " AND ".join(f"{c} IS NOT NULL" for c in ODD_FIXES)
KM_ATAN2_IF_FINITE = f"CASE WHEN {ALL_FINITE} THEN {KM_ATAN2} END"
KM_ASIN_IF_FINITE = f"CASE WHEN {ALL_FINITE} THEN {KM_ASIN} END"
EDGE_KM = f"""edge_km AS (
    SELECT event_id, VendorID, {MINUTES} AS duration_min, {KM_ATAN2_IF_FINITE} AS km, {KM_ASIN_IF_FINITE} AS km_asin,
           tpep_pickup_datetime < tpep_dropoff_datetime AS forward
    FROM edge WHERE NOT has_zero
)"""
Q2_EDGE = with_fixtures("""
SELECT VendorID, round(km, 6) AS haversine_km, round(max(duration_min), 4) AS duration_min
FROM edge_km JOIN (SELECT VendorID AS v, max(km) AS m FROM edge_km GROUP BY VendorID)
     ON VendorID IS NOT DISTINCT FROM v AND km = m
GROUP BY VendorID, km""", "geo", ctes=EDGE + ",\n" + EDGE_KM)
Q2_EDGE_TEXT = with_fixtures("""
SELECT CAST(VendorID AS BIGINT) AS VendorID, round(km, 6) AS haversine_km, round(max(duration_min), 4) AS duration_min
FROM edge_km JOIN (SELECT VendorID AS v, max(km) AS m FROM edge_km GROUP BY VendorID) ON VendorID = v AND km = m
GROUP BY VendorID, km""", "geo", ctes=EDGE + ",\n" + EDGE_KM)
Q2_EDGE_SQL = with_fixtures("""
SELECT VendorID, CAST(round(km_asin, 2) AS DOUBLE) AS "Max Haversine Distance (km)",
       CAST(round(duration_min, 1) AS DOUBLE) AS "Duration (min)"
FROM edge_km JOIN (SELECT VendorID AS v, max(km_asin) AS m FROM edge_km WHERE forward GROUP BY VendorID)
     ON VendorID = v AND km_asin = m
WHERE forward""", "geo", ctes=EDGE + ",\n" + EDGE_KM)
HAVERSINE_EDGE = with_fixtures(f"""
SELECT event_id, round({KM_ATAN2_IF_FINITE}, 6) AS km_atan2, round({KM_ASIN_IF_FINITE}, 6) AS km_asin FROM edge""", "geo", ctes=EDGE)

Q3 = with_fixtures("""
SELECT pu.Borough AS Borough, CAST(count(*) AS BIGINT) AS TotalTrips
FROM loc t
JOIN zones pu ON t.PULocationID = pu.LocationID
JOIN zones dz ON t.DOLocationID = dz.LocationID
WHERE pu.Borough = dz.Borough
GROUP BY pu.Borough ORDER BY TotalTrips DESC""", "loc", "zones")

Q4 = with_fixtures(f"""
SELECT VendorID, CAST(count(*) AS BIGINT) AS NightTrips
FROM geo WHERE {HOUR} >= 23 OR {HOUR} < 7
GROUP BY VendorID ORDER BY NightTrips DESC""", "geo")

Q5 = with_fixtures("""
SELECT pu.Zone AS Pickup_Zone, dz.Zone AS Dropoff_Zone, CAST(count(*) AS BIGINT) AS Total_Trips
FROM loc t
JOIN zones pu ON t.PULocationID = pu.LocationID
JOIN zones dz ON t.DOLocationID = dz.LocationID
WHERE pu.Zone != dz.Zone
GROUP BY 1, 2
ORDER BY Total_Trips DESC NULLS LAST, Pickup_Zone ASC NULLS FIRST, Dropoff_Zone ASC NULLS FIRST LIMIT 10""", "loc", "zones")

MONEY = [("fare_amount", "Total_Fare"), ("tip_amount", "Total_Tips"), ("tolls_amount", "Total_Tolls"),
         ("extra", "Total_Extras"), ("mta_tax", "Total_MTA_Tax"), ("congestion_surcharge", "Total_Congestion"),
         ("airport_fee", "Total_Airport_Fee"), ("total_amount", "Total_Revenue")]
MONEY_SUMS = ",\n       ".join(f"round(sum({c}), 2) AS {a}" for c, a in MONEY)

Q6_BODY = f"""
SELECT z.Borough AS Borough,
       {MONEY_SUMS}
FROM loc t JOIN zones z ON t.PULocationID = z.LocationID
GROUP BY z.Borough"""
Q6 = with_fixtures(Q6_BODY + " ORDER BY Total_Revenue DESC", "loc", "zones")

Q6_INVARIANT = with_fixtures("""
SELECT v.shuffle_partitions, q6.* FROM q6
CROSS JOIN (VALUES (8), (32), (64), (128)) AS v(shuffle_partitions)""", "loc", "zones", ctes=f"q6 AS ({Q6_BODY})")

GEO_TEXT_ROW = f"""CAST(VendorID AS BIGINT) AS VendorID,
       strftime(tpep_pickup_datetime, {TS_SEC}) AS pickup,
       strftime(tpep_dropoff_datetime, {TS_SEC}) AS dropoff,
       pickup_longitude, pickup_latitude, dropoff_longitude, dropoff_latitude"""

ROLE_JOIN = """FROM loc t
JOIN zones pu ON t.PULocationID = pu.LocationID
JOIN zones dz ON t.DOLocationID = dz.LocationID"""

ORACLE: dict[str, str] = {
    "q2_edge": Q2_EDGE,
    "q2_edge_window": Q2_EDGE,
    "q2_edge_sql": Q2_EDGE_SQL,
    "q2_edge_text": Q2_EDGE_TEXT,
    "proj_haversine_edge": HAVERSINE_EDGE,
    # sources
    "src_csv_schema": with_fixtures(f"""
SELECT VendorID, strftime(tpep_pickup_datetime, {TS_SEC}) AS pickup,
       strftime(tpep_dropoff_datetime, {TS_SEC}) AS dropoff, passenger_count, trip_distance,
       pickup_longitude, pickup_latitude, dropoff_longitude, dropoff_latitude, total_amount
FROM geo""", "geo"),
    "src_csv_infer": with_fixtures("SELECT * FROM loc", "loc"),
    "src_parquet": with_fixtures(f"""
SELECT event_id, VendorID, strftime(tpep_pickup_datetime, '%Y-%m-%d %H:%M:%S.%f') AS pickup,
       trip_distance, pickup_latitude, pickup_longitude
FROM geo""", "geo"),
    "src_text_lenient": with_fixtures(f"SELECT {GEO_TEXT_ROW} FROM geo WHERE VendorID IS NOT NULL", "geo"),
    "src_text_strip_header": with_fixtures(f"""
SELECT VendorID, strftime(tpep_pickup_datetime, {TS_SEC}) AS tpep_pickup_datetime,
       strftime(tpep_dropoff_datetime, {TS_SEC}) AS tpep_dropoff_datetime, passenger_count, trip_distance,
       pickup_longitude, pickup_latitude, RateCodeID, store_and_fwd_flag, dropoff_longitude, dropoff_latitude,
       payment_type, fare_amount, extra, mta_tax, tip_amount, tolls_amount, improvement_surcharge, total_amount
FROM geo""", "geo"),
    "view_sql": with_fixtures(f"SELECT VendorID, {HOUR} AS pickup_hour, {MINUTES} AS duration_min FROM geo", "geo"),
    # sinks
    "sink_csv_single": Q1,
    "sink_csv_overwrite": Q3,
    "sink_parquet": with_fixtures("SELECT * FROM loc", "loc"),
    "sink_text": Q1.replace(f"{HOUR} AS hour", "CAST(hour(tpep_pickup_datetime) AS BIGINT) AS hour"),
    "sink_text_fixed": with_fixtures(f"""
SELECT CAST(VendorID AS BIGINT) AS VendorID, round(max(km), 3) AS haversine_km, round(arg_max(duration_min, km), 1) AS duration_min
FROM (SELECT VendorID, {KM_ATAN2} AS km, {MINUTES} AS duration_min FROM geo
      WHERE VendorID IS NOT NULL AND {NONZERO_ALL})
GROUP BY VendorID""", "geo"),
    "fn_format_vendor": with_fixtures(f"""
SELECT CAST(VendorID AS BIGINT) AS VendorID, printf('VendorID: %d | Distance: %.2f km | Duration: %.2f min', VendorID, max(km),
                        arg_max(duration_min, km)) AS line
FROM (SELECT VendorID, {KM_ATAN2} AS km, {MINUTES} AS duration_min FROM geo
      WHERE VendorID IS NOT NULL AND {NONZERO_ALL})
GROUP BY VendorID""", "geo"),
    "etl_csv_to_parquet": with_fixtures("""
SELECT 'geo_trips' AS name, count(*) AS rows, CAST(NULL AS VARCHAR) AS error FROM geo
UNION ALL SELECT 'loc_trips', count(*), NULL FROM loc
UNION ALL SELECT 'zones', count(*), NULL FROM zones""", "geo", "loc", "zones"),
    "preview_take": with_fixtures(f"""
SELECT {GEO_TEXT_ROW} FROM geo WHERE VendorID IS NOT NULL
ORDER BY pickup NULLS FIRST, dropoff NULLS FIRST, VendorID NULLS FIRST, pickup_longitude NULLS FIRST,
         pickup_latitude NULLS FIRST, dropoff_longitude NULLS FIRST, dropoff_latitude NULLS FIRST
LIMIT 5""", "geo"),
    # projections and expressions
    "proj_hour": with_fixtures(f"SELECT VendorID, {HOUR} AS hour FROM geo", "geo"),
    "proj_duration_min": with_fixtures(f"SELECT VendorID, {MINUTES} AS duration_min FROM geo", "geo"),
    "proj_haversine_atan2": with_fixtures(f"SELECT VendorID, {round6(KM_ATAN2, 'haversine_km')} FROM geo", "geo"),
    "proj_haversine_asin": with_fixtures(f"SELECT VendorID, {round6(KM_ASIN, 'haversine_km')} FROM geo", "geo"),
    "proj_rounded_alias": with_fixtures(f"""
SELECT VendorID, round({KM_ASIN}, 2) AS "Haversine Distance (km)", round({MINUTES}, 1) AS "Duration (min)"
FROM geo""", "geo"),
    "fn_parse": with_fixtures(f"""
SELECT CAST(VendorID AS BIGINT) AS VendorID, strftime(tpep_pickup_datetime, {TS_SEC}) AS pickup, pickup_latitude, pickup_longitude
FROM geo""", "geo"),
    "fn_format": with_fixtures(f"""
SELECT {HOUR} AS hour,
       printf('Hour: %02d | Avg Latitude: %.6f | Avg Longitude: %.6f',
              {HOUR}, avg(pickup_latitude), avg(pickup_longitude)) AS line
FROM geo WHERE {NONZERO_PICKUP} GROUP BY 1""", "geo"),
    "udf_hour": with_fixtures(f"SELECT VendorID, {HOUR} AS hour FROM geo", "geo"),
    # filters
    "filter_nonzero_pickup": with_fixtures(
        f"SELECT VendorID, pickup_latitude, pickup_longitude FROM geo WHERE {NONZERO_PICKUP}", "geo"),
    "filter_nonzero_all": with_fixtures(f"""
SELECT VendorID, pickup_latitude, pickup_longitude, dropoff_latitude, dropoff_longitude
FROM geo WHERE {NONZERO_ALL}""", "geo"),
    "filter_forward_time": with_fixtures(f"""
SELECT VendorID, {MINUTES} AS duration_min FROM geo
WHERE tpep_pickup_datetime < tpep_dropoff_datetime""", "geo"),
    "filter_night_wrap": with_fixtures(f"SELECT VendorID, {HOUR} AS hour FROM geo WHERE {HOUR} >= 23 OR {HOUR} < 7",
                                       "geo"),
    "filter_same_attr": with_fixtures(f"""
SELECT t.PULocationID, t.DOLocationID, pu.Borough AS Borough, t.fare_amount
{ROLE_JOIN} WHERE pu.Borough = dz.Borough""", "loc", "zones"),
    "filter_diff_attr": with_fixtures(f"""
SELECT t.PULocationID, t.DOLocationID, pu.Zone AS Pickup_Zone, dz.Zone AS Dropoff_Zone
{ROLE_JOIN} WHERE pu.Zone != dz.Zone""", "loc", "zones"),
    # joins
    "join_lookup": with_fixtures("""
SELECT t.PULocationID, z.Borough, t.fare_amount, t.total_amount
FROM loc t JOIN zones z ON t.PULocationID = z.LocationID""", "loc", "zones"),
    "join_role_playing": with_fixtures(f"""
SELECT t.PULocationID, t.DOLocationID, pu.Borough AS pickup_borough, dz.Borough AS dropoff_borough,
       pu.Zone AS pickup_zone, dz.Zone AS dropoff_zone
{ROLE_JOIN}""", "loc", "zones"),
    "join_cross_dim_equi": with_fixtures(f"""
SELECT t.PULocationID, t.DOLocationID, pu.Borough AS Borough, t.total_amount
{ROLE_JOIN} AND pu.Borough = dz.Borough""", "loc", "zones"),
    "join_theta_residual": with_fixtures(f"""
SELECT t.PULocationID, t.DOLocationID, pu.Zone AS Pickup_Zone, dz.Zone AS Dropoff_Zone, t.total_amount
{ROLE_JOIN} AND pu.Zone != dz.Zone""", "loc", "zones"),
    "join_argmax_back": with_fixtures("""
SELECT d.VendorID, round(d.km, 6) AS haversine_km, round(d.duration_min, 4) AS duration_min
FROM d JOIN m ON d.VendorID = m.VendorID AND d.km = m.max_km""", "geo", ctes=f"""
d AS (SELECT VendorID, {KM_ATAN2} AS km, {MINUTES} AS duration_min FROM geo WHERE {NONZERO_ALL}),
m AS (SELECT VendorID, max(km) AS max_km FROM d GROUP BY VendorID)"""),
    # aggregates
    "agg_avg_by_hour": with_fixtures(f"""
SELECT {HOUR} AS hour, round(avg(pickup_latitude), 6) AS avg_latitude,
       round(avg(pickup_longitude), 6) AS avg_longitude
FROM geo GROUP BY 1""", "geo"),
    "agg_count_by_key": with_fixtures("SELECT VendorID, count(*) AS trips FROM geo GROUP BY VendorID", "geo"),
    "agg_count_by_pair": with_fixtures(
        "SELECT PULocationID, DOLocationID, count(*) AS n FROM loc GROUP BY PULocationID, DOLocationID", "loc"),
    "agg_sum_multi": with_fixtures(
        "SELECT PULocationID, " + ", ".join(f"round(sum({c}), 2) AS {a}" for c, a in MONEY)
        + " FROM loc GROUP BY PULocationID", "loc"),
    "agg_max_by_key": with_fixtures(f"""
SELECT VendorID, round(max({KM_ATAN2}), 6) AS max_km FROM geo WHERE {NONZERO_ALL} GROUP BY VendorID""", "geo"),
    "agg_mean_from_sums": Q1,
    "argmax_window": Q2_WINDOW,
    "argmax_max_by": Q2_WINDOW,
    # ordering
    "sort_key_asc": with_fixtures(f"""
SELECT strftime(tpep_pickup_datetime, '%Y-%m-%d %H:%M:%S.%f') AS pickup, VendorID, trip_distance
FROM geo ORDER BY tpep_pickup_datetime""", "geo"),
    "sort_measure_desc": with_fixtures(
        "SELECT PULocationID, DOLocationID, total_amount FROM loc ORDER BY total_amount DESC", "loc"),
    "topk_pairs": Q5,
    "topk_display": with_fixtures("""
SELECT z.Borough AS Borough, round(sum(total_amount), 2) AS Total_Revenue
FROM loc t JOIN zones z ON t.PULocationID = z.LocationID
GROUP BY z.Borough ORDER BY Total_Revenue DESC NULLS LAST, Borough ASC NULLS FIRST LIMIT 5""", "loc", "zones"),
    # whole queries
    "q1_hourly_avg": Q1,
    "q1_udf": Q1,
    "q1_text": Q1,
    "q1_hourly_avg_csv": Q1,
    "q1_udf_csv": Q1,
    "q2_window_csv": Q2_WINDOW,
    "q2_sql_csv": Q2_SQL,
    "q6_revenue_csv": Q6,
    "q2_window": Q2_WINDOW,
    "q2_sql": Q2_SQL,
    "q2_text": Q2_TEXT,
    "q3_df": Q3,
    "q3_df_csv": Q3,
    "q3_sql": Q3,
    "q3_sql_csv": Q3,
    "q4_night": Q4,
    "q4_night_csv": Q4,
    "q5_top_pairs": Q5,
    "q5_top_pairs_csv": Q5,
    "q6_revenue": Q6,
    "q6_partitions_invariant": Q6_INVARIANT,
}

ORACLE["join_argmax_back_rank"] = ORACLE["join_argmax_back"]

LOC_ALL = with_fixtures("SELECT * FROM loc", "loc")
ORACLE |= {
    "src_csv_remembered": LOC_ALL,
    "sink_parquet_balanced": LOC_ALL,
    "src_merged_schemas": with_fixtures("""
SELECT CAST(PULocationID AS BIGINT) AS PULocationID, CAST(DOLocationID AS DOUBLE) AS DOLocationID, fare_amount, tip_amount,
       tolls_amount, extra, mta_tax, congestion_surcharge, airport_fee, total_amount,
       CASE WHEN coalesce(PULocationID, 0) % 3 = 2 THEN 'x' END AS note
FROM loc""", "loc"),
    "src_text_drops": """
SELECT CASE WHEN event_id % 7 = 0 THEN 'VendorID: no int' WHEN event_id % 11 = 0 THEN 'pickup: no timestamp'
            WHEN event_id % 13 = 0 THEN 'latitude: missing' ELSE 'kept' END AS reason, count(*) AS lines
FROM events GROUP BY 1""",
    "agg_sum_exact": with_fixtures(
        "SELECT PULocationID, " + ", ".join(f"CAST(sum(CAST({c} AS DECIMAL(18, 4))) AS DOUBLE) AS {a}" for c, a in MONEY)
        + " FROM loc GROUP BY PULocationID", "loc"),
    "q4_night_converted": Q4,
    "q6_merged_months": Q6,
}

JOB_RESULTS = {"q1": Q1, "q1-udf": Q1, "q1-text": Q1, "q2": Q2_WINDOW, "q2-sql": Q2_SQL, "q2-text": Q2_TEXT, "q3": Q3, "q3-sql": Q3,
               "q4": Q4, "q5": Q5, "q6": Q6}
ORACLE["jobs_all_udf"] = "\nUNION ALL ".join(
    f"SELECT '{job}' AS job, count(*) AS rows FROM ({sql}) AS r" for job, sql in JOB_RESULTS.items())
