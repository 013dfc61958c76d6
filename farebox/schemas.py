"""Schemas of the trip and zone relations."""

from __future__ import annotations

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# The 19 columns of a coordinate trip file, in file order.  A CSV
# read with this schema binds by position, not by header name.
TRIP_COLUMNS_19 = [
    ("VendorID", IntegerType()),
    ("tpep_pickup_datetime", TimestampType()),
    ("tpep_dropoff_datetime", TimestampType()),
    ("passenger_count", IntegerType()),
    ("trip_distance", DoubleType()),
    ("pickup_longitude", DoubleType()),
    ("pickup_latitude", DoubleType()),
    ("RateCodeID", IntegerType()),
    ("store_and_fwd_flag", StringType()),
    ("dropoff_longitude", DoubleType()),
    ("dropoff_latitude", DoubleType()),
    ("payment_type", IntegerType()),
    ("fare_amount", DoubleType()),
    ("extra", DoubleType()),
    ("mta_tax", DoubleType()),
    ("tip_amount", DoubleType()),
    ("tolls_amount", DoubleType()),
    ("improvement_surcharge", DoubleType()),
    ("total_amount", DoubleType()),
]

TRIP_SCHEMA = StructType([StructField(name, dtype) for name, dtype in TRIP_COLUMNS_19])

# Positions of the fields the text parsers read (0-based, file order above).
FIELD = {name: idx for idx, (name, _) in enumerate(TRIP_COLUMNS_19)}

# The eight money columns summed per borough, with their output names.
MONEY_TOTALS = [
    ("fare_amount", "Total_Fare"),
    ("tip_amount", "Total_Tips"),
    ("tolls_amount", "Total_Tolls"),
    ("extra", "Total_Extras"),
    ("mta_tax", "Total_MTA_Tax"),
    ("congestion_surcharge", "Total_Congestion"),
    ("airport_fee", "Total_Airport_Fee"),
    ("total_amount", "Total_Revenue"),
]
