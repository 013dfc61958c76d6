"""Trip and zone relations derived from the driver's TPC-H-style tables.

The reference reads taxi files that are not part of the test data, so the
same schemas are rebuilt as Spark views over ``events`` (coordinate trips)
and ``lineitem/orders/customer/supplier`` + ``nation/region`` (location-id
trips and the zone lookup).  Everything stays lazy; Catalyst prunes the
derived columns a query does not use.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farebox.functions.temporal import add_seconds
from farebox.operators.joins import lookup_join

# Session setting: partitions of the one large shuffle (line items by order key).
PARTITIONS_CONF = "farebox.lineItemPartitions"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _coord(eid, base: float, mult: int, mod: int, zero_every: int):
    """A coordinate that is exactly 0 on every ``zero_every``-th event (an invalid fix)."""
    value = F.lit(base) + ((eid * mult) % mod).cast("double") / F.lit(25000.0)
    return F.when(eid % zero_every == 0, F.lit(0.0)).otherwise(value)


def geo_trips_from_events(events: DataFrame) -> DataFrame:
    """Coordinate trips, all 19 columns in file order, plus ``event_id``."""
    eid = F.col("event_id")
    return events.select(
        eid.alias("event_id"),
        F.when(eid % 97 == 0, F.lit(None).cast("int")).otherwise((F.lit(1) + eid % 2).cast("int")).alias("VendorID"),
        F.col("ts").alias("tpep_pickup_datetime"),
        add_seconds(F.col("ts"), (eid * 37) % 5400 - 300).alias("tpep_dropoff_datetime"),
        (F.lit(1) + eid % 4).cast("int").alias("passenger_count"),
        F.col("value").alias("trip_distance"),
        _coord(eid, -74.1, 7919, 10007, 50).alias("pickup_longitude"),
        _coord(eid, 40.5, 6101, 10009, 51).alias("pickup_latitude"),
        F.lit(1).alias("RateCodeID"),
        F.lit("N").alias("store_and_fwd_flag"),
        _coord(eid, -74.1, 4801, 10037, 52).alias("dropoff_longitude"),
        _coord(eid, 40.5, 3571, 10039, 53).alias("dropoff_latitude"),
        (F.lit(1) + eid % 2).cast("int").alias("payment_type"),
        F.col("value").alias("fare_amount"),
        F.lit(0.5).alias("extra"),
        F.lit(0.5).alias("mta_tax"),
        F.lit(0.0).alias("tip_amount"),
        F.lit(0.0).alias("tolls_amount"),
        F.lit(0.3).alias("improvement_surcharge"),
        (F.col("value") + F.lit(1.3)).alias("total_amount"),
    )


def geo_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return geo_trips_from_events(table(spark, sf_dir, "events"))


def geo_edge_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The coordinate trips with fixes that are no numbers or infinite, and
    with many trips of one and the same longest distance."""
    geo = geo_trips(spark, sf_dir)
    eid = F.col("event_id")
    odd = {"pickup_latitude": (eid % 11 == 3, "NaN"), "dropoff_longitude": (eid % 13 == 4, "Infinity"),
           "dropoff_latitude": (eid % 17 == 5, "-Infinity")}
    tied = {"pickup_latitude": 40.0, "pickup_longitude": -74.5, "dropoff_latitude": 41.5, "dropoff_longitude": -73.0}
    return geo.withColumns({
        c: F.when(odd[c][0] if c in odd else F.lit(False), F.lit(float(odd[c][1] if c in odd else 0)))
        .when(eid % 19 == 6, F.lit(v)).otherwise(F.col(c)) for c, v in tied.items()})


def zones_from(nation: DataFrame, region: DataFrame) -> DataFrame:
    """Zone lookup: LocationID, Borough (null for key 24), Zone (null for key 23)."""
    joined = lookup_join(nation.select("n_nationkey", "n_name", "n_regionkey"),
                         region.select("r_regionkey", "r_name"),
                         F.col("n_regionkey") == F.col("r_regionkey"))
    return joined.select(
        F.col("n_nationkey").alias("LocationID"),
        F.when(F.col("n_nationkey") == 24, F.lit(None).cast("string")).otherwise(F.col("r_name")).alias("Borough"),
        F.when(F.col("n_nationkey") == 23, F.lit(None).cast("string")).otherwise(F.col("n_name")).alias("Zone"),
    )


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zones_from(table(spark, sf_dir, "nation"), table(spark, sf_dir, "region"))


def loc_trips_from(lineitem: DataFrame, orders: DataFrame, customer: DataFrame, supplier: DataFrame) -> DataFrame:
    """Location-id trips: one per line item; pickup zone from the supplier's
    nation, drop-off zone from the customer's nation.

    ``orders`` is first narrowed to (order key, customer nation) so the one
    big shuffle join (line items by order key) moves two columns per order,
    and each line item enters that shuffle with its supplier's nation and
    flag-derived columns already computed.  Customer and supplier are
    broadcast only when the size check proves them small; at large scale
    they fall back to sort-merge joins.
    """
    order_nation = lookup_join(
        orders.select("o_orderkey", "o_custkey"),
        customer.select("c_custkey", "c_nationkey"),
        F.col("o_custkey") == F.col("c_custkey"),
    ).select("o_orderkey", "c_nationkey")
    items = lineitem.select("l_orderkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                            "l_discount", "l_tax", "l_returnflag", "l_linestatus")
    # Everything a line item decides on its own is derived before the big
    # shuffle: the supplier's nation (25 values, compresses well) replaces the
    # supplier key, and the two one-letter flags become the bits of one number
    # (a fixed 8-byte slot instead of variable-length strings), from which the
    # money columns that they set are made after the join.
    lines = lookup_join(items, supplier.select("s_suppkey", "s_nationkey"),
                        F.col("l_suppkey") == F.col("s_suppkey")).select(
        "l_orderkey",
        F.when(F.col("l_linenumber") == 7, F.lit(99)).otherwise(F.col("s_nationkey")).alias("PULocationID"),
        "l_quantity",
        F.col("l_extendedprice").alias("fare_amount"),
        F.col("l_discount").alias("tip_amount"),
        F.col("l_tax").alias("tolls_amount"),
        "l_linenumber",
        (F.when(F.col("l_returnflag") == "R", 1).otherwise(0) + F.when(F.col("l_linestatus") == "O", 2).otherwise(0)).alias("flags"),
    )
    # Both sides grow with the data: always a shuffle (sort-merge) join, never
    # a broadcast picked from a low file-size estimate of the line items.  Where
    # the session names a number of partitions for it, both sides are dealt by
    # the order key into that many, whatever the default for small shuffles.
    partitions = lineitem.sparkSession.conf.get(PARTITIONS_CONF, None)
    if partitions:
        lines = lines.repartition(int(partitions), "l_orderkey")
        order_nation = order_nation.repartition(int(partitions), "o_orderkey")
    joined = lines.join(order_nation.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select(
        "PULocationID",
        F.when(F.col("l_quantity") == 50, F.lit(None).cast("int")).otherwise(F.col("c_nationkey")).alias("DOLocationID"),
        "fare_amount",
        "tip_amount",
        "tolls_amount",
        F.col("l_quantity").alias("extra"),
        (F.col("l_linenumber") / F.lit(2.0)).alias("mta_tax"),
        F.when(F.col("flags") % 2 == 1, F.lit(None).cast("double")).otherwise(F.lit(2.5)).alias("congestion_surcharge"),
        F.when(F.col("flags") >= 2, F.lit(1.75)).otherwise(F.lit(0.0)).alias("airport_fee"),
        (F.col("fare_amount") + F.col("tip_amount") + F.col("tolls_amount") + F.col("l_quantity")).alias("total_amount"),
    )


def loc_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loc_trips_from(*(table(spark, sf_dir, n) for n in ("lineitem", "orders", "customer", "supplier")))
