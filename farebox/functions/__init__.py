"""Column expressions (all JVM-side, codegen-friendly) and the one Python UDF."""

from farebox.functions.geo import haversine_km_asin, haversine_km_atan2, nonzero_points
from farebox.functions.temporal import (
    add_seconds,
    hour_of,
    hour_in_wrapped_range,
    minutes_between,
    pickup_before_dropoff,
)

__all__ = [
    "add_seconds",
    "haversine_km_asin",
    "haversine_km_atan2",
    "hour_in_wrapped_range",
    "hour_of",
    "minutes_between",
    "nonzero_points",
    "pickup_before_dropoff",
]
