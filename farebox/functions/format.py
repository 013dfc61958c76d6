"""Number-to-text formats for report lines (``printf``-style, JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The report and record layouts of the original outputs.
HOURLY_LINE = "Hour: %02d | Avg Latitude: %.6f | Avg Longitude: %.6f"
VENDOR_LINE = "VendorID: %d | Distance: %.2f km | Duration: %.2f min"
VENDOR_RECORD = "%d,%.3f,%.1f"


def hourly_line(hour: str, lat: str, lon: str) -> Column:
    """``Hour: 07 | Avg Latitude: 40.123456 | Avg Longitude: -73.123456``."""
    return F.format_string(HOURLY_LINE, F.col(hour), F.col(lat), F.col(lon))


def vendor_line(vendor: str, km: str, minutes: str) -> Column:
    """``VendorID: 1 | Distance: 12.34 km | Duration: 5.67 min``."""
    return F.format_string(VENDOR_LINE, F.col(vendor), F.col(km), F.col(minutes))


def csv_record(*cols: str) -> Column:
    """Comma-joined record at full precision (string cast of each value)."""
    return F.concat_ws(",", *[F.col(c).cast("string") for c in cols])


def fixed_record(fmt: str, *cols: str) -> Column:
    """Comma-joined record with fixed formats, e.g. ``VENDOR_RECORD``."""
    return F.format_string(fmt, *[F.col(c) for c in cols])
