"""Hand-written dirty trip file: what each reader keeps."""

import os

import pytest

from farebox.plans import q1, q2
from farebox.schemas import TRIP_COLUMNS_19
from farebox.sources import text
from farebox.sources.csv import read_csv_with_schema

HEADER = ",".join(name for name, _ in TRIP_COLUMNS_19)


def row(vendor="1", hour=19, lon="-73.99", lat="40.75", dlon="-73.97", dlat="40.76", pickup=None):
    pickup = pickup if pickup is not None else f"2015-01-15 {hour:02d}:05:39"
    fields = [vendor, pickup, f"2015-01-15 {hour:02d}:23:42", "1", "1.59", lon, lat, "1", "N", dlon, dlat,
              "1", "12", "1", "0.5", "3.25", "0", "0.3", "17.05"]
    return ",".join(fields)


LINES = [
    HEADER,
    row(hour=19),                                    # good
    row(hour=1, pickup="2015-01-15 1x:05:39"),       # bad pickup timestamp
    ",".join(row(hour=20).split(",")[:8]),           # short line, 8 fields
    ",".join(row(hour=2).split(",")[:4]),            # short line, 4 fields
    row(vendor="1.0", hour=22, lat="40.70"),         # vendor not an int
    row(hour=3, lat=""),                             # empty pickup coordinate
    row(hour=23, dlat=""),                           # empty drop-off coordinate
    row(hour=4, lon="0"),                            # zero pickup coordinate
    HEADER,                                          # header repeated mid-file
    row(vendor="2", hour=5, lat="40.8d"),            # typed-literal suffix: not a number
]


@pytest.fixture(scope="module")
def dirty_path(tmp_path_factory):
    d = tmp_path_factory.mktemp("dirty")
    p = os.path.join(d, "trips.csv")
    with open(p, "w") as f:
        f.write("\n".join(LINES) + "\n")
    return p


def test_strip_header_drops_every_copy(spark, dirty_path):
    lines = text.read_lines(spark, dirty_path)
    assert text.first_line(lines) == HEADER
    kept = [r.value for r in text.strip_header(lines).collect()]
    assert HEADER not in kept and len(kept) == len(LINES) - 2


def test_q1_text_keeps_rows_with_fields_1_5_6(spark, dirty_path):
    rows = q1.hourly_avg_text(text.read_lines(spark, dirty_path)).collect()
    assert [r.hour for r in rows] == [19, 20, 22, 23]
    by_hour = {r.hour: r for r in rows}
    assert by_hour[22].avg_latitude == pytest.approx(40.70)   # field 6 is the latitude
    assert by_hour[19].avg_longitude == pytest.approx(-73.99)  # field 5 is the longitude


def test_q2_text_keeps_only_complete_rows(spark, dirty_path):
    rows = q2.longest_text(text.read_lines(spark, dirty_path)).collect()
    assert [r.VendorID for r in rows] == [1]
    assert rows[0].duration_min == pytest.approx(18.05)


def test_dropped_lines_are_counted_in_the_same_pass(spark, dirty_path):
    from pyspark.sql import Observation

    from tests.test_argmax import jobs_of

    lines = text.strip_header(text.read_lines(spark, dirty_path), HEADER)
    seen = Observation()
    parsed = text.parse_lines(lines, q2.TEXT_SPEC, seen=seen)
    assert jobs_of(spark, "parse", lambda: parsed.collect()) == 1
    counts = dict(text.line_counts(seen))
    assert sum(counts.values()) == len(LINES) - 2 and counts["kept"] == parsed.count()
    assert counts["VendorID: no int"] == 1 and counts["tpep_pickup_datetime: no timestamp"] == 1
    assert counts["pickup_longitude: missing"] == 1 and counts["dropoff_longitude: missing"] == 1
    # of the longest trips, which scan twice, and of the hourly means
    for form, spec in ((q2.longest_text, q2.TEXT_SPEC), (q1.hourly_avg_text, q1.TEXT_SPEC)):
        seen = Observation()
        form(text.read_lines(spark, dirty_path), HEADER, seen=seen).collect()
        assert dict(text.line_counts(seen))["kept"] == text.parse_lines(lines, spec).count()


def test_q1_csv_fixed_schema_is_permissive(spark, dirty_path):
    rows = q1.hourly_avg(read_csv_with_schema(spark, dirty_path)).collect()
    # bad timestamp -> null hour group; short 8-field line and 1.0 vendor kept;
    # the CSV reader takes Java number syntax, so "40.8d" is 40.8 here (the
    # text parser rejects it)
    assert [r.hour for r in rows] == [None, 5, 19, 20, 22, 23]


def test_check_header_rejects_renamed_columns(spark, tmp_path):
    p = tmp_path / "renamed.csv"
    p.write_text(HEADER.replace("VendorID", "vendor_id") + "\n" + row() + "\n")
    with pytest.raises(Exception):
        read_csv_with_schema(spark, str(p), check_header=True).collect()
    assert read_csv_with_schema(spark, str(p)).count() == 1  # default binds by position


def test_headers_of_every_part_file_are_dropped(spark, scratch):
    from farebox.sinks.writers import write_csv
    from farebox.sources import tables
    from tests.conftest import SF_SMALL

    geo = tables.geo_trips(spark, SF_SMALL).select(*[n for n, _ in TRIP_COLUMNS_19])
    path = write_csv(geo.repartition(3), scratch("geo3"))
    lines = text.read_lines(spark, path)
    assert lines.where(lines.value == HEADER).count() == 3
    assert text.strip_header(lines).count() == geo.count()
    got = sorted((r.hour, round(r.avg_latitude, 9)) for r in q1.hourly_avg_text(lines).collect())
    want = sorted((r.hour, round(r.avg_latitude, 9)) for r in q1.hourly_avg(geo).collect())
    assert got == want


def test_header_found_when_files_are_split(spark):
    from farebox.sources import rawfiles
    from tests.conftest import SF_MID

    path = rawfiles.write_geo_csv(spark, SF_MID)  # ~1 MB of lines
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(64 * 1024))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        lines = text.read_lines(spark, path)
        assert lines.rdd.getNumPartitions() > 4
        assert text.first_line(lines) == HEADER
        assert text.strip_header(lines).count() == 10_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
