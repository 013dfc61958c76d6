"""Files whose schemas differ, read as one table; inferred schemas kept beside their source."""

import os
import time

import pytest
from pyspark.sql import types as T

from farebox.registry import _months
from farebox.sources import merged, rawfiles, read_csv_inferred, read_csv_remembered, read_merged, schema_store, tables
from tests.conftest import SF_SMALL, explain_text
from tests.test_argmax import jobs_of

INT, LONG, FLOAT, DOUBLE, TEXT = T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType(), T.StringType()


@pytest.mark.parametrize("a,b,want", [
    (INT, INT, INT), (INT, LONG, LONG), (INT, DOUBLE, DOUBLE), (LONG, FLOAT, DOUBLE), (T.ShortType(), FLOAT, FLOAT),
    (INT, TEXT, TEXT), (T.NullType(), INT, INT), (T.DateType(), T.TimestampType(), T.TimestampType()),
    (T.TimestampNTZType(), T.DateType(), T.TimestampNTZType()), (T.TimestampNTZType(), T.TimestampType(), T.TimestampType()),
    (T.DecimalType(10, 2), INT, T.DecimalType(12, 2)), (T.DecimalType(10, 2), T.DecimalType(8, 4), T.DecimalType(12, 4)),
    (T.DecimalType(38, 2), T.DecimalType(38, 10), DOUBLE), (T.DecimalType(10, 2), FLOAT, DOUBLE),
    (T.BooleanType(), INT, TEXT), (T.DateType(), INT, TEXT), (T.DecimalType(10, 2), T.DateType(), TEXT)])
def test_wider_types(a, b, want):
    assert merged.wider(a, b) == want and merged.wider(b, a) == want


def test_months_of_different_schemas(spark):
    paths = _months(spark, SF_SMALL)
    names = [spark.read.parquet(p).columns for p in paths]
    assert "airport_fee" in names[0] and "Airport_fee" in names[1] and "AIRPORT_FEE" in names[2]
    table = read_merged(spark, paths)
    assert table.columns == [*names[0], "note"] and dict(table.dtypes)["DOLocationID"] == "double"
    loc = tables.loc_trips(spark, SF_SMALL)
    columns = loc.columns
    got = sorted(map(str, table.select(*columns).withColumns({c: table[c].cast("int") for c in ("PULocationID", "DOLocationID")}).collect()))
    assert got == sorted(map(str, loc.collect()))
    plan = explain_text(table.where("DOLocationID = 3 AND airport_fee > 1").select("fare_amount"), "simple")
    assert plan.count("ReadSchema") == 3 and plan.lower().count("greaterthan(airport_fee,1.0)") == 3  # filters reach every scan
    assert "tip_amount" not in plan.split("PushedFilters", 1)[1].split("ReadSchema", 1)[1].split("\n")[0]


def test_files_alike_are_read_together(spark, scratch):
    loc = tables.loc_trips(spark, SF_SMALL)
    paths = [scratch(f"m{i}") for i in range(5)]
    for i, path in enumerate(paths):
        loc.where(f"coalesce(PULocationID, 0) % 5 = {i}").write.parquet(path)
    table = read_merged(spark, paths)
    assert explain_text(table, "simple").count("FileScan") == 1 and table.count() == loc.count()


def test_merged_csv(spark, tmp_path):
    texts = {"a.csv": "id,Fee,when\n1,2,2024-01-01 10:00:00\n2,,2024-01-02 10:00:00\n",
             "b.csv": "WHEN,fee,ID\n2024-02-01 10:00:00,2.5,3\n", "c.csv": "id,fee\n4,none\n"}
    for name, body in texts.items():
        (tmp_path / name).write_text(body)
    two = read_merged(spark, [str(tmp_path / n) for n in ("a.csv", "b.csv")], "csv")
    assert two.dtypes == [("id", "int"), ("Fee", "double"), ("when", "timestamp")]
    assert sorted((r.id, r.Fee) for r in two.collect() if r.id != 2) == [(1, 2.0), (3, 2.5)]
    three = read_merged(spark, [str(tmp_path / n) for n in texts], "csv")
    assert dict(three.dtypes)["Fee"] == "string" and {r.Fee for r in three.collect()} == {"2", None, "2.5", "none"}
    with pytest.raises(ValueError, match="no paths"):
        read_merged(spark, [])
    with pytest.raises(ValueError, match="case only"):
        merged.merged_schema([T.StructType([T.StructField("a", INT), T.StructField("A", INT)])])


def test_a_second_read_infers_nothing(spark, scratch):
    path = scratch("loc_csv")
    loc = read_csv_inferred(spark, rawfiles.write_loc_csv(spark, SF_SMALL))
    loc.write.csv(path, header=True)
    assert jobs_of(spark, "first", lambda: read_csv_remembered(spark, path)) > 0
    assert jobs_of(spark, "second", lambda: read_csv_remembered(spark, path)) == 0
    again = read_csv_remembered(spark, path)
    assert again.dtypes == loc.dtypes and again.count() == loc.count()
    # a further file, of another type, makes it infer anew
    loc.selectExpr(*[f"'text' AS {c}" if c == "extra" else c for c in loc.columns]).limit(3).write.mode("append").csv(path, header=True)
    assert schema_store.remembered_schema(spark, path) is None
    assert dict(read_csv_remembered(spark, path).dtypes)["extra"] == "string"
    assert jobs_of(spark, "third", lambda: read_csv_remembered(spark, path)) == 0


def test_a_changed_file_and_a_cut_note(spark, tmp_path):
    path = str(tmp_path / "z.csv")
    with open(path, "w") as f:
        f.write("a,b\n1,2\n")
    assert read_csv_remembered(spark, path).dtypes == [("a", "int"), ("b", "int")]
    assert schema_store.remembered_schema(spark, path) is not None
    with open(path, "w") as f:
        f.write("a,b\n1,x\n")  # the same length
    os.utime(path, (time.time() + 5, time.time() + 5))
    assert read_csv_remembered(spark, path).dtypes == [("a", "int"), ("b", "string")]
    kept = schema_store.schema_path(spark, path).removeprefix("file:")
    with open(kept, "w") as f:
        f.write('{"format": 1, "fil')
    os.remove(kept.replace("_schema", "._schema") + ".crc")
    assert schema_store.remembered_schema(spark, path) is None
    pattern = str(tmp_path / "*.csv")
    assert read_csv_remembered(spark, pattern).count() == 1 and schema_store.remembered_schema(spark, pattern) is not None


def test_a_source_that_cannot_be_written_to(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "z.csv")
    with open(path, "w") as f:
        f.write("a\n1\n")

    def refuse(*_):
        raise OSError("java.io.IOException: read-only store")

    monkeypatch.setattr(schema_store, "_write", refuse)
    assert read_csv_remembered(spark, path).dtypes == [("a", "int")]
    assert schema_store.remembered_schema(spark, path) is None
