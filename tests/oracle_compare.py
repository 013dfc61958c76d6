"""Spark-vs-DuckDB comparison used by the tests and by ``python -m tests.oracle_compare``.

Row count, column names, column type families and the multiset of rows
(columns sorted by name) must all agree.
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]

SPARK_FAMILY = {"IntegerType": "int32", "LongType": "int64", "DoubleType": "float64", "StringType": "str",
                "BooleanType": "bool", "ShortType": "int16", "ByteType": "int8"}
DUCK_FAMILY = {"INTEGER": "int32", "BIGINT": "int64", "DOUBLE": "float64", "VARCHAR": "str", "BOOLEAN": "bool",
               "SMALLINT": "int16", "TINYINT": "int8"}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return 0.0 if v == 0 else v
    return v


def _rows(cols: list[str], rows) -> list[tuple]:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def compare(spark, con, name: str, query, sql: str, sf_dir: str) -> tuple[bool, str]:
    df = query(spark, sf_dir)
    s_cols = df.columns
    s_types = [SPARK_FAMILY.get(type(f.dataType).__name__, type(f.dataType).__name__) for f in df.schema.fields]
    s_rows = [tuple(r) for r in df.collect()]
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_types = [DUCK_FAMILY.get(str(c[1]), str(c[1])) for c in res.description]
    d_rows = res.fetchall()
    problems = []
    if sorted(s_cols) != sorted(d_cols):
        problems.append(f"columns {s_cols} vs {d_cols}")
    else:
        st = dict(zip(s_cols, s_types))
        dt = dict(zip(d_cols, d_types))
        if st != dt:
            problems.append(f"types {st} vs {dt}")
    if len(s_rows) != len(d_rows):
        problems.append(f"rows {len(s_rows)} vs {len(d_rows)}")
    elif not problems:
        a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
        if a != b:
            diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
            problems.append(f"values differ, e.g. {diff}")
    return (not problems), "; ".join(problems) or f"{len(s_rows)} rows"


def main(argv: list[str]) -> int:
    sys.path.insert(0, ".")
    import __spark_entry__ as entry
    from farebox.session import local_session

    sf_dir = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
    names = argv or sorted(entry.queries())
    spark = local_session()
    con = duck(sf_dir)
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names:
        t = time.time()
        try:
            ok, msg = compare(spark, con, name, qs[name], sqls[name], sf_dir)
        except Exception as exc:  # report and go on
            ok, msg = False, f"{type(exc).__name__}: {str(exc)[:300]}"
        bad += not ok
        print(f"{'OK ' if ok else 'BAD'} {name:28s} {time.time() - t:6.2f}s  {msg}", flush=True)
    print(f"{len(names) - bad}/{len(names)} match")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
