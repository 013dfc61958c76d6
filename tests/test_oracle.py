"""Every registered key against its DuckDB SQL on sf0.001 (the driver does sf0.01)."""

import pytest

import __spark_entry__ as entry
from farebox.oracle import ORACLE
from farebox.registry import QUERIES
from tests.conftest import SF_SMALL
from tests.oracle_compare import compare, duck

KEYS = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_key_has_oracle():
    assert set(QUERIES) == set(ORACLE) and set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())
    assert len(KEYS) >= 66


@pytest.mark.parametrize("name", KEYS)
def test_matches_oracle(spark, con, name):
    ok, msg = compare(spark, con, name, entry.queries()[name], entry.oracle_sql()[name], SF_SMALL)
    assert ok, msg


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 6
    assert df.columns[0] == "Borough" and "Total_Revenue" in df.columns
