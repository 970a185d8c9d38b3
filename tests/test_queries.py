"""Every registered query against its SQL, run by an independent engine on whole tables."""

import datetime
import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from landfall.plans.registry import QUERIES

ROOT = Path("/root/testdata")
TABLES = "region nation customer supplier part orders lineitem events".split()

# Names of one type in the two engines.
SAME_TYPE = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "date": "DATE", "boolean": "BOOLEAN",
}


def comparable(row):
    def key(value):
        if isinstance(value, float) and math.isnan(value):
            value = "nan"
        if isinstance(value, datetime.date):
            value = value.isoformat()
        return (value is not None, str(type(value)), value if value is not None else 0)

    return tuple(key(v) for v in row)


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, name, scale):
    sf_dir = str(ROOT / scale)
    df = contract.queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS FROM '{sf_dir}/{table}.parquet'")
    expected = db.sql(contract.oracle_sql()[name])
    assert columns == sorted(expected.columns)
    types = dict(zip(expected.columns, map(str, expected.types)))
    assert {c: SAME_TYPE[t] for c, t in df.dtypes} == types
    got = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=comparable)
    want = sorted(expected.select(*[f'"{c}"' for c in columns]).fetchall(), key=comparable)
    assert len(got) == len(want)
    assert got == want
    if scale == "sf0.01":
        assert got


def test_every_query_has_sql():
    assert contract.queries().keys() >= QUERIES.keys()
    assert contract.oracle_sql().keys() >= QUERIES.keys()


def test_entry(spark):
    assert 0 < contract.entry(spark).count() <= 10
