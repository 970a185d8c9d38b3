from collections import Counter

import pytest

from fixtures import ARRIVAL_SCHEMA, ARRIVALS, TEMPERATURES, rows
from landfall.operators import (
    distinct_where_repeated,
    keep_listed,
    repeated_values,
    stage_arrivals,
    stage_temperatures,
)
from landfall.sources import read_delimited, read_temperatures

KNOWN = ["ABC", "DEF", "INX", "MOB", "NOT", "GHI"]


@pytest.mark.parametrize("as_table", [True, False])
def test_stage_arrivals(spark, as_table):
    raw = spark.createDataFrame(ARRIVALS, ARRIVAL_SCHEMA)
    known = spark.createDataFrame([(c, "place") for c in KNOWN], "code string, place string")
    staged = stage_arrivals(raw, known if as_table else KNOWN)
    assert staged.columns == raw.columns
    assert [r.cicid for r in staged.orderBy("cicid").collect()] == [1, 2, 3, 4, 5, 6, 7, 8]


def test_repeated_codes_do_not_repeat_rows(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "port string")
    codes = spark.createDataFrame([("a",), ("a",), (None,)], "code string")
    assert rows(keep_listed(df, "port", codes)) == [("a",), ("a",)]


def test_distinct_by_key_is_distinct(spark):
    keys = [None, 0.0, -0.0, 1.0, float("nan")]
    data = [(k, v) for k in keys for v in (None, "a", "b")] * 2 + [(2.0, "a"), (3.0, None)]
    df = spark.createDataFrame(data, "k double, v string")
    got = distinct_where_repeated(df, "k", repeated_values(df, "k"))
    # Adding zero makes one value of the two zeros, which are equal to Spark.
    assert Counter(repr(tuple(r)) for r in got.selectExpr("k + 0.0D", "v").collect()) == Counter(
        repr(tuple(r)) for r in df.distinct().selectExpr("k + 0.0D", "v").collect()
    )


@pytest.fixture
def raw_temperatures(spark, tmp_path):
    path = tmp_path / "temperatures.csv"
    path.write_text(TEMPERATURES)
    return read_temperatures(spark, str(path))


def test_temperatures_read_typed_with_lower_case_names(raw_temperatures):
    assert raw_temperatures.dtypes == [
        ("region", "string"), ("country", "string"), ("state", "string"), ("city", "string"),
        ("month", "int"), ("day", "int"), ("year", "int"), ("avgtemperature", "double"),
    ]


def test_stage_temperatures(raw_temperatures):
    staged = stage_temperatures(raw_temperatures, "US", 2016, 4)
    kept = staged.select("state", "city", "day", "avgtemperature")
    assert rows(kept) == [
        ("ALABAMA", "MOBILE", 3, 70.5),  # two spellings, one row
        ("STATE OF T", "CITY", 1, 50.5),
        ("STATE OF T", "CITY", 2, 51.25),
        ("STATE OF T", "INL FALLS", 1, 30.0),
    ]
    assert stage_temperatures(raw_temperatures, "US").count() == 6
    assert stage_temperatures(raw_temperatures, "XX", 2016, 4).count() == 1


def test_columns_of_a_csv_are_found_by_name(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text("b,A\n1,x\nwrong,y\n")
    df = read_delimited(spark, str(path), {"a": "string", "b": "int"})
    assert rows(df, "A") == [(1, "x"), (None, "y")]
