import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from landfall.functions import (
    date_from_parts,
    halves,
    outside_period,
    replace_junk,
    sas_date,
    serial_in_period,
    stay_days,
    strip,
    whole,
)

NAN = float("nan")


def value(spark, column, schema, *row):
    return spark.createDataFrame([row], schema).select(column.alias("v")).first().v


@pytest.mark.parametrize("serial, day", [
    (20545.0, "2016-04-01"), (20546.5, "2016-04-02"), (-1.5, "1959-12-30"), (-1.0, "1959-12-31"),
    (0.5, "1960-01-01"), (0.0, None), (-0.0, None), (None, None), (NAN, None),
])
def test_sas_date(spark, serial, day):
    expected = day and datetime.date.fromisoformat(day)
    assert value(spark, sas_date("s"), "s double", serial) == expected


def test_sas_date_of_whole_number_columns(spark):
    assert value(spark, sas_date("s"), "s int", 366) == datetime.date(1961, 1, 1)


@pytest.mark.parametrize("arrival, departure, days", [
    (20545.0, 20550.5, 5), (20546.5, 20540.2, -6), (0.0, -1.5, -1), (20545.0, 20545.9, 0),
    (None, 20550.0, None), (20545.0, None, None), (NAN, 20550.0, None),
])
def test_stay_days(spark, arrival, departure, days):
    column = stay_days("a", "d")
    assert value(spark, column, "a double, d double", arrival, departure) == days


def test_date_from_parts(spark):
    parts = "y int, m int, d int"
    column = date_from_parts("y", "m", "d")
    assert value(spark, column, parts, 2016, 2, 29) == datetime.date(2016, 2, 29)
    with pytest.raises(PySparkException):
        value(spark, column, parts, 2016, 2, 30)
    lenient = date_from_parts("y", "m", "d", lenient=True)
    assert value(spark, lenient, parts, 2016, 2, 9) == datetime.date(2016, 2, 9)
    assert value(spark, lenient, parts, 2016, 2, 30) is None
    assert value(spark, lenient, parts, None, 2, 3) is None


@pytest.mark.parametrize("day, outside", [
    ("2016-04-01", False), ("2016-04-30", False), ("2016-05-01", True), ("2015-04-01", True),
    (None, None),
])
def test_outside_period(spark, day, outside):
    day = day and datetime.date.fromisoformat(day)
    assert value(spark, outside_period("d", 2016, 4), "d date", day) is outside


@pytest.mark.parametrize("period, inside, out", [
    ((2016, 4), [20545.0, 20574.99], [20544.99, 20575.0]),
    ((2016, 12), [20789.0, 20819.5], [20788.0, 20820.0]),
])
def test_serial_in_period(spark, period, inside, out):
    column = serial_in_period("s", *period)
    assert all(value(spark, column, "s double", s) for s in inside)
    assert not any(value(spark, column, "s double", s) for s in out)


@pytest.mark.parametrize("text, bare", [
    ("  a b ", "a b"), ("\t a\r\n", "a"), (" a　", "a"), (" \t ", ""), (None, None),
])
def test_strip(spark, text, bare):
    assert value(spark, strip(F.col("t")), "t string", text) == bare


def test_halves(spark):
    first, second = halves(F.col("t"), "=")
    assert value(spark, first, "t string", "a = b=c") == "a "
    assert value(spark, second, "t string", "a = b=c") == " b=c"
    assert value(spark, second, "t string", "no separator") is None


@pytest.mark.parametrize("text, expected", [
    ("INVALID: X", "Other"), ("x Gone y", "x Other"), ("Gone INVALID", "Other"), ("ok", "ok"),
])
def test_replace_junk(spark, text, expected):
    assert value(spark, replace_junk(F.col("t"), ["INVALID", "Gone"], "Other"), "t string",
                 text) == expected


def test_whole(spark):
    assert value(spark, whole("x"), "x double", 582.0) == 582
    assert value(spark, whole("x"), "x double", NAN) is None


def test_markers_separators_and_names_are_plain_text(spark):
    from landfall.functions.text import halves, replace_junk

    df = spark.createDataFrame([("x A (y) z", "a.b.c"), ("x A y z", "abc")], "t string, s string")
    rows = df.select(replace_junk(df.t, ["A (y)"], r"$1 \\ n").alias("t"), *halves(df.s, ".")).collect()
    assert [tuple(r) for r in rows] == [(r"x $1 \\ n", "a", "b.c"), ("x A y z", "abc", None)]
