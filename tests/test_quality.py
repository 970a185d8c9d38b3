import datetime

import pytest

from landfall.operators.quality import (
    column_exists,
    column_type,
    date_present,
    has_rows,
    in_period,
    raise_on_failure,
    report,
)


@pytest.fixture
def table(spark):
    days = [datetime.date(2016, 4, 1), datetime.date(2016, 4, 30), datetime.date(2016, 5, 1), None]
    ids = [1.0, 1.0, None, None]
    return spark.createDataFrame(list(zip(ids, days)), "id double, day date")


def results(df):
    return [tuple(r) for r in df.collect()]


@pytest.mark.parametrize("key", [(), ("id",)])
def test_one_pass_for_all_checks(table, key):
    checks = [
        column_exists(table, "id"),
        column_exists(table, "gone"),
        column_type(table, "id", "double"),
        column_type(table, "id", "int"),
        column_type(table, "gone", "int"),
        in_period("day", 2016, 4),
        date_present("day"),
        has_rows(),
        has_rows(5),
    ]
    expected = [
        ("column_exists", "t", "id", True, 4, 0),
        ("column_exists", "t", "gone", False, 4, 4),
        ("column_type", "t", "id", True, 4, 0),
        ("column_type", "t", "id", False, 4, 4),
        ("column_type", "t", "gone", False, 4, 4),
        ("in_period", "t", "day", False, 4, 1),
        ("date_present", "t", "day", False, 4, 1),
        ("has_rows", "t", "", True, 4, 0),
        ("has_rows", "t", "", False, 4, 0),
    ]
    if key:
        expected.append(("unique_key", "t", "id", False, 4, 2))
    assert results(report(table, "t", checks, key)) == expected


def test_unique_key_of_several_columns(table):
    assert results(report(table, "t", key=["id", "day"])) == [
        ("unique_key", "t", "id,day", True, 4, 0)
    ]


def test_empty_table(table):
    empty = table.filter("id > 9")
    checks = [column_exists(empty, "gone"), in_period("day", 2016, 4), has_rows()]
    assert results(report(empty, "t", checks, key=["id"])) == [
        ("column_exists", "t", "gone", False, 0, 0),
        ("in_period", "t", "day", True, 0, 0),
        ("has_rows", "t", "", False, 0, 0),
        ("unique_key", "t", "id", True, 0, 0),
    ]


def test_raise_on_failure(table):
    assert len(raise_on_failure(report(table, "t", [has_rows()], key=["id", "day"]))) == 2
    with pytest.raises(ValueError, match=r"in_period on t\(day\): 1 violations in 4 rows"):
        raise_on_failure(report(table, "t", [has_rows(), in_period("day", 2016, 4)]))
