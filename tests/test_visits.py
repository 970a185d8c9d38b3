import datetime

import pytest
from pyspark.errors import PySparkException

from fixtures import ARRIVAL_SCHEMA, ARRIVALS, PORTS, STATES, TEMPERATURES, rows
from landfall.operators import (
    build_visits,
    port_coverage,
    ports_dim,
    stage_arrivals,
    stage_temperatures,
    visits_by,
)
from landfall.sources import read_lines, read_temperatures

KNOWN = ["ABC", "DEF", "INX", "MOB", "NOT", "GHI"]


@pytest.fixture
def star(spark, tmp_path):
    for name, text in [("ports", PORTS), ("states", STATES), ("temperatures", TEMPERATURES)]:
        (tmp_path / name).write_text(text)
    arrivals = stage_arrivals(spark.createDataFrame(ARRIVALS, ARRIVAL_SCHEMA), KNOWN)
    ports = ports_dim(*[read_lines(spark, str(tmp_path / n)) for n in ("ports", "states")])
    raw = read_temperatures(spark, str(tmp_path / "temperatures"))
    return arrivals, ports, stage_temperatures(raw, "US", 2016, 4)


def april(day):
    return datetime.date(2016, 4, day)


def test_build_visits(star):
    visits = build_visits(*star)
    assert visits.dtypes == [
        ("cicid", "double"), ("arrdate", "date"), ("depdate", "date"), ("stay", "int"),
        ("i94port", "string"), ("i94cit", "int"), ("i94mode", "int"), ("i94visa", "int"),
        ("visatype", "string"), ("avgtemperature", "double"),
    ]
    assert rows(visits) == [
        (1.0, april(1), april(6), 5, "ABC", 582, 1, 2, "B2", 50.5),
        (2.0, april(2), datetime.date(2016, 3, 27), -6, "DEF", 717, 2, 1, "B1", 51.25),
        (3.0, april(1), april(1), 0, "INX", 717, 1, 1, "B1", 30.0),
        (4.0, april(3), april(5), 2, "MOB", 717, 1, 1, "B1", 70.5),
    ]


def test_two_temperatures_of_a_day_give_two_visits(star):
    arrivals, ports, daily = star
    twice = daily.unionAll(daily.withColumn("avgtemperature", daily.avgtemperature + 1))
    assert build_visits(arrivals, ports, twice).count() == 8


def test_impossible_dates(spark, star):
    arrivals, ports, daily = star
    wrong = daily.limit(1).selectExpr(
        *[c if c not in ("month", "day") else f"{'2' if c == 'month' else '30'} AS {c}"
          for c in daily.columns]
    )
    with pytest.raises(PySparkException):
        build_visits(arrivals, ports, daily.unionAll(wrong)).collect()
    assert build_visits(arrivals, ports, daily.unionAll(wrong), lenient_dates=True).count() == 4


def test_port_coverage(star):
    assert rows(port_coverage(*star)) == [
        ("ABC", 3, 3, 1),
        ("DEF", 1, 1, 1),
        ("GHI", 1, 0, 0),
        ("INX", 1, 1, 1),
        ("MOB", 1, 1, 1),
        ("NOT", 1, 1, 0),
    ]


@pytest.fixture
def ranked_inputs(spark):
    ports = spark.createDataFrame(
        [("p1", "X", "s1", "ONE"), ("p2", "X", "s1", "ONE"), ("p3", "Y", "s1", "ONE"),
         ("p4", "Z", "s2", "TWO"), ("p5", "W", "s3", "THREE")],
        "code string, city string, state string, state_name string",
    )
    visits = spark.createDataFrame(
        [("p1", 10.0), ("p1", 20.0), ("p2", None), ("p3", 40.0),
         ("p4", 50.0), ("p4", 61.0), ("p4", None), ("p4", 50.0), ("p5", None), ("??", 99.0)],
        "i94port string, avgtemperature double",
    )
    return visits, ports


def test_rankings(ranked_inputs):
    def top(*args, **kwargs):
        return [tuple(r) for r in visits_by(*ranked_inputs, *args, **kwargs).collect()]

    # Equal counts are ordered by name; missing temperatures count as visits only.
    assert top() == [("ONE", 23.33, 4), ("TWO", 53.67, 4), ("THREE", None, 1)]
    assert top(order="avg_temperature", n=2) == [("TWO", 53.67, 4), ("ONE", 23.33, 4)]
    assert top("city", "count", 5, state="s1") == [("X", 15.0, 3), ("Y", 40.0, 1)]
    assert top("city", "avg_temperature", 1, state="s1") == [("Y", 40.0, 1)]
    assert top("city", state="nowhere") == []
