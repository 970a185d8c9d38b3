import datetime

import pytest

from fixtures import COUNTRIES, PORTS, STATES, TRAVEL_MODES, VISAS, rows
from landfall.fixed import JUNK_COUNTRIES, OTHER_COUNTRIES
from landfall.operators import (
    code_list,
    date_dim,
    known_ports,
    port_places,
    port_rejects,
    ports_dim,
)
from landfall.sources import read_lines


@pytest.fixture
def lines(spark, tmp_path):
    def write(text):
        path = tmp_path / f"lines-{len(list(tmp_path.iterdir()))}"
        path.write_bytes(text.encode())
        return read_lines(spark, str(path))

    return write


def test_countries(lines):
    dim = code_list(lines(COUNTRIES), JUNK_COUNTRIES, OTHER_COUNTRIES)
    assert dim.dtypes == [("code", "int"), ("name", "string")]
    assert rows(dim) == [
        (0, "Other countries"),
        (54, "Other countries"),
        (311, "Other countries"),
        (582, "FREEDONIA Air, Sea (A-1, no land)"),
        (687, "ZEMBLA"),
        (717, "RURITANIA"),
    ]


def test_modes_and_visas(lines):
    assert rows(code_list(lines(TRAVEL_MODES))) == [(1, "Air"), (2, "Sea"), (9, "Not reported")]
    assert rows(code_list(lines(VISAS))) == [(1, "Business"), (2, "Pleasure")]


def test_known_ports(lines):
    known = known_ports(lines(PORTS))
    codes = {r.code: r.place for r in known.collect()}
    assert set(codes) == {"ABC", "DEF", "INX", "MOB", "NOT", "GHI", "JKL", "MNO", "FOR"}
    assert codes["INX"].startswith("IN''L FALLS")


def test_ports_dim(lines):
    assert rows(ports_dim(lines(PORTS), lines(STATES))) == [
        ("ABC", "CITY", "ST", "STATE OF T"),
        ("DEF", "CITY", "ST", "STATE OF T"),
        ("INX", "INL FALLS", "ST", "STATE OF T"),
        ("MOB", "MOBILE", "AL", "ALABAMA"),
        ("NOT", "UNMEASURED", "AL", "ALABAMA"),
    ]


def test_port_rejects_complete_the_dim(lines):
    ports, states = lines(PORTS), lines(STATES)
    rejects = port_rejects(ports, states)
    assert rows(rejects, "code") == [
        ("AB", "Other US ports", None),
        ("FOR", "FARAWAY", "FREEDONIA"),
        ("GHI", "GROVE", "ST (XYZ)"),
        ("JKL", "A", "B, ST"),
        ("MNO", "MEADOW ST", None),
        ("PQR", "Other US ports", None),
        ("STU", "Other US ports", None),
        ("VWX", "Other US ports", None),
    ]
    assert rejects.count() + ports_dim(ports, states).count() == port_places(ports).count()


def test_lenient_states(lines):
    dim = ports_dim(lines(PORTS), lines(STATES), "lenient")
    found = {r.code: (r.city, r.state) for r in dim.collect()}
    assert found["GHI"] == ("GROVE", "ST")
    assert found["JKL"] == ("A, B", "ST")
    assert found["MNO"] == ("MEADOW", "ST")
    assert found["DEF"] == ("CITY", "ST")
    assert not {"FOR", "PQR", "STU", "VWX", "AB"} & set(found)


def test_date_dim(spark):
    days = [datetime.date.fromisoformat(d) for d in ("2016-01-03", "2016-01-04", "2016-04-01")]
    df = spark.createDataFrame([(d, 1) for d in days * 2], "arrdate date, x int")
    assert rows(date_dim(df)) == [
        (days[0], 3, "Sun", 53, 1, 2016),
        (days[1], 4, "Mon", 1, 1, 2016),
        (days[2], 1, "Fri", 13, 4, 2016),
    ]
