import datetime

import pytest

from fixtures import ARRIVALS, TEMPERATURES, land, rows
from landfall import fixed
from landfall.plans import registry, warehouse
from landfall.sources import read_table

ROWS = {
    fixed.STAGE_ARRIVALS: 8,
    fixed.STAGE_TEMPERATURES: 4,
    fixed.DIM_COUNTRIES: 6,
    fixed.DIM_TRAVEL_MODES: 3,
    fixed.DIM_VISAS: 2,
    fixed.DIM_PORTS: 5,
    fixed.DIM_DATE: 3,
    fixed.FACT_VISITS: 4,
}


def counts(spark, output):
    return {name: read_table(spark, output, name).count() for name in ROWS}


@pytest.mark.parametrize("broadcast_rows", [warehouse.BROADCAST_ROWS, 0])
def test_run_twice(spark, tmp_path, monkeypatch, broadcast_rows):
    """The same tables from a second run, and from joins that broadcast or not."""
    monkeypatch.setattr(warehouse, "BROADCAST_ROWS", broadcast_rows)
    inputs, output = land(spark, tmp_path / "in"), str(tmp_path / "out")
    for _ in range(2):
        done = warehouse.run(spark, inputs, output, 2016, 4, state="ST")
        assert counts(spark, output) == ROWS
    assert [tuple(r)[:4] for r in done.checks] == [
        ("in_period", "arrivals", "arrdate", False),
        ("date_present", "arrivals", "arrdate", False),
        ("well_formed", "temperatures", "_corrupt_record", True),
        ("possible_date", "temperatures", "year,month,day", True),
        ("well_formed", "ports", "value", True),
        ("unique_key", fixed.STAGE_TEMPERATURES, "year,month,day,city,state", True),
        ("has_rows", fixed.DIM_PORTS, "", True),
        ("unique_key", fixed.DIM_PORTS, "code", True),
        ("column_exists", fixed.FACT_VISITS, "cicid", True),
        ("column_type", fixed.FACT_VISITS, "cicid", True),
        ("in_period", fixed.FACT_VISITS, "arrdate", True),
        ("date_present", fixed.FACT_VISITS, "arrdate", True),
        ("has_rows", fixed.FACT_VISITS, "", True),
        ("unique_key", fixed.FACT_VISITS, "cicid", True),
    ]
    assert [tuple(r) for r in done.top_states.collect()] == [
        ("STATE OF T", 43.92, 3), ("ALABAMA", 70.5, 1),
    ]
    assert [tuple(r) for r in done.warmest_states.collect()] == [
        ("ALABAMA", 70.5, 1), ("STATE OF T", 43.92, 3),
    ]
    assert [tuple(r) for r in done.top_cities.collect()] == [
        ("CITY", 50.88, 2), ("INL FALLS", 30.0, 1),
    ]


@pytest.mark.parametrize("broadcast_rows", [10, 0])
@pytest.mark.parametrize("copied", [[], [0], [0, 1, 2]])
def test_distinct_arrivals(spark, tmp_path, monkeypatch, broadcast_rows, copied):
    """Without copies, with some, and with more repeated keys than may be broadcast."""
    monkeypatch.setattr(warehouse, "BROADCAST_ROWS", broadcast_rows)
    data = [(None, "a"), (1.0, "a"), (2.0, "b"), (3.0, "b"), (3.0, "c")]
    path = str(tmp_path / "t")
    df = spark.createDataFrame(data + [data[i] for i in copied] * 3, "cicid double, x string")
    df.write.parquet(path)
    assert rows(warehouse.distinct_arrivals(spark, spark.read.parquet(path))) == data


def test_partition_keys_read_back_typed(spark, tmp_path):
    inputs, output = land(spark, tmp_path / "in"), str(tmp_path / "out")
    warehouse.run(spark, inputs, output, 2016, 4)
    assert dict(read_table(spark, output, fixed.STAGE_ARRIVALS).dtypes)["arrdate"] == "double"
    fact = read_table(spark, output, fixed.FACT_VISITS)
    assert dict(fact.dtypes)["arrdate"] == "date"
    assert fact.columns[-1] == "arrdate"
    dates = read_table(spark, output, fixed.DIM_DATE)
    assert dates.dtypes == [
        ("arrdate", "date"), ("day", "int"), ("weekday", "string"), ("week", "int"),
        ("month", "int"), ("year", "int"),
    ]
    pinned = read_table(spark, output, fixed.STAGE_ARRIVALS, "cicid double, arrdate string")
    assert dict(pinned.dtypes)["arrdate"] == "string"


def test_csv_arrivals(spark, tmp_path):
    inputs, output = land(spark, tmp_path / "in"), str(tmp_path / "out")
    path = str(tmp_path / "csv")
    spark.read.parquet(inputs.arrivals).write.option("header", True).csv(path)
    values = {**vars(inputs), "arrivals": path, "arrivals_format": "csv"}
    warehouse.run(spark, warehouse.Inputs(**values), output, 2016, 4)
    assert counts(spark, output) == ROWS


def test_failed_check_stops_the_job(spark, tmp_path):
    doubled = TEMPERATURES + "North,US,State of T,City,4,1,2016,1.0\n"
    inputs = land(spark, tmp_path / "in", temperatures=doubled)
    found = r"unique_key on stage_city_temperatures\(year,month,day,city,state\): 1 violations"
    with pytest.raises(ValueError, match=found):
        warehouse.run(spark, inputs, str(tmp_path / "out"), 2016, 4)
    assert not (tmp_path / "out" / fixed.FACT_VISITS).exists()


def test_a_bad_fact_is_not_published(spark, tmp_path):
    output = str(tmp_path / "out")
    warehouse.run(spark, land(spark, tmp_path / "in"), output, 2016, 4)
    before = rows(read_table(spark, output, fixed.FACT_VISITS))
    twice = ARRIVALS + [(1.0, 582.0, "ABC", 20546.0, 1.0, 20550.5, 2.0, "B2", "M")]
    inputs = land(spark, tmp_path / "twice", arrivals=twice)
    with pytest.raises(ValueError, match=r"unique_key on fact_i94_visits\(cicid\): 1 violations"):
        warehouse.run(spark, inputs, output, 2016, 4)
    assert rows(read_table(spark, output, fixed.FACT_VISITS)) == before


def test_what_is_left_out_is_counted(spark, tmp_path):
    """Arrivals outside the month or undated, rejected ports, and ports without temperature."""
    output = str(tmp_path / "out")
    done = warehouse.run(spark, land(spark, tmp_path / "in"), output, 2016, 4)
    found = {(r.check_name, r.table_name): (r.rows_checked, r.violations) for r in done.checks}
    assert found["in_period", "arrivals"] == found["date_present", "arrivals"] == (17, 1)
    rejected = read_table(spark, output, fixed.REJECTED_PORTS)
    assert {"GHI", "JKL", "MNO", "FOR"} <= {r.code for r in rejected.collect()}
    assert rows(read_table(spark, output, fixed.PORT_COVERAGE)) == [
        ("ABC", 1, 1, 1), ("DEF", 1, 1, 1), ("GHI", 1, 0, 0), ("INX", 1, 1, 1),
        ("MOB", 1, 1, 1), ("NOT", 1, 1, 0),
    ]
    for name in ["in_period", "date_present"]:
        allowed = warehouse.ALLOWED - {(name, "arrivals")}
        with pytest.raises(ValueError, match=f"{name} on arrivals"):
            warehouse.run(spark, land(spark, tmp_path / name), output, 2016, 4, allowed=allowed)


@pytest.mark.parametrize("row, check", [
    ("North,US,State of T,City,4,9,2O16,1.0", "well_formed on temperatures"),
    ("North,US,State of T,City,4,9,2016,n/a", "well_formed on temperatures"),
    ("North,US,State of T,City,4,31,2016,1.0", "possible_date on temperatures"),
    ("North,US,State of T,City,,9,2016,1.0", "possible_date on temperatures"),
])
def test_bad_temperatures_fail(spark, tmp_path, row, check):
    inputs = land(spark, tmp_path / "in", temperatures=TEMPERATURES + row + "\n")
    with pytest.raises(ValueError, match=check + r"\(.*\): 1 violations"):
        warehouse.run(spark, inputs, str(tmp_path / "out"), 2016, 4)
    assert not (tmp_path / "out").exists()


def test_lenient_dates_are_counted(spark, tmp_path):
    bad = TEMPERATURES + "North,US,State of T,City,4,31,2016,1.0\n"
    inputs, output = land(spark, tmp_path / "in", temperatures=bad), str(tmp_path / "out")
    done = warehouse.run(spark, inputs, output, 2016, 4, lenient_dates=True)
    assert [r.violations for r in done.checks if r.check_name == "possible_date"] == [1]
    assert read_table(spark, output, fixed.FACT_VISITS).count() == ROWS[fixed.FACT_VISITS]


def test_bad_port_lines_fail(spark, tmp_path):
    inputs = land(spark, tmp_path / "in")
    with open(inputs.ports, "a") as file:
        file.write("\nXYZ = NOWHERE, ST")
    with pytest.raises(ValueError, match=r"well_formed on ports\(value\): 1 violations"):
        warehouse.run(spark, inputs, str(tmp_path / "out"), 2016, 4)


def test_malformed_csv_arrivals(spark, tmp_path):
    """They stop the job, or are counted and left out where that is allowed."""
    inputs, output = land(spark, tmp_path / "in"), str(tmp_path / "out")
    path = tmp_path / "arrivals.csv"
    path.write_text(
        "cicid,i94cit,i94port,arrdate,i94mode,depdate,i94visa,visatype,matflag\n"
        "1,717,ABC,20545,1,2055O,1,B1,M\n2,717,ABC,2O545,1,20550,1,B1,M\n3,717,ABC,20545,1,20550,1,B1,M\n"
    )
    values = {**vars(inputs), "arrivals": str(path), "arrivals_format": "csv"}
    inputs = warehouse.Inputs(**values)
    with pytest.raises(ValueError, match=r"well_formed on arrivals\(_corrupt_record\): 2 violations in 3"):
        warehouse.run(spark, inputs, output, 2016, 4)
    allowed = warehouse.ALLOWED | {("well_formed", "arrivals")}
    warehouse.run(spark, inputs, output, 2016, 4, allowed=allowed)
    assert [r.cicid for r in read_table(spark, output, fixed.STAGE_ARRIVALS).collect()] == [3.0]


def test_a_month_without_visits(spark, tmp_path):
    done = warehouse.run(spark, land(spark, tmp_path / "in"), str(tmp_path / "out"), 2016, 7)
    failed = {(r.check_name, r.table_name) for r in done.checks if not r.passed}
    assert ("has_rows", fixed.FACT_VISITS) in failed
    assert done.top_states.collect() == done.top_cities.collect() == []


def test_a_date_that_a_month_no_longer_has(spark, tmp_path):
    output = str(tmp_path / "out")
    for number, arrivals in enumerate([ARRIVALS, [a for a in ARRIVALS if a[3] != 20547.0]]):
        inputs = land(spark, tmp_path / f"in-{number}", arrivals=arrivals)
        warehouse.run(spark, inputs, output, 2016, 4, only_dates=True)
    assert {r.cicid for r in read_table(spark, output, fixed.FACT_VISITS).collect()} == {1.0, 2.0, 3.0}
    assert 4.0 not in {r.cicid for r in read_table(spark, output, fixed.STAGE_ARRIVALS).collect()}
    assert read_table(spark, output, fixed.DIM_DATE).count() == 2


def test_a_month_is_added_to_others(spark, tmp_path):
    output = str(tmp_path / "out")
    april = land(spark, tmp_path / "april")
    warehouse.run(spark, april, output, 2016, 4)
    before = rows(read_table(spark, output, fixed.FACT_VISITS))
    arrivals = [
        (100.0, 717.0, "ABC", 20575.0, 1.0, 20580.0, 1.0, "B1", "M"),
        (101.0, 717.0, "DEF", 20575.0, 1.0, 20581.0, 1.0, "B1", "M"),
        (102.0, 717.0, "ABC", 20545.0, 1.0, 20581.0, 1.0, "B1", "M"),  # a stray from April
    ]
    may = land(spark, tmp_path / "may", arrivals=arrivals)
    for _ in range(2):
        warehouse.run(spark, may, output, 2016, 5, only_dates=True)
        fact = read_table(spark, output, fixed.FACT_VISITS)
        new = fact.filter(fact.arrdate == datetime.date(2016, 5, 1))
        assert {r.cicid for r in new.collect()} == {100.0, 101.0}
        assert rows(fact.filter(fact.arrdate < datetime.date(2016, 5, 1))) == before
    staged = read_table(spark, output, fixed.STAGE_ARRIVALS)
    assert staged.count() == ROWS[fixed.STAGE_ARRIVALS] + 2
    assert read_table(spark, output, fixed.DIM_DATE).count() == 4




def test_many_ports_shuffle_no_arrivals(spark, tmp_path, monkeypatch):
    """Of more ports than Spark would broadcast, those that arrivals have are."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    monkeypatch.setattr(warehouse, "BROADCAST_ROWS", 7)  # of nine port lines, and five ports
    inputs, output = land(spark, tmp_path / "in"), str(tmp_path / "out")
    plans, write = {}, warehouse.Load.write

    def noted(load, df, name, *rest):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return write(load, df, name, *rest)

    monkeypatch.setattr(warehouse.Load, "write", noted)
    try:
        warehouse.run(spark, inputs, output, 2016, 4, state="ST")
        assert counts(spark, output) == ROWS
        assert "BroadcastHashJoin" in plans[fixed.STAGE_ARRIVALS] and "SortMergeJoin" not in plans[fixed.STAGE_ARRIVALS]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_second_delivery_lands_its_arrivals_alone(spark, tmp_path):
    first = land(spark, tmp_path / "in")
    arrivals = spark.read.parquet(first.arrivals)
    second = registry.delivered(first, arrivals.filter("arrdate <> 20547"))
    assert second.arrivals != first.arrivals and second.ports == first.ports and second.temperatures == first.temperatures
    assert spark.read.parquet(second.arrivals).count() == arrivals.filter("arrdate <> 20547").count()
