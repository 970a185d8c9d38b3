"""Loads: whole or not at all, wherever they are broken off."""

import datetime
from pathlib import Path

import pytest

from fixtures import ARRIVALS, TEMPERATURES, land, rows
from landfall import fixed
from landfall.plans import warehouse
from landfall.sources import Load, loads, read_table, settle

OLD = [(i, f"d{i % 3}") for i in range(9)]
NEW = [(i, f"d{i % 2 + 1}") for i in range(20, 26)]  # has d1 and d2, and no d3
SCHEMA = "x int, day string"


def start(spark, root):
    load = Load(spark, root)
    load.write(spark.createDataFrame(OLD, SCHEMA), "t", "day")
    load.write(spark.createDataFrame([(1,)], "y int"), "u")
    load.publish()


def again(spark, root):
    load = Load(spark, root)
    load.write(spark.createDataFrame(NEW, SCHEMA), "t", "day", lambda day: day != "d0")
    load.write(spark.createDataFrame([(2,)], "y int"), "u")
    return load


AFTER = sorted([r for r in OLD if r[1] == "d0"] + NEW)


def seen(spark, root):
    return rows(read_table(spark, root, "t", SCHEMA)), [r.y for r in read_table(spark, root, "u").collect()]


def test_a_load_takes_effect_at_once(spark, tmp_path):
    root = str(tmp_path / "w")
    start(spark, root)
    load = again(spark, root)
    assert seen(spark, root) == (sorted(OLD), [1])
    assert rows(load.whole("t")) == AFTER
    load.publish(settled=False)
    assert seen(spark, root) == (AFTER, [2])
    settle(spark, root)
    assert seen(spark, root) == (AFTER, [2])
    assert sorted(p.name for p in (tmp_path / "w").iterdir()) == ["t", "u"]


@pytest.mark.parametrize("steps", range(6))
def test_settling_may_be_broken_off_anywhere(spark, tmp_path, monkeypatch, steps):
    """After any number of its deletions and moves a reader sees the new state, and settling goes on from there."""
    root = str(tmp_path / "w")
    start(spark, root)
    again(spark, root).publish(settled=False)
    left = [steps]

    def limited(real):
        def call(*args):
            if not left[0]:
                raise KeyboardInterrupt
            left[0] -= 1
            return real(*args)

        return call

    with monkeypatch.context() as patch:
        patch.setattr(loads, "delete", limited(loads.delete))
        patch.setattr(loads, "move", limited(loads.move))
        with pytest.raises(KeyboardInterrupt):
            settle(spark, root)
    assert seen(spark, root) == (AFTER, [2])
    settle(spark, root)
    assert seen(spark, root) == (AFTER, [2])
    assert sorted(p.name for p in (tmp_path / "w").iterdir()) == ["t", "u"]


def test_what_a_dead_load_left_is_removed(spark, tmp_path):
    root = str(tmp_path / "w")
    start(spark, root)
    again(spark, root)
    settle(spark, root)
    assert seen(spark, root) == (sorted(OLD), [1])
    assert sorted(p.name for p in (tmp_path / "w").iterdir()) == ["t", "u"]


def test_partitions_that_vanish(spark, tmp_path):
    """A partition that is replaced by nothing is gone, also while the load is not in place."""
    root = str(tmp_path / "w")
    start(spark, root)
    load = Load(spark, root)
    load.write(spark.createDataFrame([], SCHEMA), "t", "day", lambda day: day in ("d1", "d2"))
    load.publish(settled=False)
    for _ in range(2):
        assert rows(read_table(spark, root, "t", SCHEMA)) == [r for r in sorted(OLD) if r[1] == "d0"]
        settle(spark, root)


def files(output, table):
    return {p: p.stat().st_mtime_ns for p in (Path(output) / table).rglob("*.parquet")}


MAY = [
    (100.0, 717.0, "ABC", 20575.0, 1.0, 20580.0, 1.0, "B1", "M"),
    (101.0, 717.0, "DEF", 20576.0, 1.0, 20581.0, 1.0, "B1", "M"),
]
DAYS = TEMPERATURES + "North,US,State of T,City,5,2,2016,98.0\n"


@pytest.fixture
def two_months(spark, tmp_path):
    """A warehouse of April and May."""
    output = str(tmp_path / "out")
    warehouse.run(spark, land(spark, tmp_path / "april"), output, 2016, 4)
    warehouse.run(spark, land(spark, tmp_path / "may", arrivals=MAY, temperatures=DAYS), output, 2016, 5, only_dates=True)
    return output


def test_keys_are_unique_across_months(spark, tmp_path, two_months):
    """A key of another month stops a load, and nothing of it is seen or left."""
    before = rows(read_table(spark, two_months, fixed.FACT_VISITS))
    assert len(before) == 6
    twice = [*MAY, (1.0, 717.0, "ABC", 20575.0, 1.0, 20580.0, 1.0, "B1", "M")]
    inputs = land(spark, tmp_path / "twice", arrivals=twice, temperatures=DAYS)
    with pytest.raises(ValueError, match=r"unique_across_months on fact_i94_visits\(cicid\): 1 violations in 3"):
        warehouse.run(spark, inputs, two_months, 2016, 5, only_dates=True)
    assert rows(read_table(spark, two_months, fixed.FACT_VISITS)) == before
    assert not (Path(two_months) / "loads").exists()
    allowed = warehouse.ALLOWED | {("unique_across_months", fixed.FACT_VISITS)}
    done = warehouse.run(spark, inputs, two_months, 2016, 5, only_dates=True, allowed=allowed)
    assert [r.violations for r in done.checks if r.check_name == "unique_across_months"] == [1]


def test_months_without_suspects_are_not_read(spark, tmp_path, two_months):
    """April's files may be unreadable as long as May has none of its keys; a summary that is missing is made anew."""
    for file in files(two_months, f"{fixed.FACT_VISITS}/arrdate=2016-04-01"):
        file.write_bytes(b"no parquet")
        file.with_name(f".{file.name}.crc").unlink(missing_ok=True)
    inputs = land(spark, tmp_path / "again", arrivals=MAY, temperatures=DAYS)
    done = warehouse.run(spark, inputs, two_months, 2016, 5, only_dates=True)
    assert [(r.passed, r.rows_checked) for r in done.checks if r.check_name == "unique_across_months"] == [(True, 2)]
    for file in files(two_months, f"{fixed.KEY_SUMMARIES}/month=2016-04"):
        file.unlink()
    (Path(two_months) / fixed.KEY_SUMMARIES / "month=2016-04").rename(tmp_path / "away")
    warehouse.run(spark, inputs, two_months, 2016, 5, only_dates=True)


def test_rankings_come_from_totals(spark, tmp_path, two_months):
    """They are those of the whole fact, also where totals of earlier dates have to be made up for."""
    (Path(two_months) / fixed.PORT_TOTALS / "arrdate=2016-04-01").rename(tmp_path / "away")
    inputs = land(spark, tmp_path / "again", arrivals=MAY, temperatures=DAYS)
    done = warehouse.run(spark, inputs, two_months, 2016, 5, state="ST", only_dates=True)
    assert [tuple(r) for r in done.top_states.collect()] == [("STATE OF T", 65.75, 5), ("ALABAMA", 70.5, 1)]
    assert [tuple(r) for r in done.top_cities.collect()] == [("CITY", 74.69, 4), ("INL FALLS", 30.0, 1)]


LATE = [
    (1.0, 582.0, "DEF", 20575.0, 9.0, 20590.0, 2.0, "B2", "M", 2),  # moves from April 1 to May 1
    (1.0, 582.0, "ABC", 20547.0, 8.0, 20590.0, 2.0, "B2", "M", 1),  # an earlier correction
    (101.0, 717.0, "DEF", 20576.0, 7.0, 20581.0, 1.0, "B1", "M", 1),  # same day, another mode
    (200.0, 717.0, "ABC", 20545.0, 1.0, 20549.0, 1.0, "B1", "M", 1),  # new
    (2.0, 717.0, "DEF", 20546.0, 1.0, None, 1.0, "B1", "M", 1),  # unfit: replaces nothing
]


def test_late_arrivals(spark, tmp_path, two_months):
    inputs = land(spark, tmp_path / "late", temperatures=DAYS)
    from fixtures import ARRIVAL_SCHEMA

    path = str(tmp_path / "late-arrivals")
    spark.createDataFrame(LATE, f"{ARRIVAL_SCHEMA}, delivered int").write.parquet(path)
    inputs = warehouse.Inputs(**{**vars(inputs), "arrivals": path})
    before = {**files(two_months, fixed.FACT_VISITS), **files(two_months, fixed.STAGE_ARRIVALS)}
    done = warehouse.amend(spark, inputs, two_months, state="ST", order="delivered")
    fact = read_table(spark, two_months, fixed.FACT_VISITS)
    got = {r.cicid: (r.arrdate, r.i94mode, r.i94port) for r in fact.collect()}
    may = datetime.date(2016, 5, 1)
    assert got[1.0] == (may, 9, "DEF") and got[101.0] == (datetime.date(2016, 5, 2), 7, "DEF")
    assert got[200.0][0] == datetime.date(2016, 4, 1) and got[2.0][1] == 2
    assert len(got) == fact.count() == 7
    staged = read_table(spark, two_months, fixed.STAGE_ARRIVALS)
    assert staged.filter("cicid = 1").count() == 1 and staged.count() == 11
    # Dates that neither lose nor gain a row keep their files.
    after = {**files(two_months, fixed.FACT_VISITS), **files(two_months, fixed.STAGE_ARRIVALS)}
    untouched = [p for p in before if p.parent.name in ("arrdate=2016-04-02", "arrdate=2016-04-03", "arrdate=20546.5", "arrdate=20547.0", "arrdate=20700.0")]
    assert len(untouched) == 5 and all(after.get(p) == before[p] for p in untouched)
    assert {r["count"] for r in done.top_states.collect()} == {6, 1}
    # The keys that came late are known to later loads.
    again = land(spark, tmp_path / "again", arrivals=[*MAY, (200.0, 717.0, "ABC", 20575.0, 1.0, 20580.0, 1.0, "B1", "M")], temperatures=DAYS)
    with pytest.raises(ValueError, match="unique_across_months"):
        warehouse.run(spark, again, two_months, 2016, 5, only_dates=True)


def test_quarantine(spark, tmp_path):
    """Lines by reason, each file being read once; a month's are replaced with it."""
    inputs, output = land(spark, tmp_path / "in"), str(tmp_path / "out")
    path = tmp_path / "arrivals.csv"
    path.write_text(
        "cicid,i94cit,i94port,arrdate,i94mode,depdate,i94visa,visatype,matflag\n"
        "1,717,ABC,20545,1,2055O,1,B1,M\n2,717,ABC,20700,1,20750,1,B1,M\n3,717,ABC,20545,1,20550,1,B1,M\n4,717,ABC,,1,20550,1,B1,M\n"
    )
    inputs = warehouse.Inputs(**{**vars(inputs), "arrivals": str(path), "arrivals_format": "csv"})
    allowed = warehouse.ALLOWED | {("well_formed", "arrivals")}
    for _ in range(2):
        warehouse.run(spark, inputs, output, 2016, 4, only_dates=True, allowed=allowed)
        apart = rows(read_table(spark, output, fixed.QUARANTINED).select("source", "reason", "line", "month"))
        assert apart == [
            ("arrivals", "date_present", "4.0,717.0,ABC,,1.0,20550.0,1.0,B1,M", "2016-04"),
            ("arrivals", "in_period", "2.0,717.0,ABC,20700.0,1.0,20750.0,1.0,B1,M", "2016-04"),
            ("arrivals", "well_formed", "1,717,ABC,20545,1,2055O,1,B1,M", "2016-04"),
        ]


def test_each_file_is_read_once(spark, tmp_path, monkeypatch):
    """The plan that writes a CSV source has one scan, and nothing else is run on it."""
    scans = []
    real = Load.scratch

    def scratch(self, df, name, key=None):
        if name in ("arrivals", "temperatures"):
            scans.append((name, df._jdf.queryExecution().optimizedPlan().toString().count("Relation [")))
        return real(self, df, name, key)

    monkeypatch.setattr(Load, "scratch", scratch)
    inputs = land(spark, tmp_path / "in")
    path = str(tmp_path / "csv")
    spark.read.parquet(inputs.arrivals).write.option("header", True).csv(path)
    load = Load(spark, str(tmp_path / "out"))
    inputs = warehouse.Inputs(**{**vars(inputs), "arrivals": path, "arrivals_format": "csv"})
    staged, _, _ = warehouse.stage(load, inputs, 2016, 4)
    assert scans == [("arrivals", 1), ("temperatures", 1)]
    assert path not in " ".join(staged.inputFiles())
    load.abandon()
    assert not (tmp_path / "out").exists()
