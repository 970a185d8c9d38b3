"""The shape of the plans: what is pushed down, what is shuffled, what is broadcast."""

import contextlib
import io
import re
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from fixtures import land
from landfall import fixed
from landfall.functions import outside_period
from landfall.operators import (
    build_visits,
    date_dim,
    keep_listed,
    keep_present,
    stage_arrivals,
    visits_by,
)
from landfall.plans import warehouse
from landfall.sources import read_table, write_by_date

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


def nodes(df) -> Counter:
    """Operators of the plan by name, from the tree at its head."""
    tree = plan(df).split("\n\n")[0]
    return Counter(re.findall(r"([A-Z]\w+)[^\n]*?\(\d+\)", tree))


@contextlib.contextmanager
def conf(spark, **values):
    names = {k.replace("_", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture(scope="module")
def output(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("plans")
    warehouse.run(spark, land(spark, folder / "in"), str(folder / "out"), 2016, 4)
    return str(folder / "out")


@pytest.fixture(scope="module")
def tables(spark, output):
    names = [fixed.STAGE_ARRIVALS, fixed.DIM_PORTS, fixed.STAGE_TEMPERATURES, fixed.FACT_VISITS]
    return [read_table(spark, output, n) for n in names]


@pytest.mark.parametrize("name", [n for n in contract.queries() if n != "warehouse_run"])
def test_no_python_and_no_cross_join(spark, name):
    text = plan(contract.queries()[name](spark, SF))
    assert "EvalPython" not in text and "InPandas" not in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_null_filters_reach_the_scan(spark, tables):
    arrivals = tables[0]
    text = plan(keep_present(arrivals, ["depdate", "i94mode", "matflag"]))
    pushed = re.search(r"PushedFilters: \[(.*)\]", text).group(1)
    for name in ("depdate", "i94mode", "matflag"):
        assert f"IsNotNull({name})" in pushed


def test_short_list_is_pushed(tables):
    assert "In(i94port, [ABC,DEF])" in plan(keep_listed(tables[0], "i94port", ["ABC", "DEF"]))


def test_staging_filters_before_its_only_shuffle(tables):
    arrivals, ports = tables[:2]
    staged = stage_arrivals(arrivals, ports.select("code"))
    found = nodes(staged)
    assert found["Exchange"] == 1 and found["HashAggregate"] == 2
    tree = plan(staged).split("\n\n")[0]
    assert tree.index("Exchange (") < tree.index("BroadcastHashJoin")


def test_fact_needs_no_shuffle_while_the_dimensions_are_small(spark, tables):
    visits = build_visits(*tables[:3])
    assert nodes(visits)["BroadcastHashJoin"] == 2
    assert nodes(visits)["Exchange"] == 0
    with conf(spark, spark_sql_autoBroadcastJoinThreshold="-1"):
        large = nodes(build_visits(*tables[:3]))
    assert large["SortMergeJoin"] == 2 and large["BroadcastExchange"] == 0


def test_ranking_is_reduced_by_port_before_its_join(tables):
    ports, visits = tables[1], tables[3]
    ranked = visits_by(visits, ports)
    text = plan(ranked)
    assert "TakeOrderedAndProject" in text
    assert "ReadSchema: struct<i94port:string,avgtemperature:double>" in text
    tree = text.split("\n\n")[0]
    assert tree.index("BroadcastHashJoin") < tree.rindex("Exchange (")
    assert nodes(ranked)["HashAggregate"] == 4


def test_period_prunes_partitions(tables):
    text = plan(tables[3].filter(outside_period("arrdate", 2016, 4)))
    assert re.search(r"PartitionFilters: \[.*year\(arrdate", text)


def test_dates_are_read_from_the_partitions_alone(tables):
    assert "ReadSchema: struct<>" in plan(date_dim(tables[3]))


def files_per_date(folder: Path) -> dict[str, int]:
    return {d.name: len(list(d.glob("*.parquet"))) for d in sorted(folder.glob("day=*"))}


def test_large_dates_are_split_and_small_ones_gathered(spark, tmp_path):
    """One date holds a third of the rows and must not be written by one task."""
    n = 600_000
    day = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 20)
    df = spark.range(0, n, 1, 16).select("id", F.rand(1).alias("x"), day.alias("day"))
    settings = {
        "spark_sql_adaptive_advisoryPartitionSizeInBytes": "512k",
        "spark_sql_shuffle_partitions": "400",
    }
    with conf(spark, **settings):
        write_by_date(df, str(tmp_path), "t", key="day")
    files = files_per_date(tmp_path / "t")
    assert len(files) == 20
    assert files["day=0"] > 1
    # A date may share the fate of the large one where both hash to one partition.
    assert sum(count == 1 for count in files.values()) >= 17
    assert spark.read.parquet(str(tmp_path / "t")).count() == n


def test_broadcast_fact_keeps_the_files_of_its_stage(spark, output):
    folder = Path(output) / fixed.FACT_VISITS
    assert {len(list(d.glob("*.parquet"))) for d in folder.glob("arrdate=*")} == {1}
