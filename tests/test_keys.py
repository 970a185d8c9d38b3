"""Summaries of keys, corrections and totals."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from fixtures import rows
from landfall.operators import cells_for, latest, merged, met_cells, port_totals, rank_totals, replaced, summarise_keys, suspects, visits_by


def test_cells():
    assert [cells_for(n) for n in (0, 1, 2048, 2049, 5000)] == [32768, 32768, 32768, 65536, 131072]


def keyed(spark, months):
    return spark.createDataFrame([(float(k), m) for m, ks in months.items() for k in ks], "k double, month string")


@pytest.mark.parametrize("own, theirs", [(32768, 32768), (1 << 18, 32768), (32768, 1 << 18), (1 << 17, 1 << 16)])
def test_suspects_miss_no_key(spark, own, theirs):
    """Every key that a month has is a suspect there, and few others are."""
    random.seed(own + theirs)
    old = {"2016-01": random.sample(range(10**9), 900), "2016-02": random.sample(range(10**9), 900), "2016-03": range(-500, -1)}
    new = [*old["2016-01"][:30], *old["2016-02"][:20], *random.sample(range(10**9, 2 * 10**9), 300), 0]
    rows_new = keyed(spark, {"new": new})
    mine = summarise_keys(rows_new, "k", own)
    met = met_cells(mine, summarise_keys(keyed(spark, old), "k", theirs), own, [theirs])
    cells = {r.cells for r in met.select("cells").distinct().collect()}
    assert cells == {min(own, theirs)}
    found = {(r.month, r.k) for r in suspects(rows_new, "k", met, cells).collect()}
    shared = {(m, float(k)) for m in ("2016-01", "2016-02") for k in old[m] if k in new}
    assert shared <= found
    assert len(found - shared) < 2 * 350 * 2 * 900 / min(own, theirs) + 20
    assert all(m != "2016-03" for m, _ in found)  # beside the range


def test_summaries_merge(spark):
    one = summarise_keys(keyed(spark, {"a": range(100), "b": range(5)}), "k", 1 << 17)
    two = summarise_keys(keyed(spark, {"a": range(90, 200), "c": [1]}), "k", 1 << 16)
    whole = summarise_keys(keyed(spark, {"a": range(200)}), "k", 1 << 16)
    got = merged(one, two)
    assert {(r.month, r.cells) for r in got.select("month", "cells").distinct().collect()} == {("a", 1 << 16), ("b", 1 << 17), ("c", 1 << 16)}
    columns = ["month", "cells", "bucket", "bits"]
    assert rows(got.filter("month = 'a'").select(*columns)) == rows(whole.select(*columns))


def test_null_keys_are_left_out(spark):
    df = spark.createDataFrame([(None, "a"), (1.0, "a")], "k double, month string")
    assert summarise_keys(df, "k", 32768).agg(F.sum(F.bitmap_count("bits"))).first()[0] == 1


def test_latest(spark):
    data = [(1, 5, "a"), (1, 7, "b"), (1, 7, "c"), (2, None, "d"), (None, 1, "e"), (None, 1, "e"), (3, 1, None), (3, None, "z")]
    df = spark.createDataFrame(data, "k int, v int, x string")
    assert rows(latest(df, "k", "v")) == [(None, 1, "e"), (None, 1, "e"), (1, 7, "c"), (2, None, "d"), (3, 1, None)]
    assert rows(latest(df, "k").filter("k = 1")) == [(1, 7, "c")]
    assert latest(df.limit(0), "k", "v").count() == 0


def test_replaced(spark):
    old = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "k int, x string")
    late = spark.createDataFrame([("B", 1), ("N", 9)], "x string, k int")
    assert rows(replaced(old, late, "k")) == [(None, "d"), (1, "B"), (2, "c"), (9, "N")]


def test_totals_do_not_depend_on_order(spark):
    """Sums of doubles differ in their last digits by the order of rows; totals do not, and they add up."""
    values = [0.1, 1e15, -1e15, 0.2, 0.3, float("nan"), None] * 20
    data = [("A", v, i % 3) for i, v in enumerate(values)]
    schema = "i94port string, avgtemperature double, day int"
    ports = spark.createDataFrame([("A", "CITY", "ST", "STATE")], "code string, city string, state string, state_name string")
    found = []
    for _ in range(3):
        random.shuffle(data)
        df = spark.createDataFrame(data, schema).repartition(5)
        total = port_totals(df).first()
        assert total.total == Decimal("12.0000000000") and (total.measured, total.visits) == (100, 140)
        found += [rows(visits_by(df, ports)), rows(rank_totals(port_totals(df, "day"), ports))]
    assert all(f == [("STATE", 0.12, 140)] for f in found)
