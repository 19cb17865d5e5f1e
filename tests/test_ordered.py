"""Global order operators against plain Python, with hot groups and exact copies."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from deskmill.operators.ordered import previous_row, row_number, running_total, slice_in_order
from deskmill.operators.profile import exact_percentiles


@pytest.fixture(autouse=True, scope="module")
def many_slices(spark):
    """Small data would otherwise be joined into a single slice at run time."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    yield
    spark.conf.unset(name)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    hot = [("hot", rng.randrange(40), i) for i in range(400)]
    cold = [(f"g{rng.randrange(30)}", rng.randrange(40), i) for i in range(400, 700)]
    copies = [("copies", 7, 7)] * 300
    out = hot + cold + copies + [(None, None, 1), (None, 3, 2)]
    rng.shuffle(out)
    return out


@pytest.fixture(scope="module")
def frame(spark, rows):
    return spark.createDataFrame(rows, "g string, v int, id int").repartition(6)


def key(row):
    return (row[0] is not None, row[0] or "", row[1] is not None, row[1] or 0, row[2])


def test_running_total(frame, rows):
    got = running_total(frame, ["g"], ["v", "id"], F.coalesce("v", F.lit(0)), "sum").collect()
    want, totals = [], {}
    for g, v, i in sorted(rows, key=key):
        totals[g] = totals.get(g, 0) + (v or 0)
        want.append((g, v, i, totals[g]))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_row_number_without_groups(frame, rows):
    got = [tuple(r) for r in row_number(frame, [], ["g", "v", "id"], "n").collect()]
    assert sorted(n for *_, n in got) == list(range(1, len(rows) + 1))
    assert [r[:3] for r in sorted(got, key=lambda r: r[3])] == sorted(rows, key=key)


def test_previous_row(frame, rows):
    got = previous_row(frame, ["g"], ["v", "id"], {"pv": "v", "pid": "id"}).collect()
    want, last = [], {}
    for g, v, i in sorted(rows, key=key):
        want.append((g, v, i, *last.get(g, (None, None))))
        last[g] = (v, i)
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_copies_and_hot_groups_are_spread(frame):
    laid = slice_in_order(frame, ["g"], ["v", "id"])
    sizes = {r.g: r.n for r in laid.groupBy("g").agg(F.count_distinct("_slice").alias("n")).collect()}
    assert sizes["hot"] > 1 and sizes["copies"] > 1


def test_exact_percentiles(spark):
    values = [1, 1, 2, 3, 5, 8, 13, 21, 34, 55, None]
    df = spark.createDataFrame([(v,) for v in values], "x int")
    row = exact_percentiles(df, "x", {"p50": 0.5, "p90": 0.9, "p100": 1.0}).first()
    assert tuple(row) == (10, 6.5, 36.1, 55.0)


def test_exact_percentiles_of_nothing(spark):
    row = exact_percentiles(spark.createDataFrame([], "x int"), "x", {"p50": 0.5}).first()
    assert tuple(row) == (0, None)
