"""The plans for large tables, forced by small budgets, against plain Python."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarmac.operators.ordered import (
    exact_percentiles, first_per_key, moving_average, number_rows, previous_values,
)


def _hot_rows(n=2000, seed=1):
    """A third of the rows share one key; another key is null; many orders are tied."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if rng.random() < 0.34 else rng.choice(["a", "b", None, "c", "d"])
        value = None if rng.random() < 0.1 else float(rng.randrange(100))
        rows.append((i, key, rng.randrange(20), value))
    return rows


SCHEMA = "id long, k string, o int, v double"


@pytest.fixture(scope="module")
def hot(spark):
    return spark.createDataFrame(_hot_rows(), SCHEMA).repartition(5)


def test_row_numbers_follow_the_order(hot):
    got = number_rows(hot, ["o", "id"]).orderBy("row_num").collect()
    want = sorted(_hot_rows(), key=lambda r: (r[2], r[0]))
    assert [r.id for r in got] == [r[0] for r in want]
    assert [r.row_num for r in got] == list(range(1, len(want) + 1))


def test_row_numbers_do_not_depend_on_partitions(spark, hot):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    results = []
    for n in ("1", "8"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        results.append({(r.id, r.row_num) for r in number_rows(hot, ["o", "id"]).collect()})
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert results[0] == results[1]


def _expected_previous(rows):
    last, want = {}, {}
    for row in sorted(rows, key=lambda r: (r[2], r[0])):
        want[row[0]] = last.get(row[1], (None, None))
        last[row[1]] = (row[0], row[3])
    return want


@pytest.mark.parametrize("budget", [1, 7, 300, 10**6])
def test_previous_values_for_any_budget(hot, budget):
    got = previous_values(hot, ["k"], ["o", "id"], {"pid": "id", "pv": "v"}, budget)
    assert got.columns == ["id", "k", "o", "v", "pid", "pv"]
    rows = got.collect()
    assert len(rows) == 2000
    assert {r.id: (r.pid, r.pv) for r in rows} == _expected_previous(_hot_rows())


@pytest.mark.parametrize("budget", [10, 64, 10**6])
@pytest.mark.parametrize("rows", [1, 2, 10])
def test_moving_average_for_any_budget(hot, budget, rows):
    got = moving_average(hot.na.fill(0.0), ["o", "id"], "v", rows, rows_per_task=budget)
    by_order = [r.moving_avg for r in got.orderBy("o", "id").collect()]
    values = [r[3] or 0.0 for r in sorted(_hot_rows(), key=lambda r: (r[2], r[0]))]
    for i, average in enumerate(by_order):
        if i + 1 < rows:
            assert average is None
        else:
            assert average == pytest.approx(sum(values[i + 1 - rows:i + 1]) / rows)


@pytest.mark.parametrize("budget", [5, 10**6])
@pytest.mark.parametrize("rows", [3, 700])
def test_moving_average_does_not_cancel(spark, budget, rows):
    rng = random.Random(9)
    values = [1e15 * rng.random() if i % 400 == 0 else rng.gauss(0, 1e-3) for i in range(1500)]
    values[900], values[1200], values[5] = None, float("nan"), float("inf")
    df = spark.createDataFrame(list(enumerate(values)), "id long, v double").repartition(6)
    got = {r.id: r.moving_avg for r in moving_average(df, ["id"], "v", rows, rows_per_task=budget).collect()}
    for i in range(1500):
        frame = values[max(i + 1 - rows, 0):i + 1]
        if len(frame) < rows or None in frame:
            assert got[i] is None
        elif not all(map(math.isfinite, frame)):
            assert math.isnan(got[i])
        else:
            assert got[i] == pytest.approx(math.fsum(frame) / rows, rel=1e-12, abs=1e-12)


@pytest.mark.parametrize("budget", [0, 10**6])
def test_percentiles_per_group_for_any_budget(hot, budget):
    wanted = {"lo": 0.0, "p25": 0.25, "p95": 0.95, "hi": 1.0}
    got = exact_percentiles(
        hot, "v", wanted, ["k"], also=[F.count("v").alias("n")], distinct_per_task=budget)
    assert got.columns == ["k", "n", *wanted]
    for row in got.collect():
        values = [r[3] for r in _hot_rows() if r[1] == row.k and r[3] is not None]
        assert row.n == len(values)
        for name, p in wanted.items():
            assert row[name] == pytest.approx(np.quantile(values, p))


@pytest.mark.parametrize("budget", [0, 10**6])
def test_percentile_of_a_thousand(spark, budget):
    df = spark.range(1000).select(F.col("id").cast("double").alias("v"))
    got = exact_percentiles(df, "v", {"p": 0.95}, distinct_per_task=budget).first()
    assert got.p == pytest.approx(949.05)


def test_first_per_key_breaks_ties_by_order(hot):
    got = {r.k: r.id for r in first_per_key(hot, ["k"], ["o", "id"]).collect()}
    want = {}
    for row in sorted(_hot_rows(), key=lambda r: (r[2], r[0])):
        want.setdefault(row[1], row[0])
    assert got == want


def test_first_per_key_of_whole_rows(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "x int, y string")
    assert first_per_key(df, ["x", "y"], []).count() == 2


def test_first_per_key_carries_a_column_once(spark):
    rows = [("a", 2, 1, "x"), ("a", 1, 5, "z"), ("a", 1, 5, "y"), ("b", None, 0, "n"), ("b", 0, 0, "m"), (None, 1, 1, "q")]
    df = spark.createDataFrame(rows, "k string, o int, id int, t string")
    first = first_per_key(df, ["k"], ["o", "k", "id"])
    assert sorted(map(tuple, first.collect()), key=str) == sorted(
        [("a", 1, 5, "y"), ("b", None, 0, "n"), (None, 1, 1, "q")], key=str)
    plan = first._jdf.queryExecution().optimizedPlan().toString()
    carried = plan[plan.index("min(struct("):].split("))")[0]
    assert carried.count("id,") == 1 and "min_by" not in plan
    maps = df.selectExpr("k", "o", "id", "t", "array(map(t, id)) AS m")
    assert {r.k: (r.o, r.id) for r in first_per_key(maps, ["k"], ["o", "id"]).collect()} == {
        "a": (1, 5), "b": (None, 0), None: (1, 1)}
    assert first_per_key(maps, ["k"], ["k"]).count() == 3


def test_empty_tables_stay_empty(hot):
    empty = hot.filter("false")
    assert number_rows(empty, ["id"]).count() == 0
    assert previous_values(empty, ["k"], ["o", "id"], {"p": "v"}).count() == 0
    assert moving_average(empty, ["id"], "v", 3).count() == 0
    assert exact_percentiles(empty, "v", {"p": 0.5}, ["k"]).count() == 0
    assert exact_percentiles(empty, "v", {"p": 0.5}).first().p is None
