"""Boosted trees on merged rows and grids that share fits."""

import random
import threading
import time

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tarmac.operators import models


def _rows(spark, n=600):
    draw = random.Random(4)
    rows = [(draw.choice("abc"), float(draw.randrange(9)), float(draw.randrange(4))) for _ in range(n)]
    return spark.createDataFrame(
        [(k, x, z, 3 * x * x + 7.3 * z * (k == "a") + draw.gauss(0, 1)) for k, x, z in rows],
        "k string, x double, z double, y double")


def _vectors(df, *numbers):
    marked = df.withColumn("a", (F.col("k") == "a").cast("double"))
    return VectorAssembler(inputCols=[*numbers, "a"], outputCol="features").transform(marked)


def test_trees_of_merged_rows_are_those_of_all_rows(spark):
    rows = _rows(spark)
    merged, test = models.tree_rows(rows, rows, ["k"], ["x", "z"], "y", per_task=200)
    assert merged.count() == rows.select("k", "x", "z").distinct().count() < 600
    assert merged.rdd.getNumPartitions() == 1
    assert merged.agg(F.sum("weight")).first()[0] == 600
    assert test.exceptAll(rows).isEmpty()
    fits = [models.boosted_trees("y", depth=3, trees=12, seed=1, **more).fit(_vectors(df, "x", "z"))
            for df, more in ((rows, {}), (merged, {"weightCol": "weight"}))]
    wanted, found = ([r.prediction for r in fit.transform(_vectors(rows, "x", "z")).collect()] for fit in fits)
    assert found == pytest.approx(wanted, rel=1e-9)


def test_few_rows_stay_and_null_labels_become_nan(spark):
    rows = _rows(spark, 50)
    kept, _ = models.tree_rows(rows, rows, ["k"], ["x", "z"], "y")
    assert kept.drop("weight").exceptAll(rows).isEmpty() and kept.count() == 50
    gap = spark.createDataFrame([("a", 1.0, None), ("a", 1.0, 2.0), ("b", 1.0, 3.0)], "k string, x double, y double")
    merged = {r.k: r for r in models.merge_rows(gap, ["k", "x"], "y").collect()}
    assert merged["a"].y != merged["a"].y and merged["a"].weight == 2 and merged["b"].y == 3


def test_numbers_with_many_values_are_merged_by_bins(spark):
    draw = random.Random(5)
    values = [(draw.choice("ab"), draw.gauss(0, 1), draw.random()) for _ in range(3000)] + [("a", None, 0.5), ("b", float("nan"), 0.5)]
    rows = spark.createDataFrame([(k, x, z, (x or 0) + 2 * z) for k, x, z in values],
                                 "k string, x double, z double, y double")
    merged, test = models.tree_rows(rows, rows, ["k"], ["x", "z"], "y", most=2500, per_task=500)
    assert merged.count() <= 2 * 32 * 32 + 2
    assert merged.agg(F.sum("weight")).first()[0] == 3002
    assert test.filter(F.isnan("x")).count() == 1
    test, rows = test.filter(~F.isnan("x") | F.col("x").isNull()), rows.filter(~F.isnan("x") | F.col("x").isNull())
    binned = test.agg(F.count_distinct("x"), F.count_distinct("z"), F.count_if(F.col("x").isNull()),
                      F.avg("x")).first()
    assert (binned[0], binned[1], binned[2]) == (32, 32, 1)
    assert binned[3] == pytest.approx(rows.agg(F.avg("x")).first()[0])


def test_grid_fits_settings_that_differ_in_trees_once(spark, monkeypatch):
    rows = _vectors(_rows(spark, 200), "x", "z").withColumn("weight", F.lit(2.0))
    grid = [{"depth": d, "trees": t} for d in (1, 2) for t in (2, 4)]

    def build(**setting):
        return models.boosted_trees("y", seed=1, weightCol="weight", **setting)

    wanted = [models.rmse("y").evaluate(build(**s).fit(rows).transform(rows)) for s in grid]
    fits, fit = [], models.GBTRegressor._fit
    monkeypatch.setattr(
        models.GBTRegressor, "_fit", lambda self, df: fits.append(self.getMaxIter()) or fit(self, df))
    scores = models.grid_scores(rows, rows, grid, build, models.rmse("y"))
    found = {r.setting: r.metric for r in scores.collect()}
    assert [found[str(s)] for s in grid] == pytest.approx(wanted)
    assert fits == [4, 4]


def test_large_fits_run_one_after_the_other(spark):
    lock, now, most = threading.Lock(), [0], [0]

    def fit(i):
        with lock:
            now[0] += 1
            most[0] = max(most[0], now[0])
        time.sleep(0.05)
        with lock:
            now[0] -= 1
        return i

    assert models.fit_at_once(spark, fit, list(range(6)), models.ROWS_AT_ONCE + 1) == list(range(6))
    assert most == [1]
    models.fit_at_once(spark, fit, list(range(6)), 10)
    assert most[0] == models.FITS_AT_ONCE
