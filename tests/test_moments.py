"""Moments in one pass: against numpy, and folds against pyspark.ml fitted on each of them."""

import random

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tarmac.operators import models, moments, profile
from tarmac.operators.ordered import number_rows
from tarmac.operators.splits import fold_bounds, fold_rows
from tarmac.plans import learning


def _rows(n=400, seed=4):
    draw = random.Random(seed)
    out = []
    for i in range(n):
        x = [1e3 + draw.gauss(0, 2), draw.gauss(0, 1), draw.choice([0.0, 1.0])]
        out.append((i, draw.randrange(30), *x, 3 * x[1] - x[2] + 0.5 * (x[0] - 1e3) + draw.gauss(0, 0.3)))
    return out


@pytest.fixture(scope="module")
def lines(spark):
    return spark.createDataFrame(_rows(), "id long, t int, a double, b double, c double, y double").repartition(5)


def test_moments_equal_numpy_however_rows_are_cut(spark, lines):
    got = dict(moments.moments_by(lines, F.col("id") % 3, [moments.numbers("a", "b", "y")], 3).collect())
    data = np.array([(r[2], r[3], r[5]) for r in _rows()])
    for g, m in got.items():
        part = data[np.arange(len(data)) % 3 == g]
        assert m.n == len(part)
        assert np.allclose(m.mean, part.mean(0), rtol=1e-12)
        assert np.allclose(m.products, (part - part.mean(0)).T @ (part - part.mean(0)), rtol=1e-8, atol=1e-6)


@pytest.mark.parametrize("scheme, strength, share", [
    ("rolling", 0.0, 0.0), ("blocked", 0.1, 0.0), ("blocked_full", 0.05, 1.0), ("rolling", 0.1, 0.5)])
def test_folds_equal_a_fit_on_each_fold(spark, lines, scheme, strength, share):
    got = moments.linear_folds(lines, ["t", "id"], "y", ["a", "b", "c"], folds=3, scheme=scheme,
                               strength=strength, l1_share=share).orderBy("fold").collect()
    assembled = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(
        number_rows(lines, ["t", "id"]))
    assert len(got) == 3 and sum(r.best for r in got) == 1
    assert min(got, key=lambda r: r.rmse).best
    for row, fold in zip(got, fold_bounds(400, 3, scheme)):
        train, valid = fold_rows(assembled, fold)
        model = models.linear("y", regParam=strength, elasticNetParam=share, tol=1e-10, maxIter=500).fit(train)
        assert (row.n_train, row.n_valid) == (train.count(), valid.count())
        assert row.coefficients == pytest.approx(list(model.coefficients), rel=2e-4, abs=2e-5)
        assert row.rmse == pytest.approx(models.rmse("y").evaluate(model.transform(valid)), rel=1e-5)


def test_vectors_nulls_and_dependent_columns(spark, lines):
    odd = lines.withColumns({"twice": F.col("b") * 2, "still": F.lit(0.1),
                             "b": F.when(F.col("id") % 7 != 0, F.col("b"))})
    vector = VectorAssembler(inputCols=["twice", "still"], outputCol="v").transform(odd)
    rows = moments.linear_folds(vector, ["t", "id"], "y", ["a", "b", "c"], {"v": 2}, folds=2).collect()
    data = [r for r in sorted(_rows(), key=lambda r: (r[1], r[0]))]
    for row, fold in zip(sorted(rows), fold_bounds(400, 2)):
        train = [r for r in data[:fold.train_last] if r[0] % 7]
        valid = [r for r in data[fold.valid_first - 1:fold.valid_last] if r[0] % 7]
        x, z = (np.array([(r[2] - 1e3, r[3], r[4], 1) for r in part]) for part in (train, valid))
        w = np.linalg.lstsq(x, np.array([r[5] for r in train]), rcond=None)[0]
        rmse = np.sqrt(np.mean((z @ w - [r[5] for r in valid]) ** 2))
        assert (row.n_train, row.n_valid) == (len(train), len(valid))
        assert row.rmse == pytest.approx(rmse, rel=1e-6) and row.coefficients[4] == 0


def test_grid_over_hashed_folds(spark, lines):
    settings = [(0.0, 0.0), (0.5, 0.0), (0.01, 1.0)]
    got = moments.linear_grid(lines, F.col("id") % 4, "y", ["b", "c"], settings, folds=4).collect()
    assert len(got) == 12
    assembled = VectorAssembler(inputCols=["b", "c"], outputCol="features").transform(lines)
    for row in got:
        train, valid = assembled.filter(F.col("id") % 4 != row.fold), assembled.filter(F.col("id") % 4 == row.fold)
        model = models.linear("y", regParam=row.strength, elasticNetParam=row.l1_share, tol=1e-10,
                              maxIter=500).fit(train)
        assert row.rmse == pytest.approx(models.rmse("y").evaluate(model.transform(valid)), rel=1e-4)


def test_the_absolute_penalty_meets_its_conditions():
    draw = np.random.default_rng(1)
    x = draw.standard_normal((500, 6)) * [1, 5, 0.1, 2, 1, 1]
    y = x @ [2, 0, 0, -1, 0.3, 0] + draw.standard_normal(500)
    m = moments.moments_of(np.column_stack([x, y]))
    w, intercept = moments.solve(m, 0.4, 1.0)
    pull = (x - x.mean(0)).T @ (y - x @ w - intercept) / 500 / x.std(0)
    assert np.allclose(pull[w != 0], 0.4 * np.sign(w[w != 0]), atol=1e-8)
    assert (np.abs(pull[w == 0]) <= 0.4 + 1e-8).all() and 0 < (w == 0).sum() < 6


def test_folds_scan_their_rows_once(spark, monkeypatch):
    """The numbered rows are read by one job, with only the columns that folds need."""
    seen = []
    real = moments.moments_by
    monkeypatch.setattr(moments, "moments_by", lambda df, *rest: seen.append(df) or real(df, *rest))
    learning.linear_cv(spark, "/root/testdata/sf0.001").collect()
    assert len(seen) == 1
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "l_tax" not in plan and "l_returnflag" not in plan


@pytest.mark.parametrize("block", [2, 3, 64])
def test_correlations_of_columns_with_nulls(spark, block):
    draw = random.Random(2)
    names = [f"x{i}" for i in range(6)]
    rows = []
    for i in range(300):
        base = draw.gauss(0, 1)
        row = [1e7 + base, base + draw.gauss(0, 1), draw.gauss(0, 1e-3), 0.1, float(i % 2), None]
        rows.append((i, *[None if draw.random() < 0.2 else x for x in row]))
    df = spark.createDataFrame(rows, "id long, " + ", ".join(f"{n} double" for n in names)).repartition(4)
    got = {(r.a, r.b): (r.n, r.correlation) for r in moments.correlations(df, names, block).collect()}
    assert len(got) == 15
    for i, a in enumerate(names):
        for j, b in enumerate(names[i + 1:], i + 1):
            both = np.array([(r[i + 1], r[j + 1]) for r in rows if r[i + 1] is not None and r[j + 1] is not None])
            n, value = got[a, b]
            assert n == len(both)
            if {i, j} & {3, 5}:
                assert value is None
            else:
                assert value == pytest.approx(np.corrcoef(both.T)[0, 1], abs=1e-8)


def test_correlations_of_very_many_columns_from_one_scan(spark, tmp_path):
    width = 214
    wide = spark.range(600).select(*[
        F.sin(F.col("id") * (i + 1)).alias(f"x{i}") for i in range(width)])
    wide.write.parquet(str(tmp_path / "wide"))
    stored = spark.read.parquet(str(tmp_path / "wide"))
    table = profile.correlation_table(stored, stored.columns)
    got = {(r.a, r.b): r.correlation for r in table.collect()}
    data = np.sin(np.arange(600)[:, None] * np.arange(1, width + 1))
    want = np.corrcoef(data.T)
    assert len(got) == width * (width - 1) // 2 == 22_791
    assert all(value == pytest.approx(want[int(a[1:]), int(b[1:])], abs=1e-9) for (a, b), value in got.items())


def test_no_rows(spark, lines):
    assert moments.linear_folds(lines.limit(0), ["t", "id"], "y", ["a"]).count() == 0
    assert moments.correlations(lines.limit(0), ["a", "b"]).count() in (0, 1)
