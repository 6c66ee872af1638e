"""Counts, means and co-moments of many columns in one pass, and what follows from them.

Every task reduces its rows to one small matrix per group, and matrices merge exactly like their
rows would (pairwise update of means and centred products, so nothing cancels). From the moments of
disjoint slices any union of slices can be fitted and scored by least squares without another scan.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
from pyspark import RDD
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.operators.joins import attach_scalars
from tarmac.operators.ordered import number_rows_and_count
from tarmac.operators.splits import fold_bounds
from tarmac.session import cut

SWEEPS, SETTLED = 10_000, 1e-12  # of coordinate descent: most rounds, and the change that ends it
BLOCK = 64  # columns of a block of the table of pairs
ROUNDED = 1e-13  # share of a number that may be rounding alone


class Moments(NamedTuple):
    """Of complete rows: how many, the mean of each column, and the sums of centred products."""

    n: int
    mean: np.ndarray
    products: np.ndarray


def moments_of(rows: np.ndarray) -> Moments:
    mean = rows.mean(axis=0)
    centred = rows - mean
    return Moments(len(rows), mean, centred.T @ centred)


def merge(a: Moments, b: Moments) -> Moments:
    n = a.n + b.n
    apart = b.mean - a.mean
    return Moments(n, a.mean + apart * (b.n / n),
                   a.products + b.products + np.outer(apart, apart) * (a.n * b.n / n))


def _merge_sides(a: tuple, b: tuple) -> tuple:
    """Of (train, valid) pairs, either of them None where there are no rows yet."""
    return tuple(y if x is None else x if y is None else merge(x, y) for x, y in zip(a, b))


def _matrix(column, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def moments_by(df: DataFrame, group: Column, columns: list[Column], width: int) -> RDD:
    """``(group, Moments)`` of the rows in which no column is null, from a single scan.

    ``columns`` are numbers or arrays of numbers, ``width`` numbers in all. A task holds one matrix
    of ``width`` squared per group that it meets.
    """
    values = F.concat(*columns) if len(columns) > 1 else columns[0]
    rows = df.select(group.cast("long").alias("g"), values.alias("v")).filter(
        F.col("g").isNotNull() & F.col("v").isNotNull() & ~F.exists("v", F.isnull))
    schema = T.StructType([
        T.StructField("g", T.LongType()), T.StructField("n", T.LongType()),
        T.StructField("mean", T.BinaryType()), T.StructField("products", T.BinaryType())])

    def reduce_task(batches) -> Iterator:
        import pyarrow as pa

        found: dict[int, Moments] = {}
        for batch in batches:
            groups, matrix = batch.column(0).to_numpy(), _matrix(batch.column(1), width)
            for g in np.unique(groups):
                part = moments_of(matrix[groups == g])
                found[g] = merge(found[g], part) if g in found else part
        for g, m in found.items():
            yield pa.RecordBatch.from_arrays([
                pa.array([g], pa.int64()), pa.array([m.n], pa.int64()),
                pa.array([m.mean.tobytes()]), pa.array([m.products.tobytes()]),
            ], names=["g", "n", "mean", "products"])

    def read(row) -> tuple[int, Moments]:
        return row.g, Moments(row.n, np.frombuffer(row.mean),
                              np.frombuffer(row.products).reshape(width, width))

    return rows.mapInArrow(reduce_task, schema).rdd.map(read).reduceByKey(merge)


def numbers(*columns: str) -> Column:
    return F.array(*[F.col(c).cast("double") for c in columns])


def solve(m: Moments, strength: float = 0.0, l1_share: float = 0.0) -> tuple[np.ndarray, float]:
    """Coefficients and intercept of the last column on the others.

    The penalty is that of ``pyspark.ml``: on coefficients of standardised columns, the squared part
    relative to the deviation of the label. Without a penalty, the solution with the least norm is
    taken, so constant and dependent columns do no harm; a constant column gets 0.
    """
    p = len(m.mean) - 1
    spread = np.sqrt(np.maximum(np.diag(m.products), 0) / max(m.n, 1))
    moving = spread[:p] > 1e-12 * np.maximum(1, np.abs(m.mean[:p]))
    scale = np.where(moving, spread[:p], 1.0)
    gram = m.products[:p, :p] / np.outer(scale, scale) / m.n
    gram[~moving] = gram[:, ~moving] = 0
    right = np.where(moving, m.products[:p, p] / scale / m.n, 0)
    squared = strength * (1 - l1_share) / spread[p] if strength and spread[p] > 0 else 0.0
    absolute = strength * l1_share
    if not absolute:
        u = np.linalg.lstsq(gram + squared * np.eye(p), right, rcond=1e-11)[0] if p else right
    else:
        u, diagonal = np.zeros(p), np.diag(gram) + squared
        for _ in range(SWEEPS):
            change = 0.0
            for j in np.flatnonzero(moving):
                pull = right[j] - gram[j] @ u + gram[j, j] * u[j]
                new = np.sign(pull) * max(abs(pull) - absolute, 0) / diagonal[j]
                change, u[j] = max(change, abs(new - u[j])), new
            if change <= SETTLED * max(1.0, np.abs(u).max()):
                break
    coefficients = np.where(moving, u / scale, 0.0)
    return coefficients, float(m.mean[p] - coefficients @ m.mean[:p])


def residual_pulls(df: DataFrame, vector: str, width: int, label: str, prediction: str = "prediction") -> DataFrame:
    """``position, pull, n``: how strongly each standardised column still moves with the residual.

    The covariance of the residual and a column over the column's deviation, from one scan. Least
    squares makes all of them 0; with an absolute penalty they reach the strength where the coefficient
    is not 0, and nowhere exceed it. A constant column pulls 0.
    """
    values = [vector_to_array(vector), F.array((F.col(label) - F.col(prediction)).cast("double"))]
    found = moments_by(df, F.lit(0), values, width + 1)

    def pulls(pair):
        m = pair[1]
        spread = np.sqrt(np.maximum(np.diag(m.products)[:-1], 0) / m.n)
        pull = np.divide(m.products[:-1, -1] / m.n, spread, out=np.zeros(width), where=spread > 1e-12)
        return [(i, float(x), m.n) for i, x in enumerate(pull)]

    return df.sparkSession.createDataFrame(found.flatMap(pulls), "position int, pull double, n long")


def squared_error(m: Moments, coefficients: np.ndarray, intercept: float) -> float:
    """Sum of squared errors of a linear model over the rows behind the moments."""
    weights = np.append(-coefficients, 1.0)
    offset = weights @ m.mean - intercept
    return float(max(m.n * offset * offset + weights @ m.products @ weights, 0.0))


def _with_best(scores: DataFrame, metric: str, keys: list[str]) -> DataFrame:
    """``best`` marks the lowest score, the first in the order of the keys among equals."""
    lowest = scores.agg(F.min(F.struct(F.col(metric).alias("m"), *keys)).alias("_best"))
    same = F.lit(True)
    for key in keys:
        same = same & (F.col(key) == F.col(f"_best.{key}"))
    return attach_scalars(scores, lowest).withColumn("best", same).drop("_best")


def _scored(parts: RDD, settings: list[tuple[float, float]], df: DataFrame) -> DataFrame:
    """Fit and score ``(fold, (train, valid))`` moments under every (strength, l1_share)."""
    schema = ("fold int, strength double, l1_share double, n_train long, n_valid long, rmse double, "
              "intercept double, coefficients array<double>")

    def fit(pair):
        fold, (train, valid) = pair
        if train is None or valid is None:
            return
        for strength, share in settings:
            coefficients, intercept = solve(train, strength, share)
            rmse = (squared_error(valid, coefficients, intercept) / valid.n) ** 0.5
            yield (fold, strength, share, train.n, valid.n, rmse, intercept, coefficients.tolist())

    return cut(df.sparkSession.createDataFrame(parts.flatMap(fit), schema))


def linear_folds(
    df: DataFrame, order: list[str], label: str, features: list[str], vectors: dict[str, int] | None = None,
    folds: int = 5, scheme: str = "rolling", strength: float = 0.0, l1_share: float = 0.0,
) -> DataFrame:
    """Linear regression on time-ordered folds, all of them from one scan of the numbered rows.

    One row per fold: sizes, RMSE on the validation rows, model, and ``best``. The bounds of the
    folds cut the row numbers into slices; the moments of each slice are added up for every fold
    that trains or validates on it. ``vectors`` names vector columns and their widths. Rows with a
    null are numbered, but neither fitted nor scored; a fold without such rows on a side is left out.
    """
    vectors = vectors or {}
    columns = [*features, *vectors, label]
    numbered, n_rows = number_rows_and_count(df.select(*dict.fromkeys([*order, *columns])), order)
    bounds = fold_bounds(n_rows, folds, scheme)
    cuts = sorted({edge for f in bounds for edge in (
        f.train_first, f.train_last + 1, f.valid_first, f.valid_last + 1)})
    part = sum(((F.col("row_num") >= cut).cast("int") for cut in cuts), F.lit(0))
    values = [numbers(*features)] if features else []
    values += [vector_to_array(v) for v in vectors] + [numbers(label)]
    slices = moments_by(
        numbered, part, values, len(features) + sum(vectors.values()) + 1)

    def uses(pair):
        g, moments = pair
        for fold in bounds:
            train = g and fold.train_first <= cuts[g - 1] <= fold.train_last
            valid = g and fold.valid_first <= cuts[g - 1] <= fold.valid_last
            if train or valid:
                yield fold.fold, (moments if train else None, moments if valid else None)

    parts = slices.flatMap(uses).reduceByKey(_merge_sides)
    return _with_best(_scored(parts, [(strength, l1_share)], df), "rmse", ["fold"])


def linear_grid(
    df: DataFrame, fold: Column, label: str, features: list[str], settings: list[tuple[float, float]],
    vectors: dict[str, int] | None = None, folds: int = 5,
) -> DataFrame:
    """k-fold scores of every (strength, l1_share), all folds and settings from one scan.

    ``fold`` is a number from 0 to ``folds`` - 1, such as a hash of the key. A fold trains on the
    moments of all others. One row per fold and setting.
    """
    vectors = vectors or {}
    values = [numbers(*features)] if features else []
    values += [vector_to_array(v) for v in vectors] + [numbers(label)]
    found = moments_by(df, fold, values, len(features) + sum(vectors.values()) + 1)

    def uses(pair):
        own, m = pair
        return [(k, (None, m) if k == own else (m, None)) for k in range(folds)]

    return _scored(found.flatMap(uses).reduceByKey(_merge_sides), settings, df)


class Pairs(NamedTuple):
    """Of two blocks of columns, over the rows where both of a pair are present."""

    n: np.ndarray
    mean_a: np.ndarray
    mean_b: np.ndarray
    aa: np.ndarray
    bb: np.ndarray
    ab: np.ndarray


def _inside(x: np.ndarray, here: np.ndarray) -> np.ndarray:
    """A point within the data of each column: the mean, and exactly the value of a constant one."""
    if not len(x):
        return np.zeros(x.shape[1])
    low, high = np.where(here, x, np.inf).min(0), np.where(here, x, -np.inf).max(0)
    mean = np.where(here, x, 0).sum(0) / np.maximum(here.sum(0), 1)
    return np.where(low == high, low, mean)


def pairs_of(a: np.ndarray, b: np.ndarray) -> Pairs:
    """Moments of every pair of a column of ``a`` and one of ``b``; a missing value is NaN."""
    here_a, here_b = ~np.isnan(a), ~np.isnan(b)
    at_a, at_b = _inside(a, here_a), _inside(b, here_b)
    za, zb = np.where(here_a, a - at_a, 0), np.where(here_b, b - at_b, 0)
    ma, mb = here_a.astype(float), here_b.astype(float)
    n = ma.T @ mb
    some = np.maximum(n, 1)
    sum_a, sum_b = za.T @ mb, ma.T @ zb

    def centred(squares, sums):
        rest = squares - sums * sums / some
        return np.where(rest > ROUNDED * squares, rest, 0)  # constant over the rows of the pair

    return Pairs(
        n, np.where(n > 0, sum_a / some + at_a[:, None], 0), np.where(n > 0, sum_b / some + at_b, 0),
        centred((za * za).T @ mb, sum_a), centred(ma.T @ (zb * zb), sum_b),
        za.T @ zb - sum_a * sum_b / some)


def _apart(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The difference of two means, 0 where it is only rounded off."""
    return np.where(np.abs(y - x) > ROUNDED * np.abs(x), y - x, 0)


def merge_pairs(x: Pairs, y: Pairs) -> Pairs:
    n = x.n + y.n
    some = np.maximum(n, 1)
    both = x.n * y.n / some
    da = np.where(both > 0, _apart(x.mean_a, y.mean_a), 0)
    db = np.where(both > 0, _apart(x.mean_b, y.mean_b), 0)
    first = x.n >= 1
    return Pairs(
        n, np.where(first, x.mean_a + da * y.n / some, y.mean_a),
        np.where(first, x.mean_b + db * y.n / some, y.mean_b),
        x.aa + y.aa + da * da * both, x.bb + y.bb + db * db * both, x.ab + y.ab + da * db * both)


def correlations(df: DataFrame, columns: list[str], block: int = BLOCK) -> DataFrame:
    """``a, b, n, correlation`` of every pair of columns, a before b, from one scan.

    A pair counts the rows where both are present. It has no correlation with fewer than two of
    them or if one of the columns is constant there. The table of pairs is cut into blocks of columns, which
    tasks merge apart from each other.
    """
    spark = df.sparkSession
    rows = df.select(F.array(*[F.col(c).cast("double") for c in columns]).alias("v"))
    starts = list(range(0, len(columns), block))
    schema = T.StructType([
        T.StructField("i", T.IntegerType()), T.StructField("j", T.IntegerType()),
        T.StructField("data", T.BinaryType())])

    def reduce_task(batches) -> Iterator:
        import pyarrow as pa

        found: dict[tuple[int, int], Pairs] = {}
        for batch in batches:
            matrix = _matrix(batch.column(0), len(columns))
            for i in starts:
                for j in starts[i // block:]:
                    part = pairs_of(matrix[:, i:i + block], matrix[:, j:j + block])
                    found[i, j] = merge_pairs(found[i, j], part) if (i, j) in found else part
        for (i, j), pairs in found.items():
            yield pa.RecordBatch.from_arrays([
                pa.array([i], pa.int32()), pa.array([j], pa.int32()),
                pa.array([np.stack(pairs).tobytes()])], names=["i", "j", "data"])

    def read(row):
        shape = (6, len(columns[row.i:row.i + block]), len(columns[row.j:row.j + block]))
        return (row.i, row.j), Pairs(*np.frombuffer(row.data).reshape(shape))

    def results(pair):
        (i, j), p = pair
        for x, y in zip(*np.nonzero(np.ones_like(p.n))):
            if i + x < j + y:
                varied = p.n[x, y] > 1 and p.aa[x, y] > 0 and p.bb[x, y] > 0
                yield (columns[i + x], columns[j + y], int(p.n[x, y]), min(1.0, max(-1.0, float(
                    p.ab[x, y] / np.sqrt(p.aa[x, y] * p.bb[x, y])))) if varied else None)

    merged = rows.mapInArrow(reduce_task, schema).rdd.map(read).reduceByKey(merge_pairs)
    return spark.createDataFrame(
        merged.flatMap(results), "a string, b string, n long, correlation double")
