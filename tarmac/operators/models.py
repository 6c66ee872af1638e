"""Estimators, time-ordered cross-validation, grids and coefficients."""

from __future__ import annotations

import math
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from itertools import chain

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.evaluation import (
    BinaryClassificationEvaluator, Evaluator, MulticlassClassificationEvaluator,
    RegressionEvaluator,
)
from pyspark.ml.regression import (
    GBTRegressor, GeneralizedLinearRegression, LinearRegression, LinearRegressionModel,
)
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.operators.ordered import number_rows
from tarmac.operators.splits import Fold, fold_bounds, fold_rows
from tarmac.session import cut, spread

# Hidden layers of the classifiers, and their solver settings.
HIDDEN_LAYERS = ((2,), (4,), (2, 2), (4, 2), (5, 4))
MLP_ITERATIONS, MLP_BLOCK, MLP_SEED = 100, 128, 1234
# Settings of the boosted trees and the regularisation grid.
TREE_DEPTH, TREE_COUNT, LEARNING_RATE = 6, 150, 0.2
REGULARISATION = (0.01, 0.1, 1.0)
# Fits that the driver submits at a time, so that small stages of one fill the gaps of another.
# Each keeps a copy of its rows for its iterations, so together they may hold only so many rows.
FITS_AT_ONCE, ROWS_AT_ONCE = 4, 100_000_000
# Merged rows that trees take as they are, bins of a number beyond that (as many as a tree has for it
# anyway), and merged rows of a task.
MERGED_ROWS, TREE_BINS, MERGED_PER_TASK = 500_000, 32, 50_000


def linear(label: str, features: str = "features", **params) -> LinearRegression:
    return LinearRegression(labelCol=label, featuresCol=features, **params)


def lasso(label: str, strength: float, features: str = "features", **params) -> LinearRegression:
    return linear(label, features, elasticNetParam=1.0, regParam=strength, **params)


def tweedie(label: str, power: float = 0.0, features: str = "features", **params):
    """A generalised linear model whose variance grows with a power of the mean. Its link is the power
    1 - ``power`` of the mean unless ``linkPower`` names another; 0 is the logarithm."""
    return GeneralizedLinearRegression(
        family="tweedie", variancePower=power, labelCol=label, featuresCol=features, **params
    )


def score_equations(
    scored: DataFrame, label: str, columns: list[str], variance_power: float, link_power: float,
    prediction: str = "prediction",
) -> DataFrame:
    """``column, score, terms`` of a fitted tweedie model, from one pass.

    At the maximum of the likelihood the sum of (y - mu) x / (V(mu) g'(mu)) is 0 for the intercept and
    for every column. ``score`` is that sum relative to the sum of its absolute terms.
    """
    y, mu = F.col(label), F.col(prediction)
    slope = 1 / mu if link_power == 0 else link_power * F.pow(mu, F.lit(link_power - 1.0))
    pull = (y - mu) / (F.pow(mu, F.lit(float(variance_power))) * slope)
    terms = {"intercept": pull, **{c: pull * F.col(c) for c in columns}}
    sums = scored.agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(t).alias(f"_s{i}") for i, t in enumerate(terms.values())],
        *[F.sum(F.abs(t)).alias(f"_a{i}") for i, t in enumerate(terms.values())])
    rows = [F.struct(F.lit(c).alias("column"), F.try_divide(f"_s{i}", f"_a{i}").alias("score"),
                     F.col("_n").alias("terms")) for i, c in enumerate(terms)]
    return sums.select(F.inline(F.array(*rows)))


def boosted_trees(
    label: str, features: str = "features", depth: int = TREE_DEPTH, trees: int = TREE_COUNT,
    rate: float = LEARNING_RATE, **params,
) -> GBTRegressor:
    return GBTRegressor(
        labelCol=label, featuresCol=features, maxDepth=depth, maxIter=trees, stepSize=rate,
        **params,
    )


def bin_numbers(train: DataFrame, numbers: list[str], bins: int = TREE_BINS) -> dict[str, tuple]:
    """Upper edges of the quantile bins of every number, and the mean of the training values in each."""
    shares = [i / bins for i in range(1, bins)]
    found = train.approxQuantile(numbers, shares, 1 / (16 * bins))
    edges = {c: sorted(set(quantiles)) for c, quantiles in zip(numbers, found, strict=True)}
    means = train.agg(*[
        F.avg(F.when((_bin(c, edges[c]) == i) & ~F.isnan(c), F.col(c))).alias(f"{c}_{i}")
        for c in numbers for i in range(len(edges[c]) + 1)]).first()
    return {c: (edges[c], [
        (edges[c] or [0.0])[min(i, len(edges[c]) - 1)] if means[f"{c}_{i}"] is None else means[f"{c}_{i}"]
        for i in range(len(edges[c]) + 1)]) for c in numbers}


def _bin(column: str, edges: list[float]) -> Column:
    """Number of edges below the value."""
    return sum((F.when(F.col(column) > e, 1).otherwise(0) for e in edges), F.lit(0))


def in_bins(df: DataFrame, binned: dict[str, tuple]) -> DataFrame:
    """Every binned number replaced by the mean of its bin; nulls and NaN stay."""
    return df.withColumns({
        c: F.when(F.col(c).isNull() | F.isnan(c), F.col(c)).otherwise(
            F.get(F.array(*map(F.lit, means)), _bin(c, edges)))
        for c, (edges, means) in binned.items()})


def merge_rows(train: DataFrame, features: list[str], label: str, weight: str = "weight") -> DataFrame:
    """One row per combination of the features: the mean label, and the number of rows as its weight.

    Under squared loss a tree sees of such rows only their number and the sum of their labels, and
    gives all of them one prediction, so boosted trees of the merged rows are those of all rows.
    A null label becomes NaN, which a fit refuses as it does the null.
    """
    known = F.coalesce(F.col(label).cast("double"), F.lit(float("nan")))
    return train.groupBy(*features).agg(
        F.avg(known).alias(label), F.count(F.lit(1)).cast("double").alias(weight))


def tree_rows(
    train: DataFrame, test: DataFrame, categories: list[str], numbers: list[str], label: str,
    weight: str = "weight", most: int = MERGED_ROWS, per_task: int = MERGED_PER_TASK,
) -> tuple[DataFrame, DataFrame]:
    """Training rows merged for boosted trees, stored in few partitions, and the test rows to score.

    Trees make hundreds of short passes, so these go over the combinations of feature values and not
    over the rows. Where numbers have so many values that more than ``most`` combinations are left,
    they are put in as many quantile bins as a tree gives a number (in the test rows too), which
    bounds the combinations whatever the rows are. Up to ``per_task`` rows stay as they are.
    """
    if train.limit(per_task + 1).count() <= per_task:
        return spread(train).withColumn(weight, F.lit(1.0)), test

    def merged(rows: DataFrame) -> tuple[DataFrame, int]:
        stored = cut(merge_rows(rows, [*categories, *numbers], label, weight))
        return stored, stored.count()

    few, n = merged(train)
    if n > most:
        binned = bin_numbers(train, numbers)
        few, n = merged(in_bins(train, binned))
        test = in_bins(test, binned)
    return few.coalesce(max(1, -(-n // per_task))), test


def perceptron(
    label: str, width: int, hidden: tuple[int, ...], features: str = "features",
    iterations: int = MLP_ITERATIONS,
) -> MultilayerPerceptronClassifier:
    """Classifier of two classes with the given hidden layers."""
    return MultilayerPerceptronClassifier(
        labelCol=label, featuresCol=features, layers=[width, *hidden, 2], maxIter=iterations,
        blockSize=MLP_BLOCK, seed=MLP_SEED,
    )


def rmse(label: str) -> RegressionEvaluator:
    return RegressionEvaluator(labelCol=label, metricName="rmse")


def fit_at_once(spark: SparkSession, task: Callable, items: list, rows: int = 0) -> list:
    """Run a few independent fits of up to ``rows`` rows at a time; the driver only submits their jobs.

    Large fits fill the cluster alone and run one after the other, so that their copies stay in memory.
    """
    with ThreadPoolExecutor(max(1, min(FITS_AT_ONCE, ROWS_AT_ONCE // max(rows, 1)))) as pool:
        return list(pool.map(inheritable_thread_target(spark)(task), items))


def _marked_best(rows: list[tuple], schema: str, larger: bool, source: DataFrame) -> DataFrame:
    """Result rows, the best one flagged in the direction of the metric."""
    scores = [row[-1] for row in rows]
    best = scores.index(max(scores) if larger else min(scores))
    flagged = [(*row, i == best) for i, row in enumerate(rows)]
    return source.sparkSession.createDataFrame(flagged, f"{schema}, metric double, best boolean")


def fold_scores(
    df: DataFrame, order: list[str], estimator: Estimator, evaluator: Evaluator,
    folds: int = 5, scheme: str = "rolling", prepare: Estimator | None = None,
) -> DataFrame:
    """Fit and score on time-ordered folds; one row per fold.

    ``prepare`` (encoders, scalers) is fitted on the training rows of each fold.
    """
    numbered = number_rows(df, order)

    def score(fold: Fold) -> tuple:
        train, valid = fold_rows(numbered, fold)
        if prepare is not None:
            fitted = prepare.fit(train)
            train, valid = fitted.transform(train), fitted.transform(valid)
        return fold.fold, evaluator.evaluate(estimator.fit(train).transform(valid))

    n = numbered.count()
    rows = fit_at_once(df.sparkSession, score, fold_bounds(n, folds, scheme), n)
    return _marked_best(rows, "fold int", evaluator.isLargerBetter(), df)


def fold_average(scores: DataFrame) -> DataFrame:
    return scores.agg(
        F.avg("metric").alias("avg_metric"),
        F.max_by("fold", "best").alias("best_fold"),
        F.max(F.when(F.col("best"), F.col("metric"))).alias("best_metric"),
    )


def grid_scores(
    train: DataFrame, valid: DataFrame, grid: list[dict], build: Callable[..., Estimator],
    evaluator: Evaluator,
) -> DataFrame:
    """Fit one model per setting and score it on the validation rows; one row per setting.

    Boosted trees are added one by one, so a fit with fewer trees is the beginning of one with more:
    settings that differ only in their number are fitted once.
    """
    train, valid = train.persist(), valid.persist()
    estimators = [build(**setting) for setting in grid]
    alike: dict = {}
    for i, estimator in enumerate(estimators):
        alike.setdefault(_but_trees(estimator, evaluator) or i, []).append(i)

    def score(members: list[int]) -> list[tuple[int, float]]:
        if len(members) == 1:
            fitted = estimators[members[0]].fit(train)
            return [(members[0], evaluator.evaluate(fitted.transform(valid)))]
        most = max((estimators[i] for i in members), key=lambda e: e.getMaxIter())
        rows = valid.withColumn(most.getWeightCol(), F.lit(1.0)) if most.isDefined("weightCol") else valid
        errors = most.fit(train).evaluateEachIteration(rows, "squared")
        return [(i, math.sqrt(errors[estimators[i].getMaxIter() - 1])) for i in members]

    try:
        found = dict(chain.from_iterable(fit_at_once(
            train.sparkSession, score, list(alike.values()), train.count())))
    finally:
        train.unpersist()
        valid.unpersist()
    rows = [(str(setting), found[i]) for i, setting in enumerate(grid)]
    return _marked_best(rows, "setting string", evaluator.isLargerBetter(), train)


def _but_trees(estimator: Estimator, evaluator: Evaluator) -> str | None:
    """All settings of boosted trees but their number; None if their fits cannot share trees, or
    the score is not the root of the mean squared error that every number of trees has."""
    if not isinstance(estimator, GBTRegressor) or not isinstance(evaluator, RegressionEvaluator):
        return None
    if (evaluator.getMetricName() != "rmse" or evaluator.isDefined("weightCol")
            or estimator.isDefined("validationIndicatorCol")
            or (evaluator.getLabelCol(), evaluator.getPredictionCol())
            != (estimator.getLabelCol(), estimator.getPredictionCol())):
        return None
    return str(sorted((p.name, str(v)) for p, v in estimator.extractParamMap().items() if p.name != "maxIter"))


def kfold_scores(
    df: DataFrame, estimator: Estimator, grid: list[dict], evaluator: Evaluator, folds: int = 5,
    seed: int = 42,
) -> DataFrame:
    """Mean score of every parameter map over random folds."""
    fitted = CrossValidator(
        estimator=estimator, estimatorParamMaps=grid, evaluator=evaluator, numFolds=folds,
        seed=seed, parallelism=FITS_AT_ONCE,
    ).fit(df)
    rows = [
        (str({p.name: v for p, v in setting.items()}), float(score))
        for setting, score in zip(grid, fitted.avgMetrics, strict=True)
    ]
    return _marked_best(rows, "setting string", evaluator.isLargerBetter(), df)


def training_summary(model: LinearRegressionModel, source: DataFrame) -> DataFrame:
    """MAE, RMSE and number of residuals of a fitted linear model."""
    s = model.summary
    return source.sparkSession.createDataFrame(
        [(float(s.meanAbsoluteError), float(s.rootMeanSquaredError), int(s.numInstances))],
        "mae double, rmse double, residuals long",
    )


def coefficient_table(names: list[str], values, source: DataFrame) -> DataFrame:
    """Coefficients with their feature names and magnitudes."""
    rows = [(n, float(v), abs(float(v))) for n, v in zip(names, values, strict=True)]
    return source.sparkSession.createDataFrame(
        rows, "feature string, coefficient double, magnitude double"
    )


def extreme_coefficients(table: DataFrame, k: int = 10, by: str = "magnitude") -> DataFrame:
    """The k largest and the k smallest coefficients, by magnitude or by signed value."""
    top = table.orderBy(F.desc(by), "feature").limit(k).withColumn("end", F.lit("top"))
    low = table.orderBy(by, "feature").limit(k).withColumn("end", F.lit("bottom"))
    return top.unionByName(low)


def area_scores(scored: DataFrame, label: str, score: str = "rawPrediction") -> DataFrame:
    """Exact area under the ROC and the precision-recall curve."""
    values = [
        float(BinaryClassificationEvaluator(
            labelCol=label, rawPredictionCol=score, metricName=name, numBins=0
        ).evaluate(scored))
        for name in ("areaUnderROC", "areaUnderPR")
    ]
    return scored.sparkSession.createDataFrame([tuple(values)], "area_roc double, area_pr double")


def f3_of_positives(label: str) -> MulticlassClassificationEvaluator:
    """F-beta of class 1 with beta 3, for use in grids and folds."""
    return MulticlassClassificationEvaluator(
        labelCol=label, metricName="fMeasureByLabel", metricLabel=1.0, beta=3.0
    )
