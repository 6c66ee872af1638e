"""Feature encoding, metrics and models."""

from __future__ import annotations

from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tarmac.functions.numbers import over_threshold
from tarmac.operators import encoding, features, folds, metrics, models, moments
from tarmac.operators.clean import split_at
from tarmac.operators.splits import fold_bounds, fold_rows
from tarmac.plans.common import Query, rounded, table
from tarmac.session import cut, new_folder, spread

_CATEGORIES = ["l_returnflag", "l_linestatus"]
_NUMBERS = ["l_quantity", "l_discount", "l_tax"]
_LABEL = "l_extendedprice"
_CUTOFF = "1999-01-01"


def _lines(spark, folder):
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate",
        *_CATEGORIES, *_NUMBERS, _LABEL)


def _train_test(spark, folder):
    return split_at(_lines(spark, folder), "l_shipdate", F.lit(_CUTOFF).cast("timestamp_ntz"))


def _encoded(spark, folder):
    """Train and test rows with a feature vector fitted on the training rows."""
    train, test = (spread(part) for part in _train_test(spark, folder))
    fitted = features.encoder(_CATEGORIES, _NUMBERS).fit(train)
    return fitted.transform(train), fitted.transform(test)


def _late(df):
    """Expensive lines as the positive class."""
    return df.withColumn("label", over_threshold(F.col(_LABEL), 50_000).cast("double"))


def category_index(spark, folder):
    return features.category_index(table(spark, folder, "part"), "p_brand")


def one_hot_width(spark, folder):
    parts = table(spark, folder, "part")
    slots = encoding.fit_encoding(parts, ["p_brand", "p_type"], drop_last=True).levels
    widths = slots.agg(
        F.count(F.when(F.col("column") == "p_brand", F.col("slot"))).alias("brand_width"),
        F.count(F.when(F.col("column") == "p_type", F.col("slot"))).alias("type_width"))
    return widths.crossJoin(parts.agg(F.count(F.lit(1)).alias("n")))


def one_hot_names(spark, folder):
    parts = table(spark, folder, "part")
    names = encoding.slot_table(encoding.fit_encoding(parts, ["p_type"], drop_last=True))
    return names.select(F.col("slot").cast("long").alias("slot"), "level")


def _texts(spark, folder):
    """Documents with a number and three columns: whole texts, nearly all distinct, and two short ones."""
    return table(spark, folder, "documents").select("doc_id", "n_chars", "text", "lang", "source")


def one_hot_slots(spark, folder):
    """Every document's slots, where whole texts are levels too."""
    docs = _texts(spark, folder)
    fitted = encoding.fit_encoding(docs, ["lang", "text", "source"], ["n_chars"])
    encoded = encoding.encode(docs, fitted, ["doc_id"])
    vector = F.col("features").cast("string")
    return encoded.select(
        "doc_id", F.regexp_extract(vector, r"\((\d+),", 1).cast("int").alias("width"),
        F.regexp_extract(vector, r"\[([\d,]*)\]", 1).alias("slots"))


def one_hot_levels(spark, folder):
    """Index and slot of every level of the whole texts and sources."""
    fitted = encoding.fit_encoding(_texts(spark, folder), ["text", "source"], drop_last=True)
    return fitted.levels.select(
        "column", F.md5("level").alias("level_md5"), "n", F.col("index"), "slot")


def label_index(spark, folder):
    lines = _lines(spark, folder).withColumn(
        "flag", F.when(F.col(_LABEL) > 50_000, "late").otherwise("on time"))
    indexed = StringIndexer(inputCol="flag", outputCol="label").fit(lines).transform(lines)
    return indexed.groupBy("flag", "label").agg(F.count(F.lit(1)).alias("n"))


def standardise(spark, folder):
    lines = _lines(spark, folder)
    scaled = features.standardise(lines, _NUMBERS)
    names = [f"{c}_scaled" for c in _NUMBERS]
    return rounded(scaled.select("l_orderkey", "l_linenumber", "l_partkey", *names), *names)


def standardise_train_fit(spark, folder):
    train, test = _train_test(spark, folder)
    scaled = features.standardise(test, ["l_quantity"], train)
    return rounded(scaled.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity_scaled"),
                   "l_quantity_scaled")


def assemble_vector(spark, folder):
    lines = _lines(spark, folder)
    vectors = VectorAssembler(inputCols=_NUMBERS, outputCol="vector").transform(lines)
    values = vector_to_array("vector")
    return vectors.select(
        "l_orderkey", "l_linenumber", *[values[i].alias(f"v{i}") for i in range(len(_NUMBERS))])


def _baseline(spark, folder):
    train, test = _train_test(spark, folder)
    return metrics.mean_baseline(train, test, _LABEL)


def regression_metrics(spark, folder):
    scores = metrics.regression_metrics(_baseline(spark, folder), _LABEL)
    return rounded(scores, "rmse", "mae", "mse", "rmsle", "mape", digits=4)


_BASELINE_SQL = f"""
b AS (SELECT avg({_LABEL}) AS p FROM lineitem WHERE l_shipdate <= TIMESTAMP '{_CUTOFF}'),
s AS (SELECT {_LABEL} AS y, p FROM lineitem, b WHERE l_shipdate > TIMESTAMP '{_CUTOFF}')"""


def _judged(spark, folder):
    """Quality labels against a guess from the length of the text."""
    docs = table(spark, folder, "documents").select("doc_id", "n_chars")
    judged = table(spark, folder, "labels").join(docs, "doc_id")
    return metrics.confusion(judged, F.col("quality"), over_threshold(F.col("n_chars"), 400))


def confusion_counts(spark, folder):
    return _judged(spark, folder)


def weighted_pr(spark, folder):
    scores = metrics.weighted_scores(_judged(spark, folder))
    return rounded(scores, "weighted_precision", "weighted_recall", "f_beta_weighted")


def f_beta(spark, folder):
    return rounded(metrics.binary_scores(_judged(spark, folder)), "f_beta_binary")


def always_late_baseline(spark, folder):
    """Scores of predicting the positive class for every row."""
    lines = _late(_lines(spark, folder))
    counts = cut(metrics.confusion(lines, F.col("label").cast("int"), F.lit(1)))
    both = metrics.weighted_scores(counts).crossJoin(metrics.binary_scores(counts))
    return rounded(both, "weighted_precision", "weighted_recall", "f_beta_weighted",
                   "f_beta_binary")


_JUDGED_SQL = """
j AS (SELECT quality AS y, CASE WHEN n_chars > 400 THEN 1 ELSE 0 END AS p
      FROM labels JOIN documents USING (doc_id))"""


def _scores_sql(source):
    """Per-class precision and recall, and the closed form, from (y, p)."""
    return f"""
k AS (SELECT unnest([0, 1]) AS c),
q AS (SELECT c, count(*) FILTER (WHERE y = c) AS n, count(*) FILTER (WHERE p = c) AS m,
        count(*) FILTER (WHERE y = c AND p = c) AS h FROM {source}, k GROUP BY 1),
a AS (SELECT sum(n * CASE WHEN m = 0 THEN 0 ELSE h / m::DOUBLE END) / sum(n) AS wp,
        sum(n * CASE WHEN n = 0 THEN 0 ELSE h / n::DOUBLE END) / sum(n) AS wr FROM q),
z AS (SELECT count(*) FILTER (WHERE y = 1 AND p = 1) AS tp,
        count(*) FILTER (WHERE y = 0 AND p = 1) AS fp,
        count(*) FILTER (WHERE y = 1 AND p = 0) AS fn,
        count(*) FILTER (WHERE y = 0 AND p = 0) AS tn FROM {source})"""


_WEIGHTED_COLUMNS = """round(wp, 6) AS weighted_precision, round(wr, 6) AS weighted_recall,
       round(10 * wp * wr / (9 * wp + wr), 6) AS f_beta_weighted"""
_BINARY_COLUMNS = """tp, fp, fn, tn,
       round(tp / (tp + 0.1::DOUBLE * fp + 0.9::DOUBLE * fn), 6) AS f_beta_binary"""


def _one_feature(spark, folder):
    """Train and test rows with the quantity as the only feature."""
    assembler = VectorAssembler(inputCols=["l_quantity"], outputCol="features")
    return [assembler.transform(part) for part in _train_test(spark, folder)]


def linear_fit(spark, folder):
    train, _ = _one_feature(spark, folder)
    model = models.linear(_LABEL).fit(train)
    return spark.createDataFrame(
        [(round(float(model.coefficients[0]), 4), round(float(model.intercept), 4))],
        "slope double, intercept double")


def linear_summary(spark, folder):
    train, _ = _one_feature(spark, folder)
    summary = models.training_summary(models.linear(_LABEL).fit(train), train)
    return rounded(summary, "mae", "rmse", digits=4)


_METRICS = ["rmse", "mae", "mse", "rmsle", "mape"]


def linear_holdout(spark, folder):
    train, test = _one_feature(spark, folder)
    scores = metrics.regression_metrics(models.linear(_LABEL).fit(train).transform(test), _LABEL)
    return rounded(scores, *_METRICS, digits=3)


def glm_tweedie(spark, folder):
    """Variance power 0 with its canonical identity link, which is least squares again."""
    train, test = _one_feature(spark, folder)
    scores = metrics.regression_metrics(models.tweedie(_LABEL, 0.0).fit(train).transform(test),
                                        _LABEL)
    return rounded(scores, *_METRICS, digits=3)


def _tweedie_scores(spark, folder, link):
    train, _ = _one_feature(spark, folder)
    model = models.tweedie(_LABEL, 1.5, linkPower=link, maxIter=100, tol=1e-10).fit(train)
    scores = models.score_equations(model.transform(train), _LABEL, ["l_quantity"], 1.5, link)
    return scores.select("column", (F.round("score", 6) + 0.0).alias("score"), "terms")


def glm_tweedie_power(spark, folder):
    """Score equations of a model with variance power 1.5 and its own link, the power -0.5."""
    return _tweedie_scores(spark, folder, -0.5)


def glm_tweedie_log(spark, folder):
    """The same with the logarithm as link, as the compound Poisson model has it."""
    return _tweedie_scores(spark, folder, 0.0)


_SCORES_SQL = f"""
SELECT unnest(['intercept', 'l_quantity']) AS "column", 0.0::DOUBLE AS score, count(*) AS terms
FROM lineitem WHERE l_shipdate <= TIMESTAMP '{_CUTOFF}'"""

_FIT_SQL = f"""
f AS (SELECT regr_slope({_LABEL}, l_quantity) AS a, regr_intercept({_LABEL}, l_quantity) AS c
      FROM lineitem WHERE l_shipdate <= TIMESTAMP '{_CUTOFF}')"""
_HOLDOUT_SQL = f"""
WITH {_FIT_SQL},
s AS (SELECT {_LABEL} AS y, a * l_quantity + c AS p FROM lineitem, f
      WHERE l_shipdate > TIMESTAMP '{_CUTOFF}')
SELECT round(sqrt(avg((y - p) * (y - p))), 3) AS rmse, round(avg(abs(y - p)), 3) AS mae,
       round(avg((y - p) * (y - p)), 3) AS mse,
       round(sqrt(avg(pow(ln(1 + y) - ln(1 + greatest(p, 0)), 2))), 3) AS rmsle,
       round(avg(abs((y - p) / nullif(y, 0))), 3) AS mape
FROM s"""


def lasso_fit(spark, folder):
    train, _ = _encoded(spark, folder)
    model = models.lasso(_LABEL, 10.0).fit(train)
    names = features.slot_names(train, "features")
    return models.coefficient_table(names, model.coefficients, train)


def _named_pulls(train, model, strength):
    """Whether each coefficient meets the conditions of the best one, by feature."""
    names = features.slot_names(train, "features")
    pulls = moments.residual_pulls(model.transform(train), "features", len(names), _LABEL)
    about = train.sparkSession.createDataFrame(
        [(i, n, float(c)) for i, (n, c) in enumerate(zip(names, model.coefficients))],
        "position int, feature string, coefficient double")
    off = F.when(F.col("coefficient") != 0, F.abs(F.col("pull") - strength * F.signum("coefficient"))).otherwise(
        F.greatest(F.lit(0.0), F.abs("pull") - strength))
    return about.join(pulls, "position").select("feature", "n", (off < 1e-2).alias("meets"))


def lasso_check(spark, folder):
    """The conditions that the coefficients of ``lasso_fit`` must meet, feature by feature."""
    train, _ = _encoded(spark, folder)
    return _named_pulls(train, models.lasso(_LABEL, 10.0, maxIter=500, tol=1e-9).fit(train), 10.0)


def coef_check(spark, folder):
    """The same for least squares, the model of ``coef_topk``: no column moves with the residual."""
    train, _ = _encoded(spark, folder)
    return _named_pulls(train, models.linear(_LABEL, solver="normal").fit(train), 0.0)


_PULLS_SQL = f"""
WITH t AS (SELECT * FROM lineitem WHERE l_shipdate <= TIMESTAMP '{_CUTOFF}'),
f AS (SELECT DISTINCT 'l_returnflag_onehot_' || l_returnflag AS feature FROM t
  UNION SELECT 'l_linestatus_onehot_' || l_linestatus FROM t
  UNION SELECT unnest(['scaled_0', 'scaled_1', 'scaled_2']))
SELECT feature, (SELECT count(*) FROM t) AS n, TRUE AS meets FROM f"""


def coef_topk(spark, folder):
    train, _ = _encoded(spark, folder)
    names = features.slot_names(train, "features")
    model = models.linear(_LABEL, solver="normal").fit(train)
    table_ = models.coefficient_table(names, model.coefficients, train)
    return models.extreme_coefficients(table_, 3)


def without_numbers_fit(spark, folder):
    train, test = _encoded(spark, folder)
    dropped = [n for n in features.slot_names(train, "features") if n.startswith("scaled")]
    fewer, kept = (features.without_slots(df, "features", dropped, "kept")
                   for df in (train, test))
    model = models.linear(_LABEL, "kept").fit(fewer)
    return metrics.regression_metrics(model.transform(kept), _LABEL)


_ORDER = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
          _LABEL]


def _cv(spark, folder, scheme):
    scores = moments.linear_folds(
        _lines(spark, folder), _ORDER, _LABEL, ["l_quantity"], folds=5, scheme=scheme)
    return scores.select("fold", F.col("rmse").alias("metric"), "best")


def linear_cv(spark, folder):
    return rounded(_cv(spark, folder, "rolling"), "metric", digits=4)


def linear_cv_blocked(spark, folder):
    return rounded(_cv(spark, folder, "blocked"), "metric", digits=4)


def linear_cv_models(spark, folder):
    """The model of every fold with the sizes of its two parts."""
    scores = moments.linear_folds(_lines(spark, folder), _ORDER, _LABEL, ["l_quantity"], scheme="blocked")
    return scores.select(
        "fold", "n_train", "n_valid", F.round(F.col("coefficients")[0], 4).alias("slope"),
        F.round("intercept", 3).alias("intercept"))


def linear_cv_average(spark, folder):
    averages = models.fold_average(_cv(spark, folder, "rolling"))
    return rounded(averages, "avg_metric", "best_metric", digits=4)


def _cv_sql(train, valid):
    return f"""
WITH r AS (SELECT l_quantity AS x, {_LABEL} AS y,
             row_number() OVER (ORDER BY {", ".join(_ORDER)}) AS i FROM lineitem),
n AS (SELECT count(*) AS n FROM r), k AS (SELECT CAST(unnest([1, 2, 3, 4, 5]) AS INT) AS fold),
b AS (SELECT fold, (fold - 1) * n // 6 AS begin, fold * n // 6 AS stop, n // 6 AS size,
        3 * n // 60 AS short FROM k, n),
f AS (SELECT fold, regr_slope(y, x) AS a, regr_intercept(y, x) AS c FROM r, b
      WHERE {train} GROUP BY 1),
s AS (SELECT fold, sqrt(avg(pow(y - a * x - c, 2))) AS m FROM r, b JOIN f USING (fold)
      WHERE {valid} GROUP BY 1),
o AS (SELECT fold, round(m, 4) AS metric, m = (SELECT min(m) FROM s) AS best, m FROM s)"""


_ROLLING_SQL = _cv_sql("i <= stop", "i > stop AND i <= stop + size")
_BLOCKED_SQL = _cv_sql("i >= begin AND i < stop", "i >= stop AND i <= stop + short")


def encoded_cv(spark, folder):
    """Folds over encoded categories. Least squares does not depend on how columns are scaled, and a
    level that the training rows of a fold lack has no coefficient there, so one encoding serves all."""
    lines = _lines(spark, folder)
    stages = features.encoder(_CATEGORIES, _NUMBERS)
    fitted = stages.fit(lines)
    encoded = fitted.transform(lines)
    widths = {f"{c}_onehot": len(features.slot_names(encoded, f"{c}_onehot")) for c in _CATEGORIES}
    scores = moments.linear_folds(encoded, _ORDER, _LABEL, _NUMBERS, widths)
    return scores.select("fold", "n_train", "n_valid", F.col("rmse").alias("metric"), "best")


_FOLDS = 5


def _fold_of(*key):
    """The fold of a row by the hash of its key, so that it never depends on the partitions."""
    digest = F.md5(F.concat_ws(":", *[F.col(k).cast("string") for k in key]))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % _FOLDS


_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
_FOLD_SQL = ("CAST('0x' || substr(md5(concat_ws(':', l_orderkey, l_linenumber, l_partkey, l_suppkey))"
             f", 1, 8) AS BIGINT) % {_FOLDS}")


def kfold_grid(spark, folder):
    """Mean score of every strength over hashed folds, with one feature, which SQL can fit too."""
    scores = moments.linear_grid(
        _lines(spark, folder), _fold_of(*_KEY), _LABEL, ["l_quantity"],
        [(strength, 0.0) for strength in models.REGULARISATION])
    means = scores.groupBy("strength").agg(F.avg("rmse").alias("metric"))
    return rounded(means, "metric", digits=4)


def kfold_grid_encoded(spark, folder):
    """The same over encoded categories and scaled numbers, with and without the absolute penalty."""
    encoded, _ = _encoded(spark, folder)
    width = len(features.slot_names(encoded, "features"))
    settings = [(strength, share) for strength in models.REGULARISATION for share in (0.0, 1.0)]
    scores = moments.linear_grid(
        encoded, _fold_of(*_KEY), _LABEL, [], settings, {"features": width})
    return scores.select("fold", "strength", "l1_share", "n_train", "n_valid",
                         (F.col("rmse") > 0).alias("scored"))


def _scores(predictions):
    """Weighted and binary scores of class predictions, and the precision and recall of pyspark.ml."""
    counts = cut(metrics.confusion(
        predictions, F.col("label").cast("int"), F.col("prediction").cast("int")))
    return metrics.weighted_scores(counts).crossJoin(metrics.binary_scores(counts))


def _classifier_run(spark, folder, run):
    rows = _late(_lines(spark, folder)).select(*_ORDER, "l_discount", "l_tax", *_CATEGORIES, "label")
    return folds.cross_validate(
        rows.drop(_LABEL), [c for c in _ORDER if c != _LABEL],
        lambda width: models.perceptron("label", width, (2,)), _scores, "f_beta_weighted", run,
        prepare=features.encoder(_CATEGORIES, _NUMBERS))


def classifier_cv(spark, folder):
    """Weighted F3 of a perceptron on rolling folds; every fold's pipeline is stored."""
    scores = _classifier_run(spark, folder, new_folder(spark, "folds"))
    return scores.select(
        "fold", "n_train", "n_valid", "weighted_precision", "weighted_recall", "f_beta_weighted", "best")


def classifier_cv_check(spark, folder):
    """What must hold of such a run, whatever the perceptron learned: the sizes and positives of the
    folds, its scores as ``pyspark.ml`` computes them, a second call that finds all folds done, and a
    reloaded best pipeline that predicts as it did when it was fitted."""
    run = new_folder(spark, "folds")
    scores = _classifier_run(spark, folder, run)
    again = _classifier_run(spark, folder, run)
    rows = spark.read.parquet(f"{run}/rows")
    best = scores.filter("best").first()
    bounds = fold_bounds(rows.count())[best["fold"] - 1]
    predictions = folds.best_model(again).transform(fold_rows(rows, bounds)[1])
    now = _scores(predictions).first()
    judged = [MulticlassClassificationEvaluator(labelCol="label", metricName=name).evaluate(predictions)
              for name in ("weightedPrecision", "weightedRecall")]
    alike = all(abs(a - b) < 1e-9 for a, b in zip(
        (*now, *judged), (*[best[c] for c in now.__fields__], *now[:2])))
    kept = scores.exceptAll(again).isEmpty()
    return scores.select(
        "fold", "n_train", "n_valid", (F.col("tp") + F.col("fn")).alias("positives"),
        F.lit(alike).alias("reloaded_alike"), F.lit(kept).alias("found_again"))


def _merged(spark, folder):
    """Merged training rows for boosted trees and test rows, with vectors fitted on all training rows."""
    train, test = (part.select(*_CATEGORIES, *_NUMBERS, _LABEL) for part in _train_test(spark, folder))
    fitted = features.encoder(_CATEGORIES, _NUMBERS).fit(train)
    merged, test = models.tree_rows(train, test, _CATEGORIES, _NUMBERS, _LABEL)
    return (fitted.transform(merged).select("features", _LABEL, "weight"),
            fitted.transform(spread(test)).select("features", _LABEL))


def gbt_fit(spark, folder):
    train, test = _merged(spark, folder)
    model = models.boosted_trees(_LABEL, seed=1, weightCol="weight").fit(train)
    return metrics.regression_metrics(model.transform(test), _LABEL)


def grid_search(spark, folder):
    train, test = _merged(spark, folder)
    grid = [{"depth": d, "trees": t, "rate": r}
            for d in (4, 6) for t in (150, 200) for r in (0.2, 0.3)]
    return models.grid_scores(
        train, test, grid, lambda **s: models.boosted_trees(_LABEL, seed=1, weightCol="weight", **s),
        models.rmse(_LABEL))


def mlp_fit(spark, folder):
    train, test = (_late(df) for df in _encoded(spark, folder))
    width = len(features.slot_names(train, "features"))
    model = models.perceptron("label", width, (4, 2)).fit(train)
    counts = cut(metrics.confusion(
        model.transform(test), F.col("label").cast("int"), F.col("prediction").cast("int")))
    return metrics.weighted_scores(counts).crossJoin(metrics.binary_scores(counts))


def mlp_shapes(spark, folder):
    """F3 of every hidden layout."""
    train, test = (_late(df) for df in _encoded(spark, folder))
    width = len(features.slot_names(train, "features"))
    train, test = (df.select("features", "label") for df in (train, test))  # all that is kept in memory
    return models.grid_scores(
        train, test, [{"hidden": layout} for layout in models.HIDDEN_LAYERS],
        lambda hidden: models.perceptron("label", width, hidden),
        models.f3_of_positives("label"))


def mlp_areas(spark, folder):
    train, test = (_late(df) for df in _encoded(spark, folder))
    width = len(features.slot_names(train, "features"))
    model = models.perceptron("label", width, (2,)).fit(train)
    return models.area_scores(model.transform(test), "label")


def auc_scores(spark, folder):
    """How well the length of a text separates the quality labels."""
    docs = table(spark, folder, "documents").select("doc_id", "n_chars")
    scored = table(spark, folder, "labels").join(docs, "doc_id").select(
        F.col("quality").cast("double").alias("label"),
        F.col("n_chars").cast("double").alias("score"))
    return rounded(models.area_scores(scored, "label", "score"), "area_roc", "area_pr")


_AREAS_SQL = """
WITH c AS (SELECT n_chars AS s, sum(quality)::DOUBLE AS p, (count(*) - sum(quality))::DOUBLE AS n
  FROM labels JOIN documents USING (doc_id) GROUP BY 1),
t AS (SELECT sum(p) AS pos, sum(n) AS neg FROM c),
u AS (SELECT s, sum(p) OVER w AS tp, sum(n) OVER w AS fp FROM c
  WINDOW w AS (ORDER BY s DESC ROWS UNBOUNDED PRECEDING)),
q AS (SELECT s, tp / pos AS r, fp / neg AS f, tp / (tp + fp) AS pr FROM u, t),
l AS (SELECT *, lag(r, 1, 0.0) OVER w AS r0, lag(f, 1, 0.0) OVER w AS f0,
        coalesce(lag(pr) OVER w, pr) AS pr0 FROM q WINDOW w AS (ORDER BY s DESC))
SELECT round(sum((f - f0) * (r + r0) / 2), 6) AS area_roc,
       round(sum((r - r0) * (pr + pr0) / 2), 6) AS area_pr FROM l"""


QUERIES = {
    "category_index": Query(category_index, """
WITH l AS (SELECT p_brand AS level, count(*) AS n FROM part GROUP BY 1),
i AS (SELECT *, row_number() OVER (ORDER BY n DESC, level) - 1 AS index, count(*) OVER () AS k
  FROM l)
SELECT level, n, index, CASE WHEN index < k - 1 THEN index END AS slot FROM i"""),
    "one_hot_width": Query(one_hot_width, """
SELECT count(DISTINCT p_brand) - 1 AS brand_width, count(DISTINCT p_type) - 1 AS type_width,
       count(*) AS n FROM part"""),
    "one_hot_names": Query(one_hot_names, """
WITH l AS (SELECT p_type AS level, count(*) AS n FROM part GROUP BY 1),
i AS (SELECT *, row_number() OVER (ORDER BY n DESC, level) - 1 AS slot, count(*) OVER () AS k
  FROM l)
SELECT slot, level FROM i WHERE slot < k - 1"""),
    "one_hot_levels": Query(one_hot_levels, """
WITH c AS (SELECT 'text' AS "column", text AS level FROM documents WHERE text IS NOT NULL
    UNION ALL SELECT 'source', source FROM documents WHERE source IS NOT NULL),
l AS (SELECT "column", level, count(*) AS n FROM c GROUP BY 1, 2),
i AS (SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY n DESC, level) - 1 AS index,
        count(*) OVER (PARTITION BY "column") AS k FROM l),
w AS (SELECT count(*) - 1 AS w FROM l WHERE "column" = 'text')
SELECT "column", md5(level) AS level_md5, n, index, CAST(CASE WHEN index < k - 1 THEN
  index + CASE WHEN "column" = 'source' THEN w ELSE 0 END END AS INT) AS slot FROM i, w"""),
    "one_hot_slots": Query(one_hot_slots, """
WITH c AS (SELECT doc_id, 0 AS p, lang AS level FROM documents WHERE lang IS NOT NULL
    UNION ALL SELECT doc_id, 1, text FROM documents WHERE text IS NOT NULL
    UNION ALL SELECT doc_id, 2, source FROM documents WHERE source IS NOT NULL),
l AS (SELECT p, level, row_number() OVER (ORDER BY p, count(*) DESC, level) AS slot FROM c GROUP BY 1, 2),
s AS (SELECT doc_id, string_agg(slot, ',' ORDER BY slot) AS slots FROM c JOIN l USING (p, level) GROUP BY 1)
SELECT doc_id, (SELECT CAST(count(*) + 1 AS INT) FROM l) AS width, concat_ws(',', '0', slots) AS slots
FROM documents LEFT JOIN s USING (doc_id)"""),
    "label_index": Query(label_index, f"""
WITH f AS (SELECT CASE WHEN {_LABEL} > 50000 THEN 'late' ELSE 'on time' END AS flag,
                  count(*) AS n FROM lineitem GROUP BY 1)
SELECT flag, CAST(row_number() OVER (ORDER BY n DESC, flag) - 1 AS DOUBLE) AS label, n FROM f"""),
    "standardise": Query(standardise, "SELECT l_orderkey, l_linenumber, l_partkey, " + ", ".join(
        f"round(({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER (), 6) AS {c}_scaled"
        for c in _NUMBERS) + " FROM lineitem"),
    "standardise_train_fit": Query(standardise_train_fit, f"""
WITH f AS (SELECT avg(l_quantity) AS m, stddev_samp(l_quantity) AS d FROM lineitem
           WHERE l_shipdate <= TIMESTAMP '{_CUTOFF}')
SELECT l_orderkey, l_linenumber, l_partkey, round((l_quantity - m) / d, 6) AS l_quantity_scaled
FROM lineitem, f WHERE l_shipdate > TIMESTAMP '{_CUTOFF}'"""),
    "assemble_vector": Query(assemble_vector, """
SELECT l_orderkey, l_linenumber, l_quantity AS v0, l_discount AS v1, l_tax AS v2 FROM lineitem"""),
    "regression_metrics": Query(regression_metrics, f"""
WITH {_BASELINE_SQL}
SELECT round(sqrt(avg((y - p) * (y - p))), 4) AS rmse, round(avg(abs(y - p)), 4) AS mae,
       round(avg((y - p) * (y - p)), 4) AS mse,
       round(sqrt(avg(pow(ln(1 + y) - ln(1 + greatest(p, 0)), 2))), 4) AS rmsle,
       round(avg(abs((y - p) / nullif(y, 0))), 4) AS mape
FROM s"""),
    "confusion_counts": Query(confusion_counts, f"""
WITH {_JUDGED_SQL} SELECT y AS label, CAST(p AS INT) AS prediction, count(*) AS n
FROM j GROUP BY 1, 2"""),
    "weighted_pr": Query(
        weighted_pr, f"WITH {_JUDGED_SQL}, {_scores_sql('j')} SELECT {_WEIGHTED_COLUMNS} FROM a"),
    "f_beta": Query(
        f_beta, f"WITH {_JUDGED_SQL}, {_scores_sql('j')} SELECT {_BINARY_COLUMNS} FROM z"),
    "always_late_baseline": Query(always_late_baseline, f"""
WITH j AS (SELECT CASE WHEN {_LABEL} > 50000 THEN 1 ELSE 0 END AS y, 1 AS p FROM lineitem),
{_scores_sql('j')} SELECT {_WEIGHTED_COLUMNS}, {_BINARY_COLUMNS} FROM a, z"""),
    "linear_fit": Query(
        linear_fit,
        f"WITH {_FIT_SQL} SELECT round(a, 4) AS slope, round(c, 4) AS intercept FROM f"),
    "linear_summary": Query(linear_summary, f"""
WITH {_FIT_SQL}
SELECT round(avg(abs({_LABEL} - a * l_quantity - c)), 4) AS mae,
       round(sqrt(avg(pow({_LABEL} - a * l_quantity - c, 2))), 4) AS rmse, count(*) AS residuals
FROM lineitem, f WHERE l_shipdate <= TIMESTAMP '{_CUTOFF}'"""),
    "linear_holdout": Query(linear_holdout, _HOLDOUT_SQL),
    "glm_tweedie": Query(glm_tweedie, _HOLDOUT_SQL),
    "glm_tweedie_power": Query(glm_tweedie_power, _SCORES_SQL),
    "glm_tweedie_log": Query(glm_tweedie_log, _SCORES_SQL),
    "lasso_check": Query(lasso_check, _PULLS_SQL),
    "coef_check": Query(coef_check, _PULLS_SQL),
    "linear_cv": Query(linear_cv, f"{_ROLLING_SQL} SELECT fold, metric, best FROM o"),
    "linear_cv_blocked": Query(
        linear_cv_blocked, f"{_BLOCKED_SQL} SELECT fold, metric, best FROM o"),
    "linear_cv_average": Query(linear_cv_average, f"""{_ROLLING_SQL}
SELECT round(avg(m), 4) AS avg_metric, arg_min(fold, m) AS best_fold,
       round(min(m), 4) AS best_metric FROM o"""),
    "auc_scores": Query(auc_scores, _AREAS_SQL),
    "linear_cv_models": Query(linear_cv_models, f"""{_BLOCKED_SQL},
z AS (SELECT fold, count(*) FILTER (WHERE i >= begin AND i < stop) AS n_train,
        count(*) FILTER (WHERE i >= stop AND i <= stop + short) AS n_valid FROM r, b GROUP BY 1)
SELECT fold, n_train, n_valid, round(f.a, 4) AS slope, round(f.c, 3) AS intercept
FROM z JOIN f USING (fold)"""),
    "encoded_cv": Query(encoded_cv),
    "lasso_fit": Query(lasso_fit),
    "coef_topk": Query(coef_topk),
    "without_numbers_fit": Query(without_numbers_fit),
    "kfold_grid": Query(kfold_grid, f"""
WITH r AS (SELECT l_quantity AS x, {_LABEL} AS y, {_FOLD_SQL} AS k FROM lineitem),
g AS (SELECT unnest([{", ".join(map(str, models.REGULARISATION))}])::DOUBLE AS strength),
m AS (SELECT g.k, count(*) AS n, avg(x) AS mx, avg(y) AS my, var_pop(x) AS vx, covar_pop(x, y) AS c,
        stddev_pop(y) AS sy
      FROM (SELECT unnest(range({_FOLDS})) AS k) g JOIN r ON r.k <> g.k GROUP BY 1),
w AS (SELECT k, strength, c / (vx + strength / sy * vx) AS a, mx, my FROM m, g),
s AS (SELECT strength, w.k, sqrt(avg(pow(y - my - a * (x - mx), 2))) AS rmse
      FROM w JOIN r ON r.k = w.k GROUP BY 1, 2)
SELECT strength, round(avg(rmse), 4) AS metric FROM s GROUP BY 1"""),
    "kfold_grid_encoded": Query(kfold_grid_encoded),
    "classifier_cv": Query(classifier_cv),
    "classifier_cv_check": Query(classifier_cv_check, f"""
WITH r AS (SELECT {_LABEL} > 50000 AS late,
             row_number() OVER (ORDER BY {", ".join(_ORDER[:-1])}) AS i FROM lineitem),
n AS (SELECT count(*) AS n FROM r), k AS (SELECT CAST(unnest([1, 2, 3, 4, 5]) AS INT) AS fold)
SELECT fold, fold * n // 6 AS n_train, count(*) AS n_valid, count(*) FILTER (WHERE late) AS positives,
       TRUE AS reloaded_alike, TRUE AS found_again
FROM k, n JOIN r ON i > fold * n // 6 AND i <= fold * n // 6 + n // 6 GROUP BY 1, 2"""),
    "gbt_fit": Query(gbt_fit),
    "grid_search": Query(grid_search),
    "mlp_fit": Query(mlp_fit),
    "mlp_shapes": Query(mlp_shapes),
    "mlp_areas": Query(mlp_areas),
}
