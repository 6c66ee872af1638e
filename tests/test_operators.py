"""Cleaning, profiles, series, splits, metrics and features on small fixtures."""

import random
from datetime import datetime

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tarmac.operators import clean, features, joins, metrics, models, profile, series, splits
from tarmac.sources import schemas, tables


def test_completed_trips(spark):
    rows = [("0.0", "0"), ("1.0", "0"), ("0", "1"), (None, "0"), ("x", "0")]
    df = spark.createDataFrame(rows, "CANCELLED string, DIVERTED string")
    assert clean.keep_completed(df).count() == 1
    status = df.select(clean.status_of(F.col("CANCELLED"), F.col("DIVERTED"))).collect()
    assert [r[0] for r in status] == [
        "completed", "cancelled", "diverted", "completed", "completed"]


def test_conform_counts_rejects(spark):
    schema = schemas.TRIPS
    raw = spark.createDataFrame(
        [tuple("7" if f.name != "FL_DATE" else "2015-01-01" for f in schema.fields),
         tuple("T" for _ in schema.fields)], schemas.as_text(schema))
    typed = schemas.conform(raw, schema)
    assert typed.schema == schema
    counts = {r.column_name: r.rejected for r in schemas.rejects(raw, schema).collect()}
    assert counts["HourlyPrecipitation"] == 1 and counts["FL_DATE"] == 1
    assert counts["ORIGIN"] == 0


def test_strict_null_drop_and_series(spark):
    rows = [("N1", 1, 10.0, 130.0), ("N1", 2, 0.0, 60.0), ("N1", 3, 5.0, 200.0),
            ("N2", 1, 7.0, 90.0)]
    df = spark.createDataFrame(rows, "tail string, o int, delay double, elapsed double")
    start = F.timestamp_seconds(F.col("o") * 36000).cast("timestamp_ntz")
    df = df.withColumns({"dep": start, "arr": start + F.expr("INTERVAL 1 HOUR")})
    got = series.previous_trip_features(
        df, "tail", "dep", "arr", "elapsed", "delay", ["arr", "o"])
    values = {(r.tail, r.o): (r.prev_elapsed, r.prev_delay, r.hours_since_prev, r.has_previous)
              for r in got.collect()}
    assert values == {
        ("N1", 1): (None, 0.0, 0.0, False), ("N1", 2): (130.0, 10.0, 9.0, True),
        ("N1", 3): (60.0, 0.0, 0.0, True), ("N2", 1): (None, 0.0, 0.0, False)}
    assert clean.complete_rows(got).count() == 2
    assert tuple(clean.completeness(got).first()) == (4, 2, 2)


def test_not_a_number_counts_as_missing(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "x double")
    assert clean.complete_rows(df).count() == 1 == df.dropna().count()
    assert tuple(clean.completeness(df).first()) == (3, 1, 2)


def test_column_kinds_and_stacking(spark):
    a = spark.createDataFrame([(1, "x", 2.0)], "i int, s string, d double")
    assert clean.columns_of_kind(a, "categorical") == ["s"]
    assert clean.columns_of_kind(a, "numerical") == ["i", "d"]
    stacked = clean.stack_tables(a.select("i"), a.select("s"))
    assert {tuple(r) for r in stacked.collect()} == {(1, None), (None, "x")}


def test_rates_of_a_key_without_one_status(spark):
    rows = [("a", "cancelled")] * 3 + [("a", "completed")] + [("b", "diverted")]
    df = spark.createDataFrame(rows, "k string, s string")
    rates = {r.key: (r.pct_cancelled, r.pct_diverted) for r in
             profile.status_rates(df, F.col("k"), F.col("s")).collect()}
    assert rates == {"a": (75.0, 0.0), "b": (0.0, 100.0)}


def test_histogram_is_whole(spark):
    df = spark.createDataFrame([(float(i % 17),) for i in range(1000)], "x double")
    bins = profile.histogram(df, "x", 4).collect()
    assert sum(r.n for r in bins) == 1000
    assert sorted(r.bin for r in bins) == [0, 1, 2, 3]
    constant = spark.createDataFrame([(2.0,), (2.0,)], "x double")
    assert [tuple(r) for r in profile.histogram(constant, "x").collect()] == [(0, 2)]


def test_approximate_threshold_within_rank_error(spark):
    df = spark.range(1000).select(F.col("id").cast("double").alias("x"))
    assert 935 <= profile.approximate_threshold(df, "x", 0.95, 0.01).first()[0] <= 965


def test_join_on_both_ends_with_and_without_broadcast(spark):
    rows = spark.createDataFrame([("a", "b"), ("b", "z"), (None, "a")], "o string, d string")
    ranks = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "id string, rank double")
    want = {("a", "b", 1.0, 2.0), ("b", "z", 2.0, None), (None, "a", None, 1.0)}
    for bound in (0, 100):
        got = joins.attach_to_ends(rows, ranks, {"o": "ro", "d": "rd"}, max_rows=bound)
        assert {(r.o, r.d, r.ro, r.rd) for r in got.collect()} == want


def test_fold_bounds():
    rolling = splits.fold_bounds(12, 5, "rolling")
    assert [(f.train_last, f.valid_first, f.valid_last) for f in rolling] == [
        (2, 3, 4), (4, 5, 6), (6, 7, 8), (8, 9, 10), (10, 11, 12)]
    blocked = splits.fold_bounds(60, 5, "blocked")
    assert blocked[1] == splits.Fold(2, 10, 19, 20, 23)
    full = splits.fold_bounds(12, 5, "blocked_full")
    assert full[1] == splits.Fold(2, 4, 4, 5, 6)
    assert splits.fold_bounds(10, 2)[-1].valid_last == 9
    with pytest.raises(ValueError):
        splits.fold_bounds(10, 2, "other")


def test_split_sample_and_downsample(spark):
    df = spark.range(10000).withColumn("x", F.col("id") % 2)
    parts = splits.with_split(df, F.col("id"), {"a": 1, "b": 99})
    counts = {r.part: r["count"] for r in parts.groupBy("part").count().collect()}
    assert sum(counts.values()) == 10000 and counts["a"] == pytest.approx(100, abs=35)
    kept = splits.downsample(df, F.col("x") < 1, F.col("id"), 0.2)
    assert kept.filter("x = 1").count() == 5000
    assert kept.filter("x = 0").count() == pytest.approx(1000, rel=0.15)
    first = splits.sample_rows(df.repartition(3), 10, "id").collect()
    assert first == splits.sample_rows(df.repartition(7), 10, "id").collect()


def test_metrics(spark):
    df = spark.createDataFrame(
        [(0.0, 0.0), (10.0, 10.0), (20.0, 26.0)], "y double, prediction double")
    row = metrics.regression_metrics(df, "y").first()
    assert row.mae == 2 and row.rmse == pytest.approx(3.464102, abs=1e-6)
    negative = spark.createDataFrame([(0.0, -5.0)], "y double, prediction double")
    assert metrics.regression_metrics(negative, "y").first().rmsle == 0


def test_class_scores_of_a_constant_guess(spark):
    df = spark.createDataFrame([(1, 1)] * 2 + [(0, 1)] * 8, "y int, p int")
    counts = metrics.confusion(df, F.col("y"), F.col("p"))
    weighted = metrics.weighted_scores(counts).first()
    assert weighted.weighted_precision == pytest.approx(0.04)
    assert weighted.weighted_recall == pytest.approx(0.2)
    assert weighted.f_beta_weighted == pytest.approx(0.142857, abs=1e-6)
    binary = metrics.binary_scores(counts).first()
    assert binary.f_beta_binary == pytest.approx(0.714286, abs=1e-6)
    assert (binary.tp, binary.fp, binary.fn, binary.tn) == (2, 8, 0, 0)


def test_mean_baseline_uses_the_training_mean(spark):
    train = spark.createDataFrame([(2.0,), (4.0,)], "y double")
    test = spark.createDataFrame([(100.0,)], "y double")
    assert metrics.mean_baseline(train, test, "y").first().prediction == 3.0


def test_category_index_and_encoder(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("b", 3.0), ("c", 4.0)],
                               "k string, x double")
    index = {r.level: (r["index"], r.slot) for r in features.category_index(df, "k").collect()}
    assert index == {"b": (0, 0), "a": (1, 1), "c": (2, None)}
    encoded = features.encoder(["k"], ["x"], unseen="error").fit(df).transform(df)
    assert features.slot_names(encoded, "k_onehot") == ["b", "a"]
    assert features.slot_names(encoded, "features") == ["scaled_0", "k_onehot_b", "k_onehot_a"]
    scaled = sorted(r.scaled[0] for r in encoded.collect())
    assert scaled == pytest.approx([-1.1619, -0.3873, 0.3873, 1.1619], abs=1e-4)
    own = sorted(r.x_scaled for r in features.standardise(df, ["x"]).collect())
    assert own == pytest.approx(scaled)
    fewer = features.without_slots(encoded, "features", ["scaled_0"], "kept")
    assert features.slot_names(fewer, "kept") == ["k_onehot_b", "k_onehot_a"]


def test_constant_columns_and_empty_tables(spark):
    same = spark.createDataFrame([(2.0,), (2.0,)], "x double")
    assert [r.x_scaled for r in features.standardise(same, ["x"]).collect()] == [0.0, 0.0]
    empty = same.limit(0)
    assert [tuple(r) for r in profile.null_profile(empty).collect()] == [("x", 0, None)]
    assert profile.summary(empty, "x").first().n == 0


def test_unseen_level_keeps_empty_slots(spark):
    train = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "k string, x double")
    new = spark.createDataFrame([("z", 1.0)], "k string, x double")
    row = features.encoder(["k"], ["x"]).fit(train).transform(new).first()
    assert list(row.k_onehot.toArray()) == [0.0, 0.0]


@pytest.fixture(scope="module")
def line(spark):
    rng = random.Random(5)
    rows = [(i, float(i % 10), 3.0 * (i % 10) + 1 + rng.random() / 10) for i in range(240)]
    df = spark.createDataFrame(rows, "i int, x double, y double")
    return VectorAssembler(inputCols=["x"], outputCol="features").transform(df)


def test_fold_scores_flag_the_lowest_error(line):
    scores = models.fold_scores(line, ["i"], models.linear("y"), models.rmse("y"), 3)
    rows = scores.collect()
    assert [r.fold for r in rows] == [1, 2, 3]
    best = [r for r in rows if r.best]
    assert len(best) == 1 and best[0].metric == min(r.metric for r in rows)
    average = models.fold_average(scores).first()
    assert average.best_fold == best[0].fold
    assert average.best_metric == best[0].metric


def test_linear_model_and_coefficients(line):
    model = models.linear("y").fit(line)
    assert model.coefficients[0] == pytest.approx(3, abs=0.01)
    summary = models.training_summary(model, line).first()
    assert summary.residuals == 240 and summary.rmse < 0.1
    table = models.coefficient_table(["a", "b", "c"], [-3.0, 1.0, 2.0], line)
    top = models.extreme_coefficients(table, 1).collect()
    assert [(r.feature, r.end) for r in top] == [("a", "top"), ("b", "bottom")]
    signed = models.extreme_coefficients(table, 1, "coefficient").collect()
    assert [r.feature for r in signed] == ["c", "a"]


def test_grids_and_other_estimators(line):
    train, valid = line.filter("i < 160"), line.filter("i >= 160")
    grid = [{"depth": 1, "trees": 1}, {"depth": 4, "trees": 5}]
    scores = models.grid_scores(
        train, valid, grid, lambda **s: models.boosted_trees("y", seed=1, **s), models.rmse("y"))
    assert [r.best for r in scores.collect()] == [False, True]
    lasso = models.lasso("y", 100.0).fit(train)
    assert lasso.coefficients[0] == 0
    tweedie = models.tweedie("y").fit(train)
    assert tweedie.coefficients[0] == pytest.approx(3, abs=0.01)


def test_perceptron_and_areas(line):
    labelled = line.withColumn("label", (F.col("x") > 4).cast("double"))
    model = models.perceptron("label", 1, (2,), iterations=60).fit(labelled)
    areas = models.area_scores(model.transform(labelled), "label").first()
    assert areas.area_roc > 0.95 and areas.area_pr > 0.95


def test_files_round_trip(spark, tmp_path):
    schema = schemas.T.StructType([
        schemas.T.StructField("k", schemas.T.StringType()),
        schemas.T.StructField("x", schemas.T.DoubleType()),
        schemas.T.StructField("t", schemas.T.TimestampNTZType())])
    df = tables.local_rows(
        spark, [("a", 1.5, datetime(2015, 1, 1)), ("b", None, datetime(2016, 1, 1))], schema)
    raw, typed = str(tmp_path / "raw"), str(tmp_path / "typed")
    df.write.option("compression", "gzip").csv(raw, header=True, sep="|")
    back = schemas.conform(tables.read_csv(spark, [raw], schema, "|", spread=3), schema)
    assert back.rdd.getNumPartitions() == 3
    assert sorted(back.collect()) == sorted(df.collect())
    df.write.csv(str(tmp_path / "plain"), header=True)
    tables.csv_to_parquet(spark, str(tmp_path / "plain"), typed, schema, ["k"])
    stored = tables.read_parquet(spark, typed)
    assert tuple(tables.content_check(stored, "t").first()) == (2, datetime(2016, 1, 1))
    assert tuple(tables.table_size(stored).first()) == (2, 3)
    wide = df.select(F.lit("more").alias("z"), "t", "x", "k")
    wide.write.csv(str(tmp_path / "wide"), header=True)
    named = tables.read_csv(spark, str(tmp_path / "wide"), schema)
    assert sorted(schemas.conform(named, schema).collect()) == sorted(df.collect())
    wide.drop("x").write.csv(str(tmp_path / "short"), header=True)
    with pytest.raises(ValueError, match="no column x"):
        tables.read_csv(spark, str(tmp_path / "short"), schema)
    tables.write_lines(df, "k", str(tmp_path / "text"))
    assert {r.value for r in tables.read_lines(spark, str(tmp_path / "text")).collect()} == {
        "a", "b"}
