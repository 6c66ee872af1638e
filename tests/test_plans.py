"""Properties of physical plans that matter on large data."""

import pytest
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from tarmac.operators import clean, models, ordered, profile
from tarmac.plans import learning
from tarmac.plans.common import table
from tarmac.session import cut_by, spread

FOLDER = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_stored_rows_join_without_a_shuffle_or_sort(spark):
    stored = cut_by(spark.range(1000).withColumn("s", F.col("id") % 3), "id", "s")
    other = spark.range(1000).withColumn("s", F.col("id") % 3).hint("merge")
    plan = _plan(stored.join(other, ["id", "s"]))
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Sort [") == 1
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"


def test_null_tests_and_columns_reach_the_scan(spark):
    lines = table(spark, FOLDER, "lineitem")
    for df in (
        profile.averages_by(lines, "l_returnflag", ["l_tax"]),
        clean.complete_rows(lines.select("l_returnflag", "l_tax"), ["l_returnflag"]),
    ):
        plan = _plan(df)
        assert "PushedFilters: [IsNotNull(l_returnflag)]" in plan
        assert "ReadSchema: struct<l_tax:double,l_returnflag:string>" in plan


def test_profiles_read_their_table_once(spark):
    events = table(spark, FOLDER, "events")
    rates = profile.status_rates(events, F.hour("ts"), F.col("event_type"))
    for df in (profile.null_profile(events), rates):
        assert _plan(df).count("FileScan") == 1
    # moments leave the plan at a shuffle of matrices, so the lineage tells what is read
    pairs = profile.correlation_table(events, ["value", "user_id", "event_id"])
    assert pairs._jdf.queryExecution().toRdd().toDebugString().count("FileScanRDD") == 1


def test_deduplication_aggregates_before_the_shuffle(spark):
    plan = _plan(ordered.first_per_key(table(spark, FOLDER, "events"), ["user_id"], ["ts"]))
    assert plan.index("Exchange") < plan.index("partial_min_by")


def test_spread_only_where_partitions_are_few(spark, tmp_path):
    many = spark.range(0, 100, 1, 16)
    assert spread(many) is many
    one = str(tmp_path / "one")
    spark.range(100).coalesce(1).write.parquet(one)
    assert spread(spark.read.parquet(one)).rdd.getNumPartitions() == 8


def test_learning_queries_fit_the_full_models(spark, monkeypatch):
    class Stop(Exception):
        pass

    seen = []

    def stop(estimator, *_):
        seen.append({p.name: v for p, v in estimator.extractParamMap().items()})
        raise Stop

    def each(train, valid, grid, build, evaluator):
        for setting in grid:
            with pytest.raises(Stop):
                build(**setting).fit(train)
        raise Stop

    monkeypatch.setattr(models, "grid_scores", each)
    monkeypatch.setattr(GBTRegressor, "_fit", stop)
    monkeypatch.setattr(MultilayerPerceptronClassifier, "_fit", stop)
    found = {}
    for name in ("gbt_fit", "grid_search", "mlp_fit", "mlp_shapes", "mlp_areas"):
        seen.clear()
        with pytest.raises(Stop):
            getattr(learning, name)(spark, "/root/testdata/sf0.001")
        found[name] = list(seen)
    trees = {n: {(x["maxDepth"], x["maxIter"], x["stepSize"]) for x in found[n]} for n in ("gbt_fit", "grid_search")}
    assert trees["gbt_fit"] == {(6, 150, 0.2)}
    assert trees["grid_search"] == {(d, t, r) for d in (4, 6) for t in (150, 200) for r in (0.2, 0.3)}
    assert all(x["maxIter"] == 100 for n in found if n.startswith("mlp") for x in found[n])
