"""Samples and folds."""

from __future__ import annotations

from pyspark.sql import functions as F

from tarmac.operators import splits
from tarmac.operators.ordered import number_rows
from tarmac.plans.common import Query, rounded, table


def _folds(spark, folder, scheme):
    events = table(spark, folder, "events").select("event_id", "ts")
    numbered = number_rows(events, ["ts", "event_id"])
    bounds = splits.fold_bounds(events.count(), 5, scheme)
    return splits.fold_summary(numbered, bounds, "ts")


def rolling_folds(spark, folder):
    return _folds(spark, folder, "rolling")


def blocked_folds(spark, folder):
    return _folds(spark, folder, "blocked")


def blocked_full_folds(spark, folder):
    return _folds(spark, folder, "blocked_full")


def _folds_sql(train, valid):
    return f"""
WITH r AS (SELECT ts, row_number() OVER (ORDER BY ts, event_id) AS i FROM events),
k AS (SELECT CAST(unnest([1, 2, 3, 4, 5]) AS INT) AS fold),
n AS (SELECT count(*) AS n FROM r),
b AS (SELECT fold, n, (fold - 1) * n // 6 AS begin, fold * n // 6 AS stop, n // 6 AS size,
        3 * n // 60 AS short FROM k, n)
SELECT fold, count(*) FILTER (WHERE {train}) AS train_rows,
       min(ts) FILTER (WHERE {train}) AS train_from, max(ts) FILTER (WHERE {train}) AS train_to,
       count(*) FILTER (WHERE {valid}) AS valid_rows,
       min(ts) FILTER (WHERE {valid}) AS valid_from, max(ts) FILTER (WHERE {valid}) AS valid_to
FROM r, b GROUP BY fold"""


def random_split_counts(spark, folder):
    events = table(spark, folder, "events")
    parts = splits.with_split(events, F.col("event_id"), {"test": 0.2, "train": 0.8}, 42)
    return rounded(
        parts.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")),
        "total", digits=2)


def hash_downsample(spark, folder):
    events = table(spark, folder, "events")
    kept = splits.downsample(events, F.col("value") < 15, F.col("event_id"), 0.2, 123)
    return kept.select("event_id", "value")


def sample_n(spark, folder):
    return splits.sample_rows(table(spark, folder, "orders"), 100, "o_orderkey", 7)


def _unit_sql(key, seed):
    digits = f"substr(md5('{seed}:' || {key}), 1, 8)"
    return f"CAST(CAST('0x' || {digits} AS BIGINT) AS DOUBLE) / 4294967296.0"


QUERIES = {
    "rolling_folds": Query(
        rolling_folds, _folds_sql("i <= stop", "i > stop AND i <= stop + size")),
    "blocked_folds": Query(
        blocked_folds,
        _folds_sql("i >= begin AND i < stop", "i >= stop AND i <= stop + short")),
    "blocked_full_folds": Query(
        blocked_full_folds,
        _folds_sql("i > begin + CASE WHEN fold > 1 THEN 1 ELSE 0 END AND i <= stop",
                   "i > stop AND i <= stop + size")),
    "random_split_counts": Query(random_split_counts, f"""
SELECT CASE WHEN {_unit_sql("event_id", 42)} < 0.2 THEN 'test' ELSE 'train' END AS part,
       count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1"""),
    "hash_downsample": Query(hash_downsample, f"""
SELECT event_id, value FROM events
WHERE value >= 15 OR {_unit_sql("event_id", 123)} < 0.2"""),
    "sample_n": Query(sample_n, f"""
SELECT * FROM orders ORDER BY {_unit_sql("o_orderkey", 7)}, o_orderkey LIMIT 100"""),
}
