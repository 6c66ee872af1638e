"""Queries over the rows of one entity in order."""

from __future__ import annotations

from pyspark.sql import functions as F

from tarmac.operators.ordered import number_rows, previous_values
from tarmac.operators.series import previous_trip_features
from tarmac.plans.common import Query, rounded, table


def _journeys(spark, folder):
    """Events as trips of a user: the value is the delay, and twice the value the duration."""
    events = table(spark, folder, "events")
    return events.select(
        "event_id", "user_id", F.col("ts").alias("dep"),
        F.timestamp_seconds(
            F.unix_seconds(F.col("ts").cast("timestamp")) + F.floor(F.col("value") * 60)
        ).cast("timestamp_ntz").alias("arr"),
        (F.col("value") * 2).alias("elapsed"), F.col("value").alias("delay"),
    )


_JOURNEYS_SQL = """
  SELECT event_id, user_id, ts AS dep,
         date_trunc('second', ts) + INTERVAL 1 SECOND * CAST(floor(value * 60) AS BIGINT) AS arr,
         value * 2 AS elapsed, value AS delay
  FROM events"""


def prev_value(spark, folder):
    return previous_values(
        table(spark, folder, "events").select("event_id", "user_id", "ts", "value"),
        ["user_id"], ["ts", "event_id"], {"prev_ts": "ts", "prev_value": "value"},
    )


def _waiting(spark, folder, shortest):
    featured = previous_trip_features(
        _journeys(spark, folder), "user_id", "dep", "arr", "elapsed", "delay",
        ["arr", "event_id"], shortest,
    )
    return rounded(
        featured.select("event_id", "prev_end", "prev_elapsed", "hours_since_prev", "prev_delay",
                        "has_previous"),
        "hours_since_prev",
    )


def hours_since_prev(spark, folder):
    return _waiting(spark, folder, 120)


def hours_since_any_prev(spark, folder):
    return _waiting(spark, folder, None)


def _waiting_sql(rule):
    return f"""
WITH j AS ({_JOURNEYS_SQL}),
p AS (SELECT *, lag(arr) OVER w AS prev_end, lag(elapsed) OVER w AS prev_elapsed,
        lag(delay) OVER w AS d, lag(event_id) OVER w IS NOT NULL AS has_previous
      FROM j WINDOW w AS (PARTITION BY user_id ORDER BY arr, event_id))
SELECT event_id, prev_end, prev_elapsed, has_previous, coalesce(d, 0.0) AS prev_delay,
       round(coalesce(CASE WHEN {rule} THEN
         (epoch(date_trunc('second', dep)) - epoch(prev_end)) / 3600.0::DOUBLE END, 0.0), 6)
         AS hours_since_prev
FROM p"""


def global_row_number(spark, folder):
    events = table(spark, folder, "events").select(
        "event_id", F.to_date("ts").alias("day"), "value")
    return number_rows(events, ["day", "event_id"])


QUERIES = {
    "prev_value": Query(prev_value, """
SELECT event_id, user_id, ts, value, lag(ts) OVER w AS prev_ts, lag(value) OVER w AS prev_value
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)"""),
    "hours_since_prev": Query(hours_since_prev, _waiting_sql("prev_elapsed >= 120")),
    "hours_since_any_prev": Query(hours_since_any_prev, _waiting_sql("TRUE")),
    "global_row_number": Query(global_row_number, """
SELECT event_id, CAST(ts AS DATE) AS day, value,
       row_number() OVER (ORDER BY CAST(ts AS DATE), event_id) AS row_num FROM events"""),
}
