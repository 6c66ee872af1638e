"""Averages, rates and profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from tarmac.functions.numbers import over_threshold
from tarmac.functions.times import WEEKDAYS, hour_of_hhmm, label_of, nearest_hundred
from tarmac.operators import profile
from tarmac.operators.clean import status_of
from tarmac.operators.ordered import exact_percentiles
from tarmac.plans.common import (
    GAPPY_SQL, SHIPMENTS_SQL, Query, gappy_events, rounded, shipments, table,
)
from tarmac.session import stage
from tarmac.sources.tables import table_size


def _dated(spark, folder):
    return table(spark, folder, "events").withColumn("day", F.to_date("ts"))


def avg_measure_by_key(spark, folder):
    return rounded(profile.averages_by(_dated(spark, folder), "day", ["value"]), "avg_value")


def avg_by_each_key(spark, folder):
    events = _dated(spark, folder).withColumns({
        "dom": F.dayofmonth("ts"), "dow": F.weekday("ts") + 1, "month": F.month("ts"),
        "year": F.year("ts"), "hour": F.hour("ts"),
    })
    keys = ["day", "dom", "dow", "month", "year", "hour", "event_type", "user_id"]
    return rounded(profile.averages_for_each(events, keys, "value"), "avg_value")


def smoothed_avg_by_date(spark, folder):
    return rounded(
        profile.smoothed_averages(_dated(spark, folder), "day", "value", 5),
        "avg_value", "moving_avg",
    )


def smoothed_avg_by_measure(spark, folder):
    rows = shipments(spark, folder).withColumn("delay", F.datediff("l_shipdate", "o_orderdate"))
    smoothed = profile.smoothed_averages(
        rows, "l_extendedprice", "delay", 100, F.col("o_orderstatus") != "F"
    )
    return rounded(smoothed, "avg_delay", "moving_avg")


def topk_keys_by_avg(spark, folder):
    events = table(spark, folder, "events")
    return rounded(profile.highest_averages(events, "user_id", "value", 10), "avg_value")


def multi_avg_by_key(spark, folder):
    measures = ["l_quantity", "l_extendedprice", "l_discount"]
    averages = profile.averages_by(
        table(spark, folder, "lineitem"), ["l_returnflag", "l_linestatus"], measures
    )
    return rounded(averages, *[f"avg_{m}" for m in measures]).orderBy("avg_l_quantity")


def avg_by_numeric_text(spark, folder):
    averages = profile.averages_by(table(spark, folder, "part"), "p_brand", ["p_retailprice"])
    return rounded(
        profile.by_numeric_text(averages, "p_brand"), "avg_p_retailprice", "sort_key"
    )


def avg_by_weekday_label(spark, folder):
    events = table(spark, folder, "events").withColumn("dow", (F.weekday("ts") + 1).cast("int"))
    averages = rounded(profile.averages_by(events, "dow", ["value"]), "avg_value")
    return averages.withColumn("weekday", label_of(F.col("dow"), WEEKDAYS)).orderBy("dow")


def count_by_key(spark, folder):
    return profile.counts_by(table(spark, folder, "orders"), ["o_orderstatus", "o_orderpriority"])


def null_profile(spark, folder):
    return rounded(profile.null_profile(gappy_events(spark, folder)), "pct_null")


def low_null_columns(spark, folder):
    return rounded(profile.mostly_filled(gappy_events(spark, folder), 10), "pct_null")


_NULLS_SQL = f"""
WITH g AS ({GAPPY_SQL}),
n AS (SELECT count(*) AS rows, count(*) - count(event_id) AS c1, count(*) - count(ts) AS c2,
        count(*) - count(user_id) AS c3, count(*) - count(event_type) AS c4,
        count(*) - count(value) AS c5, count(*) - count(props) AS c6 FROM g),
p AS (SELECT 'event_id' AS column_name, c1 AS nulls, rows FROM n
  UNION ALL SELECT 'ts', c2, rows FROM n UNION ALL SELECT 'user_id', c3, rows FROM n
  UNION ALL SELECT 'event_type', c4, rows FROM n UNION ALL SELECT 'value', c5, rows FROM n
  UNION ALL SELECT 'props', c6, rows FROM n)
SELECT column_name, nulls, round(nulls * 100.0::DOUBLE / rows, 6) AS pct_null FROM p"""


def summary_stats(spark, folder):
    events = table(spark, folder, "events")
    return rounded(
        profile.summary(events, "value"), "mean", "stddev", "min", "max", "p25", "p50", "p75"
    )


def summary_by_flag(spark, folder):
    events = table(spark, folder, "events").withColumn("flag", F.col("event_type") == "error")
    stats = profile.summary(events, "value", ["flag"])
    return rounded(stats, "mean", "stddev", "min", "max", "p25", "p50", "p75")


def box_stats(spark, folder):
    stats = profile.box_stats(table(spark, folder, "events"), "value", ["event_type"])
    return rounded(stats, "min", "p25", "p50", "p75", "max")


def exact_percentile_table(spark, folder):
    wanted = {"p01": 0.01, "p50": 0.5, "p95": 0.95, "p99": 0.99}
    lines = table(spark, folder, "lineitem")
    return rounded(
        exact_percentiles(lines, "l_extendedprice", wanted, ["l_returnflag"]), *wanted
    )


def approx_threshold(spark, folder):
    return profile.approximate_threshold(table(spark, folder, "events"), "value", 0.95, 0.01)


_FRACTIONS = [0.05, 0.25, 0.5, 0.75, 0.95, 0.99]


def approx_threshold_check(spark, folder):
    """The exact ranks of the approximate threshold lie within 1 % of the wanted one."""
    events = table(spark, folder, "events")
    found = approx_threshold(spark, folder).select(
        F.lit(0.95).alias("fraction"), F.col("threshold").alias("value"))
    errors = profile.rank_errors(events, "value", found)
    return errors.select("fraction", "n", (F.round("error", 9) <= 0.01).alias("within"))


def _daily_sketches(spark, folder):
    """A sketch per day and type of event, stored as a table of its own."""
    events = table(spark, folder, "events").withColumn("day", F.to_date("ts"))
    return events, stage(profile.quantile_sketches(events, "value", ["day", "event_type"]))


def sketch_quantiles(spark, folder):
    """Quantiles by type from the sketches of all days, and how exact they are."""
    events, sketches = _daily_sketches(spark, folder)
    found = stage(profile.quantiles_of_sketches(sketches, _FRACTIONS, ["event_type"]))
    errors = profile.rank_errors(events, "value", found, ["event_type"])
    return errors.select("event_type", "fraction", "n", (F.round("error", 9) <= 0.01).alias("within"))


def sketch_quantiles_of_days(spark, folder):
    """The same sketches merged by day."""
    events, sketches = _daily_sketches(spark, folder)
    found = stage(profile.quantiles_of_sketches(sketches, _FRACTIONS, ["day"]))
    errors = profile.rank_errors(events, "value", found, ["day"])
    return errors.select("day", "fraction", "n", (F.round("error", 9) <= 0.01).alias("within"))


def corr_pair(spark, folder):
    lines = table(spark, folder, "lineitem")
    return rounded(profile.correlation(lines, "l_quantity", "l_extendedprice"), "correlation")


_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def correlation_table(spark, folder):
    lines = table(spark, folder, "lineitem")
    return rounded(profile.correlation_table(lines, _NUMBERS), "correlation")


_CORR_SQL = "\nUNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS correlation FROM lineitem"
    for i, a in enumerate(_NUMBERS) for b in _NUMBERS[i + 1:]
)


def histogram_bins(spark, folder):
    return profile.histogram(table(spark, folder, "events"), "value", 50)


def table_metadata(spark, folder):
    return table_size(table(spark, folder, "lineitem"))


def measure_extremes(spark, folder):
    return table(spark, folder, "events").agg(
        F.max("ts").alias("latest"), F.greatest(F.max("user_id"), F.max("event_id")).alias("top"),
        F.round(F.avg("value"), 6).alias("mean"),
    )


def _order_rates(spark, folder, key):
    orders = table(spark, folder, "orders")
    status = status_of(
        (F.col("o_orderstatus") == "F").cast("int"), (F.col("o_orderstatus") == "P").cast("int")
    )
    return rounded(
        profile.status_rates(orders, key, status), "pct_cancelled", "pct_diverted"
    )


def status_rates_by_dow(spark, folder):
    return _order_rates(spark, folder, (F.weekday("o_orderdate") + 1).cast("int"))


def status_rates_by_month(spark, folder):
    return _order_rates(spark, folder, F.month("o_orderdate"))


def status_rates_by_dom(spark, folder):
    return _order_rates(spark, folder, F.dayofmonth("o_orderdate"))


def _order_rates_sql(key):
    return f"""
SELECT CAST({key} AS INT) AS key, count(*) AS total,
       round(count(*) FILTER (WHERE o_orderstatus = 'F') * 100.0::DOUBLE / count(*), 6)
         AS pct_cancelled,
       round(count(*) FILTER (WHERE o_orderstatus = 'P') * 100.0::DOUBLE / count(*), 6)
         AS pct_diverted
FROM orders GROUP BY 1"""


def _clock_events(spark, folder):
    return table(spark, folder, "events").select(
        (F.hour("ts") * 100 + F.minute("ts")).cast("string").alias("hhmm"),
        status_of(
            (F.col("event_type") == "error").cast("int"),
            (F.col("event_type") == "signup").cast("int"),
        ).alias("status"),
    )


def status_rates_by_hour(spark, folder):
    events = _clock_events(spark, folder)
    return rounded(
        profile.status_rates(events, hour_of_hhmm(F.col("hhmm")), F.col("status")),
        "pct_cancelled", "pct_diverted",
    )


def rates_by_rounded_time(spark, folder):
    events = _clock_events(spark, folder)
    by_time = profile.status_rates(events, F.col("hhmm"), F.col("status"), "hhmm")
    return rounded(
        by_time.withColumn("hour", nearest_hundred(F.col("hhmm"))), "pct_cancelled", "pct_diverted"
    )


_CLOCK_SQL = """
WITH e AS (SELECT CAST(hour(ts) * 100 + minute(ts) AS INT) AS t, event_type FROM events)
SELECT {key}, count(*) AS total,
       round(count(*) FILTER (WHERE event_type = 'error') * 100.0::DOUBLE / count(*), 6)
         AS pct_cancelled,
       round(count(*) FILTER (WHERE event_type = 'signup') * 100.0::DOUBLE / count(*), 6)
         AS pct_diverted
FROM e GROUP BY {group}"""


def rate_boxes_by_hour(spark, folder):
    """Spread, within every hour, of the cancellation rates of its single minutes."""
    by_time = profile.status_rates(
        _clock_events(spark, folder), F.col("hhmm"), F.col("status"), "hhmm")
    by_hour = by_time.withColumn("hour", hour_of_hhmm(F.col("hhmm")))
    stats = profile.box_stats(by_hour, "pct_cancelled", ["hour"])
    return rounded(stats, "min", "p25", "p50", "p75", "max")


def share_over_threshold(spark, folder):
    events = table(spark, folder, "events")
    return events.select("event_type", over_threshold(F.col("value")).alias("late")).groupBy(
        "event_type"
    ).agg(F.round(F.avg("late"), 6).alias("late_share"))


_SUMMARY_SQL = """count(value) AS n, round(avg(value), 6) AS mean,
       round(stddev_samp(value), 6) AS stddev, round(min(value), 6) AS min,
       round(max(value), 6) AS max, round(quantile_cont(value, 0.25), 6) AS p25,
       round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.75), 6) AS p75"""

QUERIES = {
    "avg_measure_by_key": Query(avg_measure_by_key, """
SELECT CAST(ts AS DATE) AS day, round(avg(value), 6) AS avg_value FROM events GROUP BY 1"""),
    "avg_by_each_key": Query(avg_by_each_key, "\nUNION ALL ".join(
        f"SELECT '{name}' AS key, CAST({key} AS VARCHAR) AS value, "
        "round(avg(value), 6) AS avg_value, count(*) AS n FROM events GROUP BY 2"
        for name, key in [
            ("day", "CAST(ts AS DATE)"), ("dom", "day(ts)"), ("dow", "isodow(ts)"),
            ("month", "month(ts)"), ("year", "year(ts)"), ("hour", "hour(ts)"),
            ("event_type", "event_type"), ("user_id", "user_id"),
        ]
    )),
    "smoothed_avg_by_date": Query(smoothed_avg_by_date, """
WITH a AS (SELECT CAST(ts AS DATE) AS day, avg(value) AS v FROM events GROUP BY 1)
SELECT day, round(v, 6) AS avg_value,
       CASE WHEN count(*) OVER w = 5 THEN round(avg(v) OVER w, 6) END AS moving_avg
FROM a WINDOW w AS (ORDER BY day ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)"""),
    "smoothed_avg_by_measure": Query(smoothed_avg_by_measure, f"""
WITH t AS ({SHIPMENTS_SQL}),
a AS (SELECT l_extendedprice,
        avg(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE))) AS v
      FROM t WHERE o_orderstatus <> 'F' GROUP BY 1)
SELECT l_extendedprice, round(v, 6) AS avg_delay,
       CASE WHEN count(*) OVER w = 100 THEN round(avg(v) OVER w, 6) END AS moving_avg
FROM a WINDOW w AS (ORDER BY l_extendedprice ROWS BETWEEN 99 PRECEDING AND CURRENT ROW)"""),
    "topk_keys_by_avg": Query(topk_keys_by_avg, """
SELECT user_id, round(avg(value), 6) AS avg_value FROM events GROUP BY 1
ORDER BY avg(value) DESC, user_id LIMIT 10"""),
    "multi_avg_by_key": Query(multi_avg_by_key, """
SELECT l_returnflag, l_linestatus, round(avg(l_quantity), 6) AS avg_l_quantity,
       round(avg(l_extendedprice), 6) AS avg_l_extendedprice,
       round(avg(l_discount), 6) AS avg_l_discount
FROM lineitem GROUP BY 1, 2"""),
    "avg_by_numeric_text": Query(avg_by_numeric_text, """
SELECT p_brand, round(avg(p_retailprice), 6) AS avg_p_retailprice,
       CAST(regexp_replace(p_brand, '[^0-9.]', '', 'g') AS DOUBLE) AS sort_key
FROM part GROUP BY p_brand"""),
    "avg_by_weekday_label": Query(avg_by_weekday_label, """
SELECT CAST(isodow(ts) AS INT) AS dow, round(avg(value), 6) AS avg_value, dayname(ts) AS weekday
FROM events GROUP BY 1, 3"""),
    "count_by_key": Query(count_by_key, """
SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2"""),
    "null_profile": Query(null_profile, _NULLS_SQL),
    "low_null_columns": Query(
        low_null_columns, f"SELECT * FROM ({_NULLS_SQL}) WHERE pct_null < 10"
    ),
    "summary_stats": Query(summary_stats, f"SELECT {_SUMMARY_SQL} FROM events"),
    "summary_by_flag": Query(summary_by_flag, f"""
SELECT event_type = 'error' AS flag, {_SUMMARY_SQL} FROM events GROUP BY 1"""),
    "box_stats": Query(box_stats, """
SELECT event_type, round(min(value), 6) AS min, round(quantile_cont(value, 0.25), 6) AS p25,
       round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.75), 6) AS p75,
       round(max(value), 6) AS max
FROM events GROUP BY 1"""),
    "exact_percentile_table": Query(exact_percentile_table, """
SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.01), 6) AS p01,
       round(quantile_cont(l_extendedprice, 0.5), 6) AS p50,
       round(quantile_cont(l_extendedprice, 0.95), 6) AS p95,
       round(quantile_cont(l_extendedprice, 0.99), 6) AS p99
FROM lineitem GROUP BY 1"""),
    "approx_threshold": Query(approx_threshold),
    "approx_threshold_check": Query(approx_threshold_check, """
SELECT 0.95::DOUBLE AS fraction, count(value) AS n, TRUE AS within FROM events"""),
    "sketch_quantiles": Query(sketch_quantiles, f"""
SELECT event_type, f.fraction, count(value) AS n, TRUE AS within
FROM events, (SELECT unnest({_FRACTIONS})::DOUBLE AS fraction) f WHERE value IS NOT NULL GROUP BY 1, 2"""),
    "sketch_quantiles_of_days": Query(sketch_quantiles_of_days, f"""
SELECT CAST(ts AS DATE) AS day, f.fraction, count(value) AS n, TRUE AS within
FROM events, (SELECT unnest({_FRACTIONS})::DOUBLE AS fraction) f WHERE value IS NOT NULL GROUP BY 1, 2"""),
    "corr_pair": Query(corr_pair, """
SELECT round(corr(l_quantity, l_extendedprice), 6) AS correlation FROM lineitem"""),
    "correlation_table": Query(correlation_table, _CORR_SQL),
    "histogram_bins": Query(histogram_bins, """
WITH s AS (SELECT min(value) AS lo, max(value) AS hi FROM events)
SELECT CAST(least(floor((value - lo) / ((hi - lo) / 50)), 49) AS INT) AS bin, count(*) AS n
FROM events, s GROUP BY 1"""),
    "table_metadata": Query(table_metadata, """
SELECT count(*) AS n_rows, CAST(11 AS BIGINT) AS n_columns FROM lineitem"""),
    "measure_extremes": Query(measure_extremes, """
SELECT max(ts) AS latest, greatest(max(user_id), max(event_id)) AS top,
       round(avg(value), 6) AS mean FROM events"""),
    "status_rates_by_dow": Query(status_rates_by_dow, _order_rates_sql("isodow(o_orderdate)")),
    "status_rates_by_month": Query(status_rates_by_month, _order_rates_sql("month(o_orderdate)")),
    "status_rates_by_dom": Query(status_rates_by_dom, _order_rates_sql("day(o_orderdate)")),
    "status_rates_by_hour": Query(
        status_rates_by_hour,
        _CLOCK_SQL.format(key="CAST(floor(t / 100.0) AS INT) AS key", group="1"),
    ),
    "rates_by_rounded_time": Query(
        rates_by_rounded_time,
        _CLOCK_SQL.format(
            key="CAST(t AS VARCHAR) AS hhmm, CAST(round_even(t / 100.0, 0) AS INT) AS hour",
            group="1, 2",
        ),
    ),
    "rate_boxes_by_hour": Query(rate_boxes_by_hour, """
WITH e AS (SELECT hour(ts) * 100 + minute(ts) AS t, event_type FROM events),
r AS (SELECT t, count(*) FILTER (WHERE event_type = 'error') * 100.0::DOUBLE / count(*) AS p
      FROM e GROUP BY 1)
SELECT CAST(floor(t / 100.0) AS INT) AS hour, round(min(p), 6) AS min,
       round(quantile_cont(p, 0.25), 6) AS p25, round(quantile_cont(p, 0.5), 6) AS p50,
       round(quantile_cont(p, 0.75), 6) AS p75, round(max(p), 6) AS max
FROM r GROUP BY 1"""),
    "share_over_threshold": Query(share_over_threshold, """
SELECT event_type, round(avg(CASE WHEN value > 15 THEN 1 ELSE 0 END), 6) AS late_share
FROM events GROUP BY 1"""),
}
