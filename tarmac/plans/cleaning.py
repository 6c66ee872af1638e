"""Typing, filters, deduplication, flags and time columns."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.functions import numbers, text, times
from tarmac.functions.holidays import is_us_holiday
from tarmac.operators import clean, profile
from tarmac.operators.ordered import first_per_key
from tarmac.plans.common import GAPPY_SQL, Query, gappy_events, rounded, shipments, table
from tarmac.sources.schemas import conform, rejects

_EVENT_TYPES = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.IntegerType()), T.StructField("value", T.DoubleType()),
])


def _text_events(spark, folder):
    """Events as a text file would hold them, with some values that are no numbers."""
    value = F.col("value")
    dirty = (
        F.when(value < 1, "T").when(value < 5, F.concat(value.cast("string"), F.lit("s")))
        .when(value < 6, "").otherwise(value.cast("string"))
    )
    return table(spark, folder, "events").select(
        *[F.col(c).cast("string") for c in ("event_id", "ts", "user_id", "event_type")],
        dirty.alias("value"),
    )


_DIRTY_SQL = """
  SELECT *, CASE WHEN value < 1 THEN 'T' WHEN value < 5 THEN CAST(value AS VARCHAR) || 's'
                 WHEN value < 6 THEN '' ELSE CAST(value AS VARCHAR) END AS dirty
  FROM events"""


def typed_projection(spark, folder):
    return conform(_text_events(spark, folder), _EVENT_TYPES)


def typing_rejects(spark, folder):
    return rejects(_text_events(spark, folder), _EVENT_TYPES)


def clean_numeric_text(spark, folder):
    return _text_events(spark, folder).select(
        F.col("event_id").cast("long").alias("event_id"),
        text.numeric_text(F.col("value")).alias("stripped"),
        text.precipitation(F.concat("value", F.lit(".9"))).alias("rain"),
        text.numeric_text(F.concat(F.lit("-"), "user_id")).alias("negative"),
    )


def avg_by_rain_text(spark, folder):
    """Average per reading of a dirty rain column, in the order of the cleaned amounts."""
    events = table(spark, folder, "events").withColumn(
        "rain", F.when(F.col("user_id") % 7 == 0, "T").otherwise(
            F.concat(F.lit("0.0"), F.col("user_id") % 7, F.lit("s"))))
    averages = profile.averages_by(events, "rain", ["value"])
    return rounded(
        profile.by_numeric_text(averages, "rain", text.precipitation(F.col("rain"))), "avg_value")


def filter_active(spark, folder):
    orders = table(spark, folder, "orders")
    flagged = orders.withColumns({
        "CANCELLED": F.when(F.col("o_orderstatus") == "F", "1.0").when(
            F.col("o_orderpriority") != "5-LOW", "0.0"),
        "DIVERTED": F.when(F.col("o_orderstatus") == "P", "1.0").otherwise("0.0"),
    })
    return clean.keep_completed(flagged).select("o_orderkey", "o_orderstatus", "o_totalprice")


def status_counts(spark, folder):
    status = clean.status_of(
        F.when(F.col("o_orderstatus") == "F", "1.0").otherwise("0.0"),
        F.when(F.col("o_orderstatus") == "P", "1").otherwise("0"),
    )
    return profile.counts_by(table(spark, folder, "orders").withColumn("status", status),
                             ["status"])


def dedup_first(spark, folder):
    lines = table(spark, folder, "lineitem")
    keys = ["l_orderkey", "l_linenumber"]
    return first_per_key(lines, keys, [c for c in lines.columns if c not in keys])


def one_per_key(spark, folder):
    places = table(spark, folder, "supplier").selectExpr(
        "s_nationkey AS place", "s_acctbal AS lat", "s_suppkey AS lon"
    )
    return first_per_key(places, ["place"], ["lon"])


def distinct_values(spark, folder):
    orders = table(spark, folder, "orders")
    return orders.select(F.year("o_orderdate").alias("year"), "o_orderstatus").distinct()


def drop_null_rows(spark, folder):
    return clean.completeness(gappy_events(spark, folder))


def complete_events(spark, folder):
    return clean.complete_rows(gappy_events(spark, folder), ["value"]).select("event_id", "value")


def fill_defaults(spark, folder):
    filled = gappy_events(spark, folder).fillna({"value": 0.0, "props": ""})
    return filled.select("event_id", "value", "props")


def date_split(spark, folder):
    before, after = clean.split_at(
        table(spark, folder, "events"), "ts", F.lit("2024-01-20").cast("timestamp_ntz")
    )

    def part(df, name):
        return df.agg(
            F.lit(name).alias("part"), F.count(F.lit(1)).alias("n"),
            F.min("ts").alias("first"), F.max("ts").alias("last"),
        )

    return part(before, "train").unionByName(part(after, "valid"))


def year_holdout(spark, folder):
    orders = table(spark, folder, "orders").withColumn("year", F.year("o_orderdate"))
    train, test = clean.hold_out(orders, "year", 2000)

    def part(df, name):
        totals = df.agg(F.count(F.lit(1)).alias("n"),
                        F.round(F.sum("o_totalprice"), 2).alias("total"))
        return totals.withColumn("part", F.lit(name))

    return part(train, "train").unionByName(part(test, "test"))


def range_filter(spark, folder):
    return clean.within(_text_events(spark, folder), "value", 10, 200).select(
        F.col("event_id").cast("long").alias("event_id"), F.col("value").cast("double").alias("v")
    )


def prefix_filter(spark, folder):
    rows = _text_events(spark, folder).filter(F.col("ts") < "2024-01-02 12")
    return rows.select(F.col("event_id").cast("long").alias("event_id"), "event_type")


def key_lookup(spark, folder):
    return table(spark, folder, "orders").filter(F.col("o_custkey") == 77)


def column_kinds(spark, folder):
    parts = table(spark, folder, "part")
    words = clean.columns_of_kind(parts, "categorical")
    figures = clean.columns_of_kind(parts, "numerical")
    return parts.select("p_partkey", F.concat_ws("|", *words).alias("words"),
                        sum((F.col(c) for c in figures), F.lit(0.0)).alias("figures"))


def expression_projection(spark, folder):
    return table(spark, folder, "customer").selectExpr(
        "c_custkey AS id", "upper(c_name) AS name", "c_acctbal / 100 AS balance",
        "c_acctbal IS NULL OR c_acctbal < 0 AS in_debt",
    )


def padded_union(spark, folder):
    sellers = table(spark, folder, "supplier").select(
        F.lit("supplier").alias("kind"), F.col("s_suppkey").alias("id"),
        F.col("s_nationkey").alias("nation"))
    buyers = table(spark, folder, "customer").select(
        F.lit("customer").alias("kind"), F.col("c_custkey").alias("id"),
        F.col("c_mktsegment").alias("segment"))
    return clean.stack_tables(sellers, buyers)


def flag_contains(spark, folder):
    docs = table(spark, folder, "documents").withColumn(
        "flag", text.has_marker(F.col("text"), "VV"))
    names = table(spark, folder, "part").select(
        F.col("p_partkey").alias("doc_id"), text.has_marker(F.col("p_name"), "ring").alias("flag"))
    return docs.select("doc_id", "flag", F.lit("text").alias("kind")).unionByName(
        names.withColumn("kind", F.lit("name")))


def flag_any_code(spark, folder):
    names = table(spark, folder, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("words"), F.lit("name").alias("kind"))
    docs = table(spark, folder, "documents").select(
        F.col("doc_id").alias("id"), F.col("text").alias("words"), F.lit("text").alias("kind"))
    both = names.unionByName(docs)
    return both.select("id", "kind", text.has_any_code(F.col("words")).alias("flag"))


def time_buckets(spark, folder):
    events = table(spark, folder, "events").withColumn("part_of_day", times.day_part(F.col("ts")))
    return profile.counts_by(events, ["part_of_day"])


def timestamp_from_parts(spark, folder):
    events = table(spark, folder, "events")
    seconds_later = (F.col("event_id") % 600) * 60
    later = (F.unix_seconds(F.col("ts").cast("timestamp")) + seconds_later).cast("timestamp")
    raw = events.select(
        "event_id", F.to_date("ts").alias("day"),
        F.date_format("ts", "HHmm").cast("int").cast("string").alias("dep"),
        F.when(F.col("event_id") % 97 == 0, "none")
        .otherwise(F.date_format(later, "HHmm").cast("int").cast("string")).alias("arr"),
    )
    dep = times.scheduled_timestamp(F.col("day"), F.col("dep"))
    arr = times.scheduled_timestamp(F.col("day"), F.col("arr"))
    return raw.select(
        "event_id", dep.cast("timestamp_ntz").alias("dep"),
        times.roll_past_midnight(dep, arr).cast("timestamp_ntz").alias("arr"),
    )


def date_key(spark, folder):
    orders = table(spark, folder, "orders")
    parts = F.year("o_orderdate"), F.month("o_orderdate"), F.dayofmonth("o_orderdate")
    keyed = orders.select(times.date_key(*parts).alias("key"), times.date_text(*parts).alias("t"))
    return profile.counts_by(keyed, ["key", "t"])


def time_chunk(spark, folder):
    events = table(spark, folder, "events").withColumn("chunk", times.time_chunk(F.col("ts")))
    return profile.counts_by(events, ["chunk"])


def hours_between(spark, folder):
    events = table(spark, folder, "events")
    start = F.date_trunc("day", "ts")
    return events.select(
        "event_id", F.round(times.hours_between(start, F.col("ts")), 6).alias("hours"))


def holiday_flag(spark, folder):
    orders = table(spark, folder, "orders")
    return orders.select(
        "o_orderkey", F.to_date("o_orderdate").alias("day"),
        is_us_holiday(F.col("o_orderdate")).alias("is_holiday"))


# The public rules a second way: a list of dates, joined.
_HOLIDAY_SQL = """
WITH d AS (SELECT CAST(unnest(generate_series(DATE '1990-01-01', DATE '2030-12-31',
                                              INTERVAL 1 DAY)) AS DATE) AS day),
f AS (SELECT day FROM d WHERE strftime(day, '%m%d') IN ('0101', '0704', '1111', '1225')
      OR (strftime(day, '%m%d') = '0619' AND year(day) >= 2021)),
n AS (SELECT day, month(day) AS m, isodow(day) AS w,
        row_number() OVER (PARTITION BY year(day), month(day), isodow(day) ORDER BY day) AS nth,
        row_number() OVER (PARTITION BY year(day), month(day), isodow(day) ORDER BY day DESC) AS z
      FROM d),
h AS (SELECT day FROM f
  UNION SELECT day FROM n WHERE (w = 1 AND ((m IN (1, 2) AND nth = 3) OR (m = 5 AND z = 1)
      OR (m = 9 AND nth = 1) OR (m = 10 AND nth = 2))) OR (w = 4 AND m = 11 AND nth = 4)
  UNION SELECT CAST(day - INTERVAL 1 DAY AS DATE) FROM f WHERE isodow(day) = 6
  UNION SELECT CAST(day + INTERVAL 1 DAY AS DATE) FROM f WHERE isodow(day) = 7)
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, h.day IS NOT NULL AS is_holiday
FROM orders LEFT JOIN h ON CAST(o_orderdate AS DATE) = h.day"""


def cap_at_percentile(spark, folder):
    capped = profile.cap_at_percentile(
        table(spark, folder, "events"), "value", 0.95, "capped")
    return rounded(capped.select("event_id", "capped", "threshold"), "capped", "threshold")


def clipped_delay(spark, folder):
    """Late days of an order's lines, early ones counted as 0."""
    days = F.datediff("l_shipdate", "o_orderdate")
    return shipments(spark, folder).groupBy("o_orderpriority").agg(
        F.round(F.avg(numbers.clip_at_zero(days.cast("double"))), 6).alias("avg_late"),
        F.count_if(days <= 0).alias("on_time"))


_CODES_SQL = "'GR|GS|VA|DU|SA|PO|SQ|FC|SS|DS'"
# Full upper-casing turns a sharp s into SS; the SQL engine's upper() does not.
_UPPER_SQL = "upper(replace({0}, 'ß', 'SS'))"

QUERIES = {
    "typed_projection": Query(typed_projection, f"""
SELECT event_id, ts, CAST(user_id AS INT) AS user_id,
       CASE WHEN dirty = '' THEN NULL ELSE TRY_CAST(dirty AS DOUBLE) END AS value
FROM ({_DIRTY_SQL})"""),
    "typing_rejects": Query(typing_rejects, f"""
SELECT 'event_id' AS column_name, CAST(0 AS BIGINT) AS rejected
UNION ALL SELECT 'ts', 0 UNION ALL SELECT 'user_id', 0
UNION ALL SELECT 'value', count(*) FILTER (WHERE value < 6) FROM ({_DIRTY_SQL})"""),
    "clean_numeric_text": Query(clean_numeric_text, """
SELECT event_id, CASE WHEN value < 1 OR (value >= 5 AND value < 6) THEN NULL ELSE value END
         AS stripped,
       CASE WHEN value < 1 THEN 0.9 WHEN value >= 5 AND value < 6 THEN 0.9 ELSE value END AS rain,
       -CAST(user_id AS DOUBLE) AS negative
FROM events"""),
    "avg_by_rain_text": Query(avg_by_rain_text, """
SELECT CASE WHEN user_id % 7 = 0 THEN 'T' ELSE '0.0' || (user_id % 7) || 's' END AS rain,
       CASE WHEN user_id % 7 = 0 THEN 0.005 ELSE (user_id % 7) / 100.0 END::DOUBLE AS sort_key,
       round(avg(value), 6) AS avg_value
FROM events GROUP BY 1, 2"""),
    "filter_active": Query(filter_active, """
SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders
WHERE o_orderstatus NOT IN ('F', 'P') AND o_orderpriority <> '5-LOW'"""),
    "status_counts": Query(status_counts, """
SELECT CASE o_orderstatus WHEN 'F' THEN 'cancelled' WHEN 'P' THEN 'diverted' ELSE 'completed' END
         AS status, count(*) AS n FROM orders GROUP BY 1"""),
    "dedup_first": Query(dedup_first, """
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag,
           l_linestatus, l_shipdate) AS rn FROM lineitem) WHERE rn = 1"""),
    "one_per_key": Query(one_per_key, """
SELECT s_nationkey AS place, arg_min(s_acctbal, s_suppkey) AS lat, min(s_suppkey) AS lon
FROM supplier GROUP BY 1"""),
    "distinct_values": Query(distinct_values, """
SELECT DISTINCT CAST(year(o_orderdate) AS INT) AS year, o_orderstatus FROM orders"""),
    "drop_null_rows": Query(drop_null_rows, f"""
SELECT count(*) AS rows_before,
       count(*) FILTER (WHERE value IS NOT NULL AND props IS NOT NULL) AS rows_after,
       count(*) FILTER (WHERE value IS NULL OR props IS NULL) AS dropped
FROM ({GAPPY_SQL})"""),
    "complete_events": Query(complete_events, """
SELECT event_id, value FROM events WHERE event_type <> 'error'"""),
    "fill_defaults": Query(fill_defaults, f"""
SELECT event_id, coalesce(value, 0.0) AS value, coalesce(props, '') AS props
FROM ({GAPPY_SQL})"""),
    "date_split": Query(date_split, """
SELECT CASE WHEN ts <= TIMESTAMP '2024-01-20' THEN 'train' ELSE 'valid' END AS part,
       count(*) AS n, min(ts) AS first, max(ts) AS last FROM events GROUP BY 1"""),
    "year_holdout": Query(year_holdout, """
SELECT CASE WHEN year(o_orderdate) = 2000 THEN 'test' ELSE 'train' END AS part,
       count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1"""),
    "range_filter": Query(range_filter, """
SELECT event_id, value AS v FROM events WHERE value >= 10 AND value < 200"""),
    "prefix_filter": Query(prefix_filter, """
SELECT event_id, event_type FROM events WHERE ts < TIMESTAMP '2024-01-02 12:00:00'"""),
    "key_lookup": Query(key_lookup, "SELECT * FROM orders WHERE o_custkey = 77"),
    "column_kinds": Query(column_kinds, """
SELECT p_partkey, p_name || '|' || p_brand || '|' || p_type AS words,
       p_size + p_retailprice AS figures FROM part"""),
    "expression_projection": Query(expression_projection, """
SELECT c_custkey AS id, upper(c_name) AS name, c_acctbal / 100 AS balance,
       c_acctbal IS NULL OR c_acctbal < 0 AS in_debt FROM customer"""),
    "padded_union": Query(padded_union, """
SELECT 'supplier' AS kind, s_suppkey AS id, s_nationkey AS nation, NULL AS segment FROM supplier
UNION ALL SELECT 'customer', c_custkey, NULL, c_mktsegment FROM customer"""),
    "flag_contains": Query(flag_contains, """
SELECT doc_id, contains(text, 'VV') AS flag, 'text' AS kind FROM documents
UNION ALL SELECT p_partkey, contains(p_name, 'ring'), 'name' FROM part"""),
    "flag_any_code": Query(flag_any_code, f"""
SELECT p_partkey AS id, 'name' AS kind,
       regexp_matches({_UPPER_SQL.format("p_name")}, {_CODES_SQL}) AS flag FROM part
UNION ALL SELECT doc_id, 'text',
       regexp_matches({_UPPER_SQL.format("text")}, {_CODES_SQL}) FROM documents"""),
    "time_buckets": Query(time_buckets, """
SELECT CASE WHEN hour(ts) < 6 THEN 'Night' WHEN hour(ts) < 12 THEN 'Morning'
            WHEN hour(ts) < 18 THEN 'Afternoon' ELSE 'Evening' END AS part_of_day, count(*) AS n
FROM events GROUP BY 1"""),
    "timestamp_from_parts": Query(timestamp_from_parts, """
WITH t AS (SELECT event_id, ts, date_trunc('minute', ts) AS dep,
  date_trunc('minute', date_trunc('second', ts) + INTERVAL 1 MINUTE * (event_id % 600)) AS arr
  FROM events)
SELECT event_id, dep, CASE WHEN event_id % 97 <> 0 THEN arr END AS arr FROM t"""),
    "date_key": Query(date_key, """
SELECT CAST(strftime(o_orderdate, '%Y%m%d') AS INT) AS key,
       year(o_orderdate) || '-' || month(o_orderdate) || '-' || day(o_orderdate) AS t,
       count(*) AS n FROM orders GROUP BY 1, 2"""),
    "time_chunk": Query(time_chunk, """
SELECT CAST(floor((epoch(ts) - 1420070400) / 7200) AS BIGINT) AS chunk, count(*) AS n
FROM events GROUP BY 1"""),
    "hours_between": Query(hours_between, """
SELECT event_id, round((hour(ts) * 3600 + minute(ts) * 60 + second(ts)) / 3600.0::DOUBLE, 6)
  AS hours FROM events"""),
    "holiday_flag": Query(holiday_flag, _HOLIDAY_SQL),
    "cap_at_percentile": Query(cap_at_percentile, """
WITH p AS (SELECT quantile_cont(value, 0.95) AS q FROM events)
SELECT event_id, round(least(value, q), 6) AS capped, round(q, 6) AS threshold FROM events, p"""),
    "clipped_delay": Query(clipped_delay, """
WITH d AS (SELECT o_orderpriority,
  date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS late
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT o_orderpriority, round(avg(greatest(late, 0)), 6) AS avg_late,
       count(*) FILTER (WHERE late <= 0) AS on_time FROM d GROUP BY 1"""),
}
