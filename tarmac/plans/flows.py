"""Round trips through files, and the whole feature table."""

from __future__ import annotations

import uuid

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.functions.holidays import is_us_holiday
from tarmac.functions.numbers import cap, over_threshold
from tarmac.functions.times import day_part
from tarmac.operators import chain, clean
from tarmac.operators.clean import split_at
from tarmac.operators.features import standardise
from tarmac.operators.joins import attach_scalars
from tarmac.operators.ordered import first_per_key
from tarmac.operators.profile import threshold
from tarmac.operators.series import previous_trip_features
from tarmac.plans.common import Query, rounded, table
from tarmac.plans.network import _pagerank_ctes
from tarmac.plans.series import _JOURNEYS_SQL, _journeys
from tarmac.session import new_folder, shared_folder, stage
from tarmac.sources import tables
from tarmac.sources.schemas import conform

_ORDERS = T.StructType([
    T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
    T.StructField("o_orderstatus", T.StringType()), T.StructField("o_totalprice", T.DoubleType()),
    T.StructField("o_orderdate", T.TimestampNTZType()), T.StructField("year", T.IntegerType()),
])


def _new_path(spark):
    return f"{shared_folder(spark)}/files-{uuid.uuid4().hex}"


def csv_to_parquet(spark, folder):
    """Orders out to CSV, half of them gzip, with more columns and in another order; read by header
    name, typed, kept by year as Parquet, and read back."""
    raw, typed = _new_path(spark), _new_path(spark)
    orders = table(spark, folder, "orders").withColumn("year", F.year("o_orderdate"))
    wide = orders.select("o_orderpriority", *reversed(_ORDERS.names))
    even = F.col("o_orderkey") % 2 == 0
    wide.filter(even).write.csv(f"{raw}/packed", header=True, compression="gzip")
    wide.filter(~even).write.csv(f"{raw}/plain", header=True)
    tables.csv_to_parquet(spark, [f"{raw}/plain", f"{raw}/packed"], typed, _ORDERS, ["year"],
                          spread=spark.sparkContext.defaultParallelism)
    return tables.read_parquet(spark, typed).select(_ORDERS.names)


def csv_headers_differ(spark, folder):
    """Orders from three sets of files whose headers have other columns in other orders."""
    raw = _new_path(spark)
    orders = table(spark, folder, "orders").withColumn("year", F.year("o_orderdate"))
    third = F.col("o_orderkey") % 3
    orders.filter(third == 0).select(*_ORDERS.names).write.csv(f"{raw}/a", header=True)
    orders.filter(third == 1).select("o_orderpriority", *reversed(_ORDERS.names)).write.csv(
        f"{raw}/b", header=True, compression="gzip")
    orders.filter(third == 2).select(
        "year", F.lit("x, \"y\"").alias("note"), *_ORDERS.names[:-1]).write.csv(f"{raw}/c", header=True)
    rows = tables.read_csv(spark, [f"{raw}/{part}" for part in "abc"], _ORDERS)
    return conform(rows, _ORDERS)


def _checked_events(spark, folder):
    """Events as text, some of them unreadable or incomplete, written with their checks."""
    path = _new_path(spark)
    events = table(spark, folder, "events").select(
        F.col("event_id").cast("string").alias("event_id"),
        F.when(F.col("value") < 6, F.concat(F.col("value").cast("string"), F.lit("x"))).otherwise(
            F.col("value").cast("string")).alias("value"),
        F.when(F.col("user_id") % 50 == 0, F.lit("?")).otherwise(F.col("user_id").cast("string")).alias("user_id"),
        F.when(F.col("event_type") != "error", F.col("event_type")).alias("event_type"))
    counts = tables.write_checked(events, _CHECKED, path, ["event_type"], ["event_type"])
    return path, counts


_CHECKED = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType()),
    T.StructField("value", T.DoubleType()), T.StructField("event_type", T.StringType()),
])


def quarantined_rows(spark, folder):
    """Raw values and reasons of the rows that fail a check."""
    path, _ = _checked_events(spark, folder)
    return tables.rejected_rows(spark, path).select(
        F.get_json_object("raw", "$.event_id").cast("long").alias("event_id"),
        F.get_json_object("raw", "$.user_id").alias("raw_user_id"),
        F.array_join("reasons", "; ").alias("reasons"))


def accepted_events(spark, folder):
    path, _ = _checked_events(spark, folder)
    return tables.accepted_rows(spark, path).select(*_CHECKED.names)


def checked_counts(spark, folder):
    """Rows and rejects per column, counted by the job that wrote the rows."""
    _, counts = _checked_events(spark, folder)
    return tables.local_rows(spark, sorted(counts.items()), "measure string, n long")


def partition_pruned_check(spark, folder):
    """Row count and latest date of one year of a table kept by year."""
    path = _new_path(spark)
    orders = table(spark, folder, "orders").withColumn("year", F.year("o_orderdate"))
    tables.write_parquet(orders.select(_ORDERS.names), path, ["year"])
    return tables.content_check(
        tables.read_parquet(spark, path).filter(F.col("year") == 1998), "o_orderdate")


def text_round_trip(spark, folder):
    path = _new_path(spark)
    lines = table(spark, folder, "customer").select(
        F.concat_ws("\t", "c_custkey", "c_name").alias("line"))
    tables.write_lines(lines, "line", path)
    parts = F.split("value", "\t")
    return tables.read_lines(spark, path).select(
        parts[0].cast("long").alias("c_custkey"), parts[1].alias("c_name"))


def local_names(spark, folder):
    """Orders counted under names from a few rows of the program; a status without one keeps null."""
    names = tables.local_rows(
        spark, [("F", "cancelled", 1.0), ("P", "diverted", 0.5)],
        T.StructType().add("code", "string").add("name", "string").add("weight", "double"))
    orders = table(spark, folder, "orders")
    return orders.join(F.broadcast(names), F.col("o_orderstatus") == F.col("code"), "left").groupBy("name").agg(
        F.count(F.lit(1)).alias("n"), F.sum("weight").alias("weight"))


def feature_table(spark, folder):
    """Journeys with every derived column; caps and scales are fitted on the training days."""
    journeys = _journeys(spark, folder)
    featured = previous_trip_features(
        journeys, "user_id", "dep", "arr", "elapsed", "delay", ["arr", "event_id"])
    flagged = stage(featured.withColumns({
        "part_of_day": day_part(F.col("dep")), "is_holiday": is_us_holiday(F.col("dep")),
        "late": over_threshold(F.col("delay")),
    }))
    train, _ = split_at(flagged, "dep", F.lit("2024-01-20").cast("timestamp_ntz"))
    capped = attach_scalars(flagged, threshold(train, "delay", 0.95)).withColumn(
        "capped_delay", cap(F.col("delay"), F.col("threshold")))
    scaled = standardise(capped, ["elapsed", "prev_delay"], train)
    return rounded(
        scaled.select(
            "event_id", "part_of_day", "is_holiday", "late", "hours_since_prev", "prev_delay",
            "has_previous", "capped_delay", "elapsed_scaled", "prev_delay_scaled"),
        "hours_since_prev", "capped_delay", "elapsed_scaled", "prev_delay_scaled")


_CHECKS_SQL = """
  SELECT *, user_id % 50 = 0 AS bad_user, value < 6 AS bad_value, event_type = 'error' AS bad_type
  FROM events"""

_TRIP_DDL = ("event_id long, fl_date string, dep_clock string, arr_clock string, tail long, origin string, "
             "dest string, carrier string, delay double, elapsed double, sky string, codes string")


def _raw_trips(spark, folder):
    """Events as raw text records of trips: some cancelled, diverted or twice there."""
    minute = F.floor(F.col("value")).cast("int")
    dep = F.col("ts")
    arr = F.timestamp_add("MINUTE", minute, dep)

    def clock(ts):
        return (F.hour(ts) * 100 + F.minute(ts)).cast("string")

    trips = table(spark, folder, "events").select(
        F.col("event_id").cast("string").alias("event_id"), F.date_format("ts", "yyyy-MM-dd").alias("fl_date"),
        clock(dep).alias("dep_clock"), clock(arr).alias("arr_clock"),
        F.col("user_id").cast("string").alias("tail"),
        F.concat(F.lit("n"), F.col("user_id") % 7).alias("origin"),
        F.concat(F.lit("n"), F.col("event_id") % 9).alias("dest"), F.col("event_type").alias("carrier"),
        F.when(F.col("event_id") % 11 != 0, F.col("value").cast("string")).alias("delay"),
        (F.col("value") * 2).cast("string").alias("elapsed"),
        F.when(F.col("event_id") % 5 == 0, F.concat(F.lit("VV"), "props")).otherwise(F.col("props")).alias("sky"),
        F.when(F.col("user_id") % 6 == 0, F.lit("ts gr")).otherwise(F.lit("RA")).alias("codes"),
        F.when(F.col("event_type") == "error", F.lit("1.0")).otherwise(F.lit("0.0")).alias("cancelled"),
        F.when(F.col("user_id") % 50 == 0, F.lit("1.00")).otherwise(F.lit("0")).alias("diverted"))
    return trips.unionByName(trips.filter(F.col("event_id").cast("long") % 8 == 0))


_SCALES = ["elapsed", "hours_since_prev", "prev_delay", "origin_rank", "dest_rank"]
_LEVELS = ["carrier", "part_of_day", "origin", "dest"]
_CHAIN_CUTOFF = "2024-01-20"


def _chain():
    """Every step from raw records to the vector, in order."""
    return Pipeline(stages=[
        chain.step(clean.keep_completed, cancelled="cancelled", diverted="diverted"),
        chain.step(first_per_key, keys=["event_id"], order=["fl_date", "dep_clock"]),
        chain.step(chain.typed, ddl=_TRIP_DDL),
        chain.step(chain.weather_flags, sky="sky", codes="codes"),
        chain.step(chain.trip_times, date="fl_date", departure="dep_clock", arrival="arr_clock"),
        chain.step(previous_trip_features, entity="tail", start="dep", end="arr", elapsed="elapsed",
                   delay="delay", order=["arr", "event_id"]),
        chain.step(clean.complete_rows, columns=["event_id", "dep", "arr", "delay", "elapsed", "carrier"]),
        chain.step(stage),
        chain.learnt(chain.learn_cap, chain.apply_cap, column="delay", fraction=0.95),
        chain.learnt(chain.learn_ranks, chain.apply_ranks, date="dep", origin="origin", dest="dest",
                     rounds=15),
        chain.learnt(chain.learn_scales, chain.apply_scales, columns=_SCALES),
        chain.learnt(chain.learn_levels, chain.apply_levels, key=["event_id"], columns=_LEVELS,
                     numbers=["obscured", "extreme", "holiday"], output="features"),
    ])


def feature_chain(spark, folder):
    """The whole chain as one pipeline: fitted on the earlier days, saved, read back, and applied to all."""
    raw = _raw_trips(spark, folder)
    train, _ = split_at(raw, "fl_date", F.lit(_CHAIN_CUTOFF))
    path = new_folder(spark, "chain")
    _chain().fit(train).save(path)
    done = PipelineModel.load(path).transform(raw)
    names = [f"{c}_scaled" for c in _SCALES]
    return rounded(
        done.select("event_id", "part_of_day", "has_previous", "capped_delay", *names,
                    F.regexp_extract(F.col("features").cast("string"), r"\[([\d,]*)\]", 1).alias("slots")),
        "capped_delay", *names, digits=5)


_RAW_TRIPS_SQL = """
  SELECT event_id, CAST(ts AS DATE) AS fl_date, user_id AS tail, 'n' || user_id % 7 AS origin,
         'n' || event_id % 9 AS dest, event_type AS carrier,
         CASE WHEN event_id % 11 <> 0 THEN value END AS delay, value * 2 AS elapsed,
         CAST(event_id % 5 = 0 AS INT) AS obscured, CAST(user_id % 6 = 0 AS INT) AS extreme,
         date_trunc('minute', ts) AS dep,
         CAST(ts AS DATE) + INTERVAL 1 MINUTE * (hour(a) * 60 + minute(a)) AS arr0
  FROM (SELECT *, ts + INTERVAL 1 MINUTE * CAST(floor(value) AS BIGINT) AS a FROM events)
  WHERE event_type <> 'error' AND user_id % 50 <> 0"""
_CHAIN_SQL = f"""
WITH t AS (SELECT *, CASE WHEN arr0 < dep THEN arr0 + INTERVAL 1 DAY ELSE arr0 END AS arr
  FROM ({_RAW_TRIPS_SQL})),
p AS MATERIALIZED (SELECT *, lag(arr) OVER w AS pa, lag(elapsed) OVER w AS pe,
    coalesce(lag(delay) OVER w, 0.0) AS prev_delay, lag(event_id) OVER w IS NOT NULL AS has_previous,
    CASE WHEN hour(dep) < 6 THEN 'Night' WHEN hour(dep) < 12 THEN 'Morning'
      WHEN hour(dep) < 18 THEN 'Afternoon' ELSE 'Evening' END AS part_of_day,
    CAST(fl_date IN (DATE '2024-01-01', DATE '2024-01-15') AS INT) AS holiday
  FROM t {{where}} WINDOW w AS (PARTITION BY tail ORDER BY arr, event_id)),
q AS MATERIALIZED (SELECT *, coalesce(CASE WHEN pe >= 120 THEN (epoch(dep) - epoch(pa)) / 3600.0::DOUBLE END, 0.0)
    AS hours_since_prev FROM p WHERE delay IS NOT NULL)"""
_TRAIN_Q = _CHAIN_SQL.format(where=f"WHERE fl_date <= DATE '{_CHAIN_CUTOFF}'")
_ALL_Q = _CHAIN_SQL.format(where="")


def _chain_sql():
    """The training rows and all rows go through the same steps, each seeing only its own rows."""
    ranks = _pagerank_ctes(
        "SELECT CAST(year(dep) AS INT) AS year, origin AS src, dest AS dst, count(*) AS weight FROM tq GROUP BY ALL",
        15, "count", "year")
    levels = " UNION ALL ".join(
        f"SELECT {i} AS place, {c} AS level FROM tq" for i, c in enumerate(_LEVELS))
    slots = " UNION ALL ".join(
        f"SELECT event_id, {i} AS place, {c} AS level FROM aq" for i, c in enumerate(_LEVELS))
    scaled = ", ".join(
        f"round((a.{c} - m_{c}) / d_{c}, 5) AS {c}_scaled" for c in _SCALES)
    scales = ", ".join(f"avg({c}) AS m_{c}, stddev_samp({c}) AS d_{c}" for c in _SCALES)

    def both(name):
        return f"""SELECT {name}.*, coalesce(o.rank, 0.0) AS origin_rank, coalesce(d.rank, 0.0) AS dest_rank
  FROM {name} LEFT JOIN mean_rank o ON o.id = origin LEFT JOIN mean_rank d ON d.id = dest"""

    return f"""
WITH tq AS MATERIALIZED ({_TRAIN_Q} SELECT * FROM q), aq AS MATERIALIZED ({_ALL_Q} SELECT * FROM q),
{ranks},
mean_rank AS MATERIALIZED (SELECT id, avg(rank) AS rank FROM ranks GROUP BY 1),
tr AS MATERIALIZED ({both("tq")}), ar AS MATERIALIZED ({both("aq")}),
f AS (SELECT {scales}, quantile_cont(delay, 0.95) AS cap FROM tr),
l AS (SELECT place, level, row_number() OVER (ORDER BY place, count(*) DESC, level) + 2 AS slot
  FROM ({levels}) GROUP BY 1, 2),
s AS (SELECT event_id, string_agg(slot, ',' ORDER BY slot) AS slots FROM ({slots}) JOIN l USING (place, level)
  GROUP BY 1)
SELECT event_id, part_of_day, has_previous, round(least(delay, cap), 5) AS capped_delay, {scaled},
       concat_ws(',', '0,1,2', slots) AS slots
FROM ar a LEFT JOIN s USING (event_id), f"""


QUERIES = {
    "csv_to_parquet": Query(csv_to_parquet, """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
       CAST(year(o_orderdate) AS INT) AS year FROM orders"""),
    "csv_headers_differ": Query(csv_headers_differ, """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
       CAST(year(o_orderdate) AS INT) AS year FROM orders"""),
    "quarantined_rows": Query(quarantined_rows, f"""
SELECT event_id, CASE WHEN bad_user THEN '?' ELSE CAST(user_id AS VARCHAR) END AS raw_user_id,
       concat_ws('; ', CASE WHEN bad_user THEN 'user_id: not bigint' END,
         CASE WHEN bad_value THEN 'value: not double' END,
         CASE WHEN bad_type THEN 'event_type: missing' END) AS reasons
FROM ({_CHECKS_SQL}) WHERE bad_user OR bad_value OR bad_type"""),
    "accepted_events": Query(accepted_events, f"""
SELECT event_id, user_id, value, event_type FROM ({_CHECKS_SQL})
WHERE NOT (bad_user OR bad_value OR bad_type)"""),
    "checked_counts": Query(checked_counts, f"""
WITH c AS ({_CHECKS_SQL})
SELECT 'rows' AS measure, count(*) AS n FROM c
UNION ALL SELECT 'rejected', count(*) FILTER (WHERE bad_user OR bad_value OR bad_type) FROM c
UNION ALL SELECT 'rejected_event_id', 0 UNION ALL SELECT 'rejected_user_id', count_if(bad_user) FROM c
UNION ALL SELECT 'rejected_value', count_if(bad_value) FROM c
UNION ALL SELECT 'rejected_event_type', count_if(bad_type) FROM c"""),
    "partition_pruned_check": Query(partition_pruned_check, """
SELECT count(*) AS n_rows, max(o_orderdate) AS latest FROM orders
WHERE year(o_orderdate) = 1998"""),
    "text_round_trip": Query(text_round_trip, "SELECT c_custkey, c_name FROM customer"),
    "local_names": Query(local_names, """
SELECT name, count(*) AS n, sum(weight)::DOUBLE AS weight
FROM orders LEFT JOIN (VALUES ('F', 'cancelled', 1.0), ('P', 'diverted', 0.5)) AS t(code, name, weight)
  ON o_orderstatus = code GROUP BY 1"""),
    "feature_chain": Query(feature_chain, _chain_sql()),
    "feature_table": Query(feature_table, f"""
WITH j AS ({_JOURNEYS_SQL}),
p AS (SELECT *, lag(arr) OVER w AS pa, lag(elapsed) OVER w AS pe, lag(delay) OVER w AS pd,
        lag(event_id) OVER w IS NOT NULL AS has_previous
      FROM j WINDOW w AS (PARTITION BY user_id ORDER BY arr, event_id)),
q AS (SELECT *, coalesce(pd, 0.0) AS prev_delay FROM p),
f AS (SELECT quantile_cont(delay, 0.95) AS t, avg(elapsed) AS m1, stddev_samp(elapsed) AS d1,
        avg(prev_delay) AS m2, stddev_samp(prev_delay) AS d2
      FROM q WHERE dep <= TIMESTAMP '2024-01-20')
SELECT event_id, CASE WHEN hour(dep) < 6 THEN 'Night' WHEN hour(dep) < 12 THEN 'Morning'
         WHEN hour(dep) < 18 THEN 'Afternoon' ELSE 'Evening' END AS part_of_day,
       CAST(dep AS DATE) IN (DATE '2024-01-01', DATE '2024-01-15') AS is_holiday,
       CAST(CASE WHEN delay > 15 THEN 1 ELSE 0 END AS INT) AS late,
       round(coalesce(CASE WHEN pe >= 120 THEN
         (epoch(date_trunc('second', dep)) - epoch(pa)) / 3600.0::DOUBLE END, 0.0), 6)
         AS hours_since_prev,
       prev_delay, has_previous, round(least(delay, t), 6) AS capped_delay,
       round((elapsed - m1) / d1, 6) AS elapsed_scaled,
       round((prev_delay - m2) / d2, 6) AS prev_delay_scaled
FROM q, f"""),
}
