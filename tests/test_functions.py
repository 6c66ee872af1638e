from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tarmac.functions import holidays, numbers, text, times


def _one(spark, value, column, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column(F.col("x"))).first()[0]


@pytest.mark.parametrize("value, want", [
    (None, False), ("", False), ("GR:07", True), ("gr", True), ("RA:02", False)])
def test_extreme_weather(spark, value, want):
    assert _one(spark, value, text.has_any_code) is want


@pytest.mark.parametrize("value, want", [(None, False), ("VV:09 2", True), ("OVC:08", False)])
def test_obscured_sky(spark, value, want):
    assert _one(spark, value, text.has_marker) is want


@pytest.mark.parametrize("value, want", [
    ("0.02s", 0.02), ("", None), ("-5", -5.0), (" 12 ", 12.0), ("T", None), (None, None),
    ("0.01.3", None)])
def test_numeric_text(spark, value, want):
    assert _one(spark, value, text.numeric_text) == want


@pytest.mark.parametrize("value, want", [
    ("T", 0.005), ("0.01.3", 0.01), ("0.02s", 0.02), ("", None)])
def test_precipitation(spark, value, want):
    assert _one(spark, value, text.precipitation) == want


@pytest.mark.parametrize("dep, arr, want_dep, want_arr", [
    ("930", "1015", datetime(2015, 1, 1, 9, 30), datetime(2015, 1, 1, 10, 15)),
    ("2330", "0115", datetime(2015, 1, 1, 23, 30), datetime(2015, 1, 2, 1, 15)),
    ("2330", "2400", datetime(2015, 1, 1, 23, 30), datetime(2015, 1, 2)),
    ("5", "130", datetime(2015, 1, 1, 0, 5), datetime(2015, 1, 1, 1, 30)),
    ("abcd", "130", None, datetime(2015, 1, 1, 1, 30)),
    (None, "", None, None)])
def test_scheduled_times(spark, dep, arr, want_dep, want_arr):
    df = spark.createDataFrame([(date(2015, 1, 1), dep, arr)], "d date, dep string, arr string")
    start = times.scheduled_timestamp(F.col("d"), F.col("dep"))
    end = times.scheduled_timestamp(F.col("d"), F.col("arr"))
    row = df.select(
        start.cast("timestamp_ntz"), times.roll_past_midnight(start, end).cast("timestamp_ntz")
    ).first()
    assert tuple(row) == (want_dep, want_arr)


@pytest.mark.parametrize("hour, want", [
    (0, "Night"), (5, "Night"), (6, "Morning"), (11, "Morning"), (12, "Afternoon"),
    (17, "Afternoon"), (18, "Evening"), (23, "Evening"), (None, None)])
def test_day_part(spark, hour, want):
    value = None if hour is None else datetime(2015, 1, 1, hour)
    assert _one(spark, value, times.day_part, "timestamp_ntz") == want


@pytest.mark.parametrize("value, hour, near", [
    ("45", 0, 0), ("930", 9, 9), ("950", 9, 10), ("1050", 10, 10), ("x", None, None)])
def test_clock_hours(spark, value, hour, near):
    assert _one(spark, value, times.hour_of_hhmm) == hour
    assert _one(spark, value, times.nearest_hundred) == near


def test_chunk_and_date_keys(spark):
    moment = datetime(2015, 1, 1, 4, 0, 1)
    assert _one(spark, moment, times.time_chunk, "timestamp_ntz") == 2
    day = [F.lit(2015), F.lit(3), F.lit(7)]
    row = spark.range(1).select(times.date_key(*day), times.date_text(*day)).first()
    assert tuple(row) == (20150307, "2015-3-7")


@pytest.mark.parametrize("day, want", [
    ("2015-07-04", True), ("2015-07-03", True), ("2015-11-26", True), ("2015-12-25", True),
    ("2016-05-30", True), ("2015-03-17", False), ("2010-12-31", True), ("2020-06-19", False),
    ("2021-06-18", True), ("2021-07-05", True), ("2015-01-19", True), (None, False),
    ("1985-01-21", False), ("1986-01-20", True), ("1965-02-15", False), ("1971-02-15", True)])
def test_holidays(spark, day, want):
    value = None if day is None else date.fromisoformat(day)
    assert _one(spark, value, holidays.is_us_holiday, "date") is want


def test_cap_and_labels(spark):
    rows = [(None,), (1.0,), (15.0,), (16.0,)]
    got = spark.createDataFrame(rows, "x double").select(
        numbers.cap(F.col("x"), 10.0), numbers.over_threshold(F.col("x"))).collect()
    assert [tuple(r) for r in got] == [(None, 0), (1.0, 0), (10.0, 0), (10.0, 1)]


def test_unit_hash_is_even(spark):
    hashed = spark.range(20000).select(numbers.unit_hash(F.col("id"), 3).alias("u"))
    assert hashed.filter("u < 0.2").count() == pytest.approx(4000, rel=0.05)
    assert hashed.filter("u < 0 or u >= 1").count() == 0
