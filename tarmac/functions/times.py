"""Times of day, chunks and date keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: 2015-01-01 00:00 UTC, the origin of the chunk index.
CHUNK_ORIGIN = 1420070400
# Names of the six-hour parts of a day and the hours they start at.
DAY_PARTS = ((0, "Night"), (6, "Morning"), (12, "Afternoon"), (18, "Evening"))
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def epoch_seconds(ts: Column) -> Column:
    """Whole seconds since 1970; zone-less timestamps are read in the session zone."""
    return F.unix_seconds(ts.cast("timestamp"))


def scheduled_timestamp(date: Column, hhmm: Column) -> Column:
    """Timestamp of a date and an "HHmm" text; "2400" is midnight of the next day.

    Unreadable text becomes null.
    """
    text = F.trim(hhmm)
    padded = F.when(text != "", F.lpad(text, 4, "0"))
    clock = F.when(padded == "2400", "0000").otherwise(padded)
    parsed = F.try_to_timestamp(F.concat_ws(" ", date, clock), F.lit("yyyy-MM-dd HHmm"))
    return F.when(padded == "2400", parsed + F.expr("INTERVAL 1 DAY")).otherwise(parsed)


def roll_past_midnight(start: Column, end: Column) -> Column:
    """Add a day, keeping the time of day, where the end lies before the start."""
    return F.when(end < start, end + F.expr("INTERVAL 1 DAY")).otherwise(end)


def day_part(ts: Column) -> Column:
    """Part of the day of a timestamp; null stays null."""
    hour = F.hour(ts)
    part = F.lit(None).cast("string")
    for first_hour, name in DAY_PARTS:
        part = F.when(hour >= first_hour, name).otherwise(part)
    return part


def hours_between(start: Column, end: Column) -> Column:
    return (epoch_seconds(end) - epoch_seconds(start)) / F.lit(3600.0)


def time_chunk(ts: Column, hours: int = 2) -> Column:
    """Index of the tumbling chunk of ``hours`` that holds the timestamp."""
    return F.floor((epoch_seconds(ts) - F.lit(CHUNK_ORIGIN)) / F.lit(hours * 3600)).cast("long")


def date_key(year: Column, month: Column, day: Column) -> Column:
    return year * 10000 + month * 100 + day


def date_text(year: Column, month: Column, day: Column) -> Column:
    """Date text without zero padding."""
    return F.concat_ws("-", year.cast("string"), month.cast("string"), day.cast("string"))


def hour_of_hhmm(hhmm: Column) -> Column:
    """Hour of an "HHmm" number or text, rounded down; 45 past midnight is hour 0."""
    return F.floor(hhmm.try_cast("int") / F.lit(100)).cast("int")


def nearest_hundred(hhmm: Column) -> Column:
    """``hhmm / 100`` rounded half to even."""
    return F.bround(hhmm.try_cast("int") / F.lit(100)).cast("int")


def label_of(position: Column, labels: tuple[str, ...]) -> Column:
    """Calendar label of a 1-based position."""
    return F.element_at(F.array(*[F.lit(name) for name in labels]), position)
