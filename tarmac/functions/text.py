"""Flags and numbers out of dirty text columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The sky marker and the present-weather codes that count as extreme.
OBSCURED_SKY = "VV"
EXTREME_WEATHER = ("GR", "GS", "VA", "DU", "SA", "PO", "SQ", "FC", "SS", "DS")
# Fixed value: inches that stand for a trace ("T") of rain.
TRACE_PRECIPITATION = "0.005"


def has_marker(text: Column, marker: str = OBSCURED_SKY) -> Column:
    """True where the text contains the marker; null text is false."""
    return F.coalesce(text.contains(marker), F.lit(False))


def has_any_code(text: Column, codes: Sequence[str] = EXTREME_WEATHER) -> Column:
    """True where the upper-cased text contains one of the codes anywhere; null is false."""
    return F.coalesce(F.upper(text).rlike("|".join(codes)), F.lit(False))


def numeric_text(text: Column) -> Column:
    """Strip everything but digits and dots, keep a leading minus, and read a double.

    Text without a readable number becomes null instead of failing under ANSI mode.
    """
    sign = F.when(F.trim(text).startswith("-"), "-").otherwise("")
    return F.concat(sign, F.regexp_replace(text, "[^0-9.]", "")).try_cast("double")


def precipitation(text: Column) -> Column:
    """Rain amount: a trace has a fixed value, and only the first two dot parts count."""
    amount = F.when(F.trim(text) == "T", TRACE_PRECIPITATION).otherwise(
        F.substring_index(text, ".", 2)
    )
    return numeric_text(amount)
