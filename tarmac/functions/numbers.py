"""Caps, labels and sampling hashes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def cap(x: Column, threshold: Column | float) -> Column:
    """The smaller of the value and the threshold; null stays null."""
    threshold = threshold if isinstance(threshold, Column) else F.lit(threshold)
    return F.when(x > threshold, threshold).otherwise(x)


def over_threshold(x: Column, threshold: float = 15) -> Column:
    """1 where the value exceeds the threshold, else 0; null counts as 0."""
    return F.when(x > threshold, 1).otherwise(0)


def clip_at_zero(x: Column) -> Column:
    return F.when(x < 0, F.lit(0.0)).otherwise(x)


def unit_hash(key: Column, seed: int = 0) -> Column:
    """A number in [0, 1) fixed by the key and the seed.

    Unlike ``rand`` it does not depend on partitions or task attempts, so a sample stays the same
    when a lost task is run again.
    """
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), key.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
