"""Joins with small tables whose size is counted before they are broadcast."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS, BROADCAST_BYTES = 500_000, 64 << 20
ROW_BYTES = 24  # of a value that is not text, and beside the bytes of one that is


def table_bytes(table: DataFrame) -> int:
    """About how much memory the rows take: the bytes of their text and a fixed part per value."""
    size = sum((F.coalesce(F.octet_length(c), F.lit(0)) if kind in ("string", "binary") else F.lit(0))
               + ROW_BYTES for c, kind in table.dtypes)
    return table.agg(F.sum(size.cast("long"))).first()[0] or 0


def broadcast_if_small(table: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast if the table has at most ``max_rows`` rows, and 64 MB in all.

    The measure is a job of its own: pass a stored table, not a long plan. Above the bound the
    table keeps no hint, and the sort-merge join relies on AQE to split skewed keys.
    """
    small = table.count() <= max_rows and table_bytes(table) <= BROADCAST_BYTES
    return F.broadcast(table) if small else table


def same_keys(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    """Null-safe equality on the key columns."""
    condition = F.lit(True)
    for key in keys:
        condition = condition & left[key].eqNullSafe(right[key])
    return condition


def attach_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Append the columns of a one-row aggregate to every row."""
    return df.crossJoin(F.broadcast(one_row))


def attach_to_ends(
    df: DataFrame, ranks: DataFrame, ends: Mapping[str, str], value: str = "rank",
    vertex: str = "id", by: tuple[str, ...] = (), max_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Left-join one vertex table several times, once for every end column.

    ``ends`` maps an end column to the name of its new value column. ``by`` names columns that
    must match too, for example the year of the rank.
    """
    hinted = broadcast_if_small(ranks, max_rows)
    for end, name in ends.items():
        lookup = hinted.select(*by, F.col(vertex).alias(end), F.col(value).alias(name))
        df = df.join(lookup, [*by, end], "left")
    return df
