"""Filters, splits and null handling."""

from __future__ import annotations

from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The kinds of columns a model distinguishes.
KINDS = {
    "categorical": (T.StringType,),
    "numerical": (T.IntegerType, T.FloatType, T.DoubleType),
}


def keep_completed(df: DataFrame, cancelled: str = "CANCELLED", diverted: str = "DIVERTED"):
    """Rows that were neither cancelled nor diverted; text such as "0.0" is typed first."""
    return df.filter(
        (F.col(cancelled).try_cast("double") == 0) & (F.col(diverted).try_cast("double") == 0)
    )


def status_of(cancelled: Column, diverted: Column) -> Column:
    """One status column in place of three filtered copies of the table."""
    return (
        F.when(cancelled.try_cast("double") == 1, "cancelled")
        .when(diverted.try_cast("double") == 1, "diverted")
        .otherwise("completed")
    )


def split_at(df: DataFrame, column: str, cutoff: Any) -> tuple[DataFrame, DataFrame]:
    """Rows up to and including the cutoff, and the later ones."""
    return df.filter(F.col(column) <= cutoff), df.filter(F.col(column) > cutoff)


def hold_out(df: DataFrame, column: str, value: Any) -> tuple[DataFrame, DataFrame]:
    """Rows of all other values (train) and of this value (test)."""
    return df.filter(F.col(column) != value), df.filter(F.col(column) == value)


def within(df: DataFrame, column: str, low: float | None = None, high: float | None = None):
    """Keep rows whose typed value lies in [low, high)."""
    number = F.col(column).try_cast("double")
    if low is not None:
        df = df.filter(number >= low)
    if high is not None:
        df = df.filter(number < high)
    return df


def filled(df: DataFrame, columns: list[str] | None = None) -> Column:
    """True where none of the columns is null or NaN.

    Written as one test per column, because those reach the Parquet scan; ``dropna`` does not.
    """
    tests = []
    for name in columns or df.columns:
        tests.append(F.col(name).isNotNull())
        if isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType)):
            tests.append(~F.isnan(name))
    return reduce(lambda a, b: a & b, tests)


def complete_rows(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Drop rows with a null in the given columns, or in any column."""
    return df.filter(filled(df, columns))


def completeness(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows before and after ``complete_rows`` and the difference, in one pass."""
    return df.agg(
        F.count(F.lit(1)).alias("rows_before"),
        F.count_if(filled(df, columns)).alias("rows_after"),
    ).withColumn("dropped", F.col("rows_before") - F.col("rows_after"))


def columns_of_kind(df: DataFrame, kind: str) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, KINDS[kind])]


def stack_tables(*tables: DataFrame) -> DataFrame:
    """Union by name; a column that a table lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
