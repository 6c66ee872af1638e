"""Averages, rates, null and distribution profiles."""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.functions.numbers import cap
from tarmac.functions.text import numeric_text
from tarmac.operators.clean import complete_rows
from tarmac.operators.joins import attach_scalars
from tarmac.operators.moments import correlations
from tarmac.operators.ordered import exact_percentiles, moving_average

QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}


def averages_by(
    df: DataFrame, keys: str | list[str], measures: list[str], keep: Column | None = None
) -> DataFrame:
    """Average of every measure per key; rows with a null key are left out."""
    keys = [keys] if isinstance(keys, str) else keys
    rows = complete_rows(df, keys)
    if keep is not None:
        rows = rows.filter(keep)
    return rows.groupBy(*keys).agg(*[F.avg(m).alias(f"avg_{m}") for m in measures])


def averages_for_each(df: DataFrame, keys: list[str], measure: str) -> DataFrame:
    """Average per value of every key, for many keys in one pass; null values are left out.

    Every row is offered once per key to the partial aggregate of its own task, so the shuffle
    carries only one row per key value and task.
    """
    return (
        df.select(F.col(measure).alias("_measure"), *[F.col(k).cast("string") for k in keys])
        .unpivot("_measure", keys, "key", "value")
        .filter(F.col("value").isNotNull())
        .groupBy("key", "value")
        .agg(F.avg("_measure").alias(f"avg_{measure}"), F.count(F.lit(1)).alias("n"))
    )


def smoothed_averages(
    df: DataFrame, key: str, measure: str, rows: int, keep: Column | None = None
) -> DataFrame:
    """Average per key, followed by its moving average over ``rows`` keys in key order."""
    return moving_average(averages_by(df, key, [measure], keep), [key], f"avg_{measure}", rows)


def by_numeric_text(
    df: DataFrame, column: str, number: Column | None = None, name: str = "sort_key"
) -> DataFrame:
    """Order by the number inside a text column, or by another number read from it."""
    number = numeric_text(F.col(column)) if number is None else number
    return df.withColumn(name, number).orderBy(name, column)


def highest_averages(
    df: DataFrame, key: str, measure: str, k: int = 10, keep: Column | None = None
) -> DataFrame:
    averages = averages_by(df, key, [measure], keep)
    return averages.orderBy(F.desc(f"avg_{measure}"), key).limit(k)


def counts_by(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def status_rates(df: DataFrame, key: Column, status: Column, name: str = "key") -> DataFrame:
    """Per key, the percentage of every status out of all rows of the key."""
    rows = df.select(key.alias(name), status.alias("_status")).filter(F.col(name).isNotNull())

    def percent(value: str) -> Column:
        return F.count_if(F.col("_status") == value) * 100.0 / F.count(F.lit(1))

    return rows.groupBy(name).agg(
        F.count(F.lit(1)).alias("total"),
        percent("cancelled").alias("pct_cancelled"),
        percent("diverted").alias("pct_diverted"),
    )


def null_profile(df: DataFrame) -> DataFrame:
    """Null count and percentage of every column: one aggregate, one row per column."""
    counted = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count_if(df[c].isNull()).alias(c) for c in df.columns]
    )
    return counted.unpivot(["_rows"], df.columns, "column_name", "nulls").select(
        "column_name", "nulls", F.try_divide(F.col("nulls") * 100.0, "_rows").alias("pct_null")
    )


def mostly_filled(df: DataFrame, below_percent: float = 10) -> DataFrame:
    return null_profile(df).filter(F.col("pct_null") < below_percent)


def moments(column: str) -> list[Column]:
    return [
        F.count(column).alias("n"), F.avg(column).alias("mean"),
        F.stddev_samp(column).alias("stddev"), F.min(column).alias("min"),
        F.max(column).alias("max"),
    ]


def summary(df: DataFrame, column: str, by: list[str] | None = None) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles, optionally per group."""
    return exact_percentiles(df, column, QUARTILES, by, also=moments(column))


def box_stats(df: DataFrame, column: str, by: list[str] | None = None) -> DataFrame:
    """The five numbers of a box plot."""
    return summary(df, column, by).select(*(by or []), "min", *QUARTILES, "max")


def correlation(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.agg(F.corr(a, b).alias("correlation"))


def correlation_table(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlation of every pair of columns, for many columns, from one scan."""
    return correlations(df, columns).select("a", "b", "correlation")


def histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """Counts in equal bins from the least to the greatest value; the last bin is closed."""
    value = F.col(column)
    spread = df.agg(F.min(column).alias("_lo"), F.max(column).alias("_hi"))
    width = (F.col("_hi") - F.col("_lo")) / F.lit(bins)
    place = F.when(width == 0, F.lit(0)).otherwise(
        F.least(F.floor((value - F.col("_lo")) / F.when(width != 0, width)), F.lit(bins - 1))
    )
    return (
        attach_scalars(complete_rows(df.select(column)), spread)
        .groupBy(place.cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def cap_at_percentile(df: DataFrame, column: str, fraction: float, name: str) -> DataFrame:
    """Cap a column at its own exact percentile. Fit on training rows with ``threshold``."""
    return attach_scalars(df, threshold(df, column, fraction)).withColumn(
        name, cap(F.col(column), F.col("threshold"))
    )


def threshold(df: DataFrame, column: str, fraction: float) -> DataFrame:
    return exact_percentiles(df, column, {"threshold": fraction})


def approximate_threshold(
    df: DataFrame, column: str, fraction: float, rank_error: float = 0.01
) -> DataFrame:
    """A value whose rank is within ``rank_error`` of the wanted one."""
    accuracy = round(1 / rank_error)
    return df.agg(F.percentile_approx(column, fraction, accuracy).alias("threshold"))


def quantile_sketches(df: DataFrame, column: str, by: list[str], rank_error: float = 0.01) -> DataFrame:
    """``by, n, sketch``: a mergeable quantile sketch of every group, to be kept and merged later."""
    # How the rank error of a KLL sketch follows from its size.
    k = ceil((2.296 / rank_error) ** (1 / 0.9021))
    value = F.col(column).cast("double")
    return df.filter(value.isNotNull() & ~F.isnan(value)).groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double(value, k).alias("sketch"))


def quantiles_of_sketches(
    sketches: DataFrame, fractions: list[float], by: list[str] | None = None
) -> DataFrame:
    """``by, n, fraction, value``: approximate quantiles of merged sketches, without the rows."""
    by = by or []
    merged = sketches.groupBy(*by).agg(
        F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch")).filter(F.col("n") > 0)
    wanted = F.array(*map(F.lit, fractions))
    pairs = F.arrays_zip(
        wanted.alias("fraction"), F.kll_sketch_get_quantile_double("sketch", wanted).alias("value"))
    return merged.select(*by, "n", F.inline(pairs))


def rank_errors(df: DataFrame, column: str, quantiles: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Quantiles with ``error``: how far the exact ranks of the value are from the wanted one, in shares.

    A value has all the ranks from its first row to its last one, and the nearest of them counts.
    """
    by = by or []
    # a row per group and fraction
    wanted = F.broadcast(quantiles.select(*by, "fraction", "value"))
    rows = df.select(*by, F.col(column).cast("double").alias("_x")).dropna()
    met = rows.join(wanted, by) if by else rows.crossJoin(wanted)
    counted = met.groupBy(*by, "fraction", "value").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("_x") < F.col("value")).alias("_below"),
        F.count_if(F.col("_x") <= F.col("value")).alias("_upto"))
    return counted.select(*by, "n", "fraction", "value", F.greatest(
        F.lit(0.0), F.col("_below") / F.col("n") - F.col("fraction"),
        F.col("fraction") - F.col("_upto") / F.col("n")).alias("error"))
