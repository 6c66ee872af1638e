"""Exact ordered computations that never put an unbounded group into one task.

A plain window gathers a whole key, or without a key the whole table, in one task. The operators
here use it only below a measured number of rows. Beyond, they sort the table over all tasks
(range partitions follow the data, so a frequent key or date is split among several), number the
rows, and work on blocks of consecutive numbers. What a block needs from the one before it is
handed over as extra rows.

Every ``order`` must be total: end it with a unique column.
"""

from __future__ import annotations

from collections.abc import Mapping
from math import frexp, ldexp

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.operators.joins import attach_scalars, broadcast_if_small, same_keys
from tarmac.session import cut, stage

ROWS_PER_TASK = 1_000_000
AVERAGED_ROWS_PER_TASK = 100_000
DISTINCT_PER_TASK = 1_000_000
# Groups whose maps of values a task holds at once, before Spark sorts by group instead
# (the default of spark.sql.objectHashAggregate.sortBased.fallbackThreshold).
GROUPS_AT_ONCE = 128
MANTISSA_BITS = 52
# Width of the in-partition counter of monotonically_increasing_id (documented by Spark).
COUNTER_BITS = 33


def _staged_in_order(df: DataFrame, order: list[Column | str]) -> DataFrame:
    """Sort over all tasks and store every row with its sort task and its place in that task."""
    place = F.monotonically_increasing_id()
    stored = stage(df.orderBy(*order).withColumn("_place", place))
    return stored.select(
        "*",
        F.shiftright("_place", COUNTER_BITS).alias("_slice"),
        F.col("_place").bitwiseAND(F.lit((1 << COUNTER_BITS) - 1)).alias("_at"),
    ).drop("_place")


def _before(slices: DataFrame, total: str) -> DataFrame:
    """Sum of the slices before each one; one row per sort task, so a single window is fine."""
    earlier = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    return slices.select(
        "_slice", F.coalesce(F.sum(total).over(earlier), F.lit(0)).alias("_offset")
    )


def number_rows(df: DataFrame, order: list[Column | str], name: str = "row_num") -> DataFrame:
    """Global 1-based row number: one distributed sort, one stored table, no global window."""
    return number_rows_and_count(df, order, name)[0]


def number_rows_and_count(
    df: DataFrame, order: list[Column | str], name: str = "row_num"
) -> tuple[DataFrame, int]:
    """Numbered rows and how many there are; the count reads one column of the stored table."""
    rows = _staged_in_order(df, order)
    sizes = cut(rows.groupBy("_slice").agg(F.count(F.lit(1)).alias("n")))
    numbered = rows.join(F.broadcast(_before(sizes, "n")), "_slice").select(
        *df.columns, (F.col("_offset") + F.col("_at") + 1).alias(name)
    )
    return numbered, sizes.agg(F.sum("n")).first()[0] or 0


def _blocks(df: DataFrame, order: list[Column | str], size: int, reach: int) -> DataFrame:
    """Rows in blocks of ``size`` consecutive numbers.

    The last ``reach`` rows of a block appear a second time in the next block, with ``_home``
    false, so that a frame reaching ``reach`` rows back finds them there.
    """
    numbered = number_rows(df, order, "_row")
    block = F.floor((F.col("_row") - 1) / F.lit(size))
    handed_on = (F.col("_row") - 1) % size >= size - reach
    return (
        numbered.withColumn("_own", block)
        .withColumn(
            "_block",
            F.explode(
                F.when(handed_on, F.array("_own", F.col("_own") + 1)).otherwise(F.array("_own"))
            ),
        )
        .withColumn("_home", F.col("_block") == F.col("_own"))
    )


def previous_values(
    df: DataFrame, keys: list[str], order: list[str], values: Mapping[str, str],
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Add the value of the previous row of the same key, for several columns at once.

    ``values`` maps a new column to the column it is read from. Keys with at most
    ``rows_per_task`` rows take a plain window. The more frequent ones, of which there are at
    most rows / ``rows_per_task``, are sorted over all tasks and handled block by block.
    """
    frequent = cut(
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .filter(F.col("_rows") > rows_per_task)
        .drop("_rows")
    )
    per_key = Window.partitionBy(*keys).orderBy(*order)

    def plain(rows: DataFrame) -> DataFrame:
        return rows.select(
            "*", *[F.lag(column).over(per_key).alias(name) for name, column in values.items()]
        )

    if frequent.isEmpty():
        return plain(df)

    hint = F.broadcast(frequent)
    match = same_keys(df, hint, keys)
    rest = df.join(hint, match, "left_anti")
    split = _blocks(df.join(hint, match, "left_semi"), [*keys, *order], rows_per_task, 1)
    in_block = Window.partitionBy("_block").orderBy("_row")
    same = F.lit(True)
    for key in keys:
        same = same & F.lag(key).over(in_block).eqNullSafe(F.col(key))
    looked_back = split.select(
        *df.columns, "_home",
        *[F.when(same, F.lag(column).over(in_block)).alias(name)
          for name, column in values.items()],
    )
    return plain(rest).unionByName(looked_back.filter("_home").drop("_home"))


def moving_average(
    df: DataFrame, order: list[str], value: str, rows: int, name: str = "moving_avg",
    rows_per_task: int = AVERAGED_ROWS_PER_TASK,
) -> DataFrame:
    """Mean of the value over the last ``rows`` rows; null until that many values were seen.

    Running sums come from one distributed sort, a sum per sort task and the sums before each task.
    A frame is the difference of two of them, so its length does not matter. Every value is split
    into a multiple of a unit so large that no sum of multiples is ever rounded, and a small rest:
    nothing cancels, however far the sums have grown. A frame with a NaN or an infinity gives NaN.
    Beyond ``rows_per_task`` rows the earlier sum is joined by row number instead of looked back at.
    """
    stored = _staged_in_order(df, order)
    number = F.col(value).cast("double")
    finite = number.isNotNull() & ~F.isnan(number) & (F.abs(number) != float("inf"))
    n, largest = stored.agg(F.count(F.lit(1)), F.max(F.when(finite, F.abs(number)))).first()
    exponent = frexp(largest or 1.0)[1] + n.bit_length() - MANTISSA_BITS
    unit = F.lit(ldexp(1.0, max(exponent, -1000)))
    whole = F.when(finite, F.rint(number / unit) * unit).otherwise(0.0)
    parts = {
        "_n": F.lit(1).cast("long"), "_whole": whole, "_rest": F.when(finite, number - whole).otherwise(0.0),
        "_seen": number.isNotNull().cast("long"), "_odd": (number.isNotNull() & ~finite).cast("long"),
    }
    split = stored.withColumns(parts)
    totals = split.groupBy("_slice").agg(*[F.sum(c).alias(c) for c in parts])
    earlier = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(  # one row per sort task
        "_slice", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_before") for c in parts])
    running = Window.partitionBy("_slice").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    upto = split.join(F.broadcast(offsets), "_slice").select(
        *df.columns, *[(F.col(f"{c}_before") + F.sum(c).over(running)).alias(c) for c in parts])
    sums = [c for c in parts if c != "_n"]
    if n <= rows_per_task:
        back = Window.orderBy("_n")
        framed = upto.select("*", *[F.lag(c, rows).over(back).alias(f"{c}_then") for c in sums])
    else:
        then = upto.select(
            (F.col("_n") + rows).alias("_n"), *[F.col(c).alias(f"{c}_then") for c in sums])
        framed = upto.join(then, "_n", "left")

    def inside(part: str) -> Column:
        return F.col(part) - F.coalesce(f"{part}_then", F.lit(0))

    mean = F.when(inside("_odd") > 0, float("nan")).otherwise(
        (inside("_whole") + inside("_rest")) / F.lit(rows))
    return framed.select(*df.columns, F.when(inside("_seen") == rows, mean).alias(name))


def exact_percentiles(
    df: DataFrame, value: str, fractions: Mapping[str, float], by: list[str] | None = None,
    also: list[Column] | None = None, distinct_per_task: int = DISTINCT_PER_TASK,
) -> DataFrame:
    """Exact interpolated percentiles, optionally per group; nulls are left out.

    ``also`` are further aggregates to compute on the way.

    The built-in ``percentile`` keeps a map of the distinct values of a group in one task. It is
    used where an estimate shows that the maps are small. Otherwise the distinct values are counted
    first, sorted over all tasks, and the wanted ranks are read off the running counts.
    """
    by = by or []
    also = also or []
    widest, groups = (
        df.groupBy(*by)
        .agg(F.approx_count_distinct(value).alias("_distinct"))
        .agg(F.max("_distinct"), F.count(F.lit(1)))
        .first()
    )
    if (widest or 0) * min(groups, GROUPS_AT_ONCE) <= distinct_per_task:
        shares = F.array(*[F.lit(float(p)) for p in fractions.values()])
        found = df.groupBy(*by).agg(F.percentile(value, shares).alias("_p"), *also)
        return found.select(
            *[c for c in found.columns if c != "_p"],
            *[F.col("_p")[i].alias(name) for i, name in enumerate(fractions)],
        )

    present = df.filter(F.col(value).isNotNull())
    counted = present.groupBy(*by, value).agg(F.count(F.lit(1)).alias("_n"))
    rows = _staged_in_order(counted, [*by, value])
    sums = rows.groupBy("_slice").agg(F.sum("_n").alias("_sum"))
    running = Window.partitionBy("_slice").orderBy("_at")
    upto = rows.join(F.broadcast(_before(sums, "_sum")), "_slice").select(
        *by, value, "_n", (F.col("_offset") + F.sum("_n").over(running)).alias("_upto")
    )
    groups = upto.groupBy(*by).agg(
        F.min(F.col("_upto") - F.col("_n")).alias("_start"), F.sum("_n").alias("_size")
    )
    if by:
        groups = broadcast_if_small(cut(groups))
        ranked = upto.join(groups, same_keys(upto, groups, by)).select(
            *[upto[key] for key in by], value, "_n", "_upto", "_start", "_size"
        )
    else:
        ranked = attach_scalars(upto, groups)
    last = F.col("_upto") - F.col("_start") - 1
    first = last - F.col("_n") + 1

    def at(rank: Column) -> Column:
        return F.max(F.when((first <= rank) & (rank <= last), F.col(value)))

    wanted = []
    for name, fraction in fractions.items():
        rank = F.lit(float(fraction)) * (F.col("_size") - 1)
        wanted += [
            at(F.floor(rank)).alias(f"_lo_{name}"),
            at(F.ceil(rank)).alias(f"_hi_{name}"),
            F.max(rank - F.floor(rank)).alias(f"_part_{name}"),
        ]
    percentiles = ranked.groupBy(*by).agg(*wanted).select(
        *by,
        *[
            (F.col(f"_lo_{n}") + (F.col(f"_hi_{n}") - F.col(f"_lo_{n}")) * F.col(f"_part_{n}"))
            .alias(n)
            for n in fractions
        ],
    )
    groups = df.groupBy(*by).agg(*(also or [F.lit(1).alias("_one")]))
    whole = groups.join(percentiles, same_keys(groups, percentiles, by), "left")
    return whole.select(
        *[groups[c] for c in groups.columns if c != "_one"],
        *[percentiles[name] for name in fractions],
    )


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key, the first in the order; of equal ones that with the least other columns.

    An aggregate, not a window: every task keeps only its own best row of a key before the
    shuffle, so a key with very many rows costs no more than any other. The order columns lead the
    row that is compared, so nothing is carried twice. Behind a single order column the row is carried
    beside what is compared. Where a column has no order of its own (maps), the row is carried beside
    the order columns and equal ones go to either.
    """
    rest = [column for column in df.columns if column not in keys]
    if not rest:
        return df.distinct()
    lead = [column for column in dict.fromkeys(order) if column not in keys]
    if any(_unordered(field.dataType) for field in df.schema if field.name in rest):
        best = F.min_by(F.struct(*rest), F.struct(*lead)) if lead else F.first(F.struct(*rest))
    else:
        row = F.struct(*lead, *[column for column in rest if column not in lead])
        best = F.min_by(F.struct(*rest), row) if len(lead) == 1 else F.min(row)
    return df.groupBy(*keys).agg(best.alias("_best")).select(
        *[F.col(c) if c in keys else F.col(f"_best.{c}").alias(c) for c in df.columns]
    )


def _unordered(kind: T.DataType) -> bool:
    """Whether values of a type cannot be compared."""
    if isinstance(kind, T.StructType):
        return any(_unordered(field.dataType) for field in kind)
    if isinstance(kind, T.ArrayType):
        return _unordered(kind.elementType)
    return isinstance(kind, (T.MapType, T.VariantType))
