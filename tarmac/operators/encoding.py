"""One-hot encoding of columns with any number of levels.

Levels, indexes and names are tables; the driver only learns how wide each column is. A dictionary of
measured small size is broadcast and rows are encoded where they are. A larger one is joined by level:
frequent levels, of which there are few, by broadcast, the others by a shuffle, and a vector is put
together by an aggregate over the key of its row.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.operators.joins import BROADCAST_BYTES, table_bytes
from tarmac.operators.ordered import number_rows
from tarmac.session import cut, new_folder, stage

#: A level with more rows than this is joined by broadcast; there are at most rows / HOT of them.
HOT = 1_000_000


class Encoding(NamedTuple):
    """``levels``: column, level, n, index and slot, one row per level; slots follow the numbers."""

    levels: DataFrame
    columns: list[str]
    numbers: list[str]
    width: int


def fit_encoding(
    df: DataFrame, columns: list[str], numbers: list[str] | None = None, drop_last: bool = False
) -> Encoding:
    """Number the levels of every column: most frequent first, then alphabetical.

    All columns are counted in one pass and numbered by one distributed sort. The slots of the
    columns follow each other, after one slot per number. With ``drop_last`` the last level of a column
    has no slot. Nulls are no level. A column is read as text.
    """
    numbers = numbers or []
    spark = df.sparkSession
    positions = spark.createDataFrame(list(enumerate(columns)), "position int, column string")
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    counts = texts.unpivot([], columns, "column", "level").filter(F.col("level").isNotNull()).groupBy(
        "column", "level").agg(F.count(F.lit(1)).alias("n"))
    placed = counts.join(F.broadcast(positions), "column")
    numbered = stage(number_rows(placed, ["position", F.desc("n"), "level"], "_row"))
    dropped = 1 if drop_last else 0
    sizes = numbered.groupBy("position").agg(
        F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("position").rowsBetween(Window.unboundedPreceding, -1)
    starts = cut(sizes.withColumn(  # one row per encoded column
        "_start", F.coalesce(F.sum(F.col("_size") - dropped).over(before), F.lit(0)) + len(numbers)))
    width = starts.agg(F.sum(F.col("_size") - dropped)).first()[0] or 0
    index = F.col("_row") - F.col("_first")
    levels = numbered.join(F.broadcast(starts), "position").select(
        "column", "level", "n", index.alias("index"),
        F.when(index < F.col("_size") - dropped, F.col("_start") + index).cast("int").alias("slot"))
    return Encoding(stage(levels), columns, numbers, width + len(numbers))


def slot_table(encoding: Encoding) -> DataFrame:
    """``slot, column, level`` of every slot; a number has no level."""
    spark = encoding.levels.sparkSession
    first = spark.createDataFrame(
        [(i, c, None) for i, c in enumerate(encoding.numbers)], "slot int, column string, level string")
    return first.unionByName(
        encoding.levels.filter(F.col("slot").isNotNull()).select("slot", "column", "level"))


def _sparse(slots: Column, values: list[Column], width: int) -> Column:
    """A sparse vector in the form in which ``pyspark.ml`` stores one."""
    ones = F.transform(slots, lambda _: F.lit(1.0))
    first = F.array(*[F.lit(i) for i in range(len(values))]).cast("array<int>")
    return F.struct(
        F.lit(0).cast("byte").alias("type"), F.lit(width).alias("size"),
        F.concat(first, slots).alias("indices"),
        F.concat(F.array(*values).cast("array<double>"), ones).alias("values"))


def _slots_in_place(df: DataFrame, encoding: Encoding) -> DataFrame:
    """``_slots`` of every row by one broadcast join per column, without a shuffle."""
    for i, c in enumerate(encoding.columns):
        here = encoding.levels.filter(F.col("column") == c).select(
            F.col("level").alias(f"_level{i}"), F.col("slot").alias(f"_slot{i}"))
        df = df.join(F.broadcast(here), F.col(c).cast("string") == F.col(f"_level{i}"), "left")
    slots = F.array(*[F.col(f"_slot{i}") for i in range(len(encoding.columns))])
    return df.withColumn("_slots", F.filter(slots, F.isnotnull))


def _slots_by_level(df: DataFrame, encoding: Encoding, key: list[str], hot: int) -> DataFrame:
    """The same for a dictionary of any size: one join for all columns and one aggregate by key."""
    stored = stage(df)
    pairs = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("level"))
        for c in encoding.columns])).alias("_pair")
    cells = stored.select(*key, pairs).select(*key, "_pair.*").filter(F.col("level").isNotNull())
    levels = encoding.levels.select("column", "level", "slot", "n")
    frequent = cut(levels.filter(F.col("n") > hot).drop("n"))
    names = ["column", "level"]
    found = cells.join(F.broadcast(frequent), names).unionByName(
        cells.join(F.broadcast(frequent.select(names)), names, "left_anti").join(
            levels.filter(F.col("n") <= hot).drop("n"), names))
    slots = found.filter(F.col("slot").isNotNull()).select(*key, F.lit(None).alias("_row"), "slot")
    rows = stored.select(*key, F.struct("*").alias("_row"), F.lit(None).cast("int").alias("slot"))
    return rows.unionByName(slots).groupBy(*key).agg(
        F.first("_row", ignorenulls=True).alias("_row"), F.sort_array(F.collect_list("slot")).alias("_slots")
    ).select("_row.*", "_slots")


def encode(
    df: DataFrame, encoding: Encoding, key: list[str], output: str = "features",
    broadcast_bytes: int = BROADCAST_BYTES, hot: int = HOT,
) -> DataFrame:
    """``df`` with a sparse vector of the numbers and the levels of every row.

    ``key`` names each row once. A null or unseen level sets no slot; a null number fails in whatever
    reads the vector. The vector column has no names: ``slot_table`` has them. The result is a stored
    table, since a stored vector needs no conversion.
    """
    spark = df.sparkSession
    if table_bytes(encoding.levels.select("level", "slot")) <= broadcast_bytes:
        slotted = _slots_in_place(df, encoding)
    else:
        slotted = _slots_by_level(df, encoding, key, hot)
    numbers = [F.col(c).cast("double") for c in encoding.numbers]
    made = slotted.select(*df.columns, _sparse(F.col("_slots"), numbers, encoding.width).alias(output))
    path = new_folder(spark, "encoded")
    made.write.parquet(path)
    schema = T.StructType([*df.schema.fields, T.StructField(output, VectorUDT())])
    return spark.read.schema(schema).parquet(path)
