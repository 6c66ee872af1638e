"""Category indexes, one-hot slots, vectors and scaling."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import (
    OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler, VectorSlicer,
)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.operators.joins import attach_scalars
from tarmac.operators.ordered import number_rows


def category_index(df: DataFrame, column: str) -> DataFrame:
    """Levels of a column with their index: most frequent first, then alphabetical.

    ``slot`` is the one-hot position; the last level has none.
    """
    levels = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("level")).agg(
        F.count(F.lit(1)).alias("n")
    )
    numbered = number_rows(levels, [F.desc("n"), "level"], "_row")
    last = numbered.agg(F.max("_row").alias("_last"))
    index = F.col("_row") - 1
    return attach_scalars(numbered, last).select(
        "level", "n", index.alias("index"),
        F.when(F.col("_row") < F.col("_last"), index).alias("slot"),
    )


def standardise(df: DataFrame, columns: list[str], train: DataFrame | None = None) -> DataFrame:
    """Scale columns to mean 0 and sample deviation 1, measured on the training rows.

    A column that is constant there becomes 0.
    """
    fitted = (df if train is None else train).agg(
        *[F.avg(c).alias(f"_mean_{c}") for c in columns],
        *[F.stddev_samp(c).alias(f"_sd_{c}") for c in columns],
    )

    def scaled(c: str) -> Column:
        deviation = F.col(f"_sd_{c}")
        centred = F.col(c) - F.col(f"_mean_{c}")
        return F.when(deviation == 0, 0.0).otherwise(F.try_divide(centred, deviation))

    return attach_scalars(df, fitted).select(
        *df.columns, *[scaled(c).alias(f"{c}_scaled") for c in columns]
    )


def encoder(
    categories: list[str], numbers: list[str], output: str = "features", unseen: str = "keep"
) -> Pipeline:
    """Stages that index and one-hot categories, scale numbers and join all in one vector.

    Fit it on training rows only. ``unseen="keep"`` gives every level of the training rows a slot
    and leaves all slots empty for a new level; ``"error"`` fails on a new level and leaves the
    last known level without a slot.
    """
    return Pipeline(stages=[
        StringIndexer(
            inputCols=categories, outputCols=[f"{c}_index" for c in categories],
            stringOrderType="frequencyDesc", handleInvalid=unseen,
        ),
        OneHotEncoder(
            inputCols=[f"{c}_index" for c in categories],
            outputCols=[f"{c}_onehot" for c in categories],
        ),
        VectorAssembler(inputCols=numbers, outputCol="numbers", handleInvalid="skip"),
        StandardScaler(inputCol="numbers", outputCol="scaled", withMean=True, withStd=True),
        VectorAssembler(
            inputCols=["scaled", *[f"{c}_onehot" for c in categories]], outputCol=output
        ),
    ])


def slot_names(df: DataFrame, vector: str) -> list[str]:
    """Names of the slots of a vector column, from its metadata."""
    attributes = df.schema[vector].metadata["ml_attr"]["attrs"]
    slots = [slot for group in attributes.values() for slot in group]
    return [slot["name"] for slot in sorted(slots, key=lambda slot: slot["idx"])]


def without_slots(df: DataFrame, vector: str, names: list[str], output: str) -> DataFrame:
    """A copy of a vector without the named slots."""
    kept = [name for name in slot_names(df, vector) if name not in set(names)]
    return VectorSlicer(inputCol=vector, outputCol=output, names=kept).transform(df)
