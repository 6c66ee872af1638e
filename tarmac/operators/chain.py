"""Operators of this library as stages of a ``pyspark.ml`` pipeline, with saved state.

A stage names a function and its arguments. ``Apply`` calls it on the rows. ``Learn`` first computes a
table from the training rows, and its fitted model, ``Learned``, keeps that table beside its
parameters. So a whole chain is split first, fitted on the training rows, saved, and read back.
"""

from __future__ import annotations

import importlib
import json

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (
    DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable,
    MLReader, MLWritable, MLWriter,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.functions import holidays, numbers, text, times
from tarmac.operators import encoding, graph
from tarmac.operators.joins import attach_scalars, attach_to_ends
from tarmac.operators.profile import averages_by, threshold
from tarmac.session import stage
from tarmac.sources.schemas import conform

PACKAGE = __name__.split(".")[0]


class _Call(Params):
    """A function of this package by its dotted name, and its further arguments as JSON."""

    function = Param(Params._dummy(), "function", "dotted name", TypeConverters.toString)
    arguments = Param(Params._dummy(), "arguments", "JSON object", TypeConverters.toString)

    def _call(self, *tables: DataFrame, name: str = "function") -> DataFrame:
        module, _, function = self.getOrDefault(name).rpartition(".")
        if module.split(".")[0] != PACKAGE:
            raise ValueError(f"{module} is no module of this library")
        return getattr(importlib.import_module(module), function)(
            *tables, **json.loads(self.getOrDefault("arguments")))


class Apply(Transformer, _Call, DefaultParamsReadable, DefaultParamsWritable):
    """``function(df, **arguments)``."""

    @keyword_only
    def __init__(self, *, function: str = "", arguments: str = "{}"):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        return self._call(df)


class _Taught(_Call):
    learn = Param(Params._dummy(), "learn", "dotted name", TypeConverters.toString)


class Learn(Estimator, _Taught, DefaultParamsReadable, DefaultParamsWritable):
    """Computes ``learn(train, **arguments)``; the model gives ``function(df, learned, **arguments)``."""

    @keyword_only
    def __init__(self, *, learn: str = "", function: str = "", arguments: str = "{}"):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> Learned:
        model = self._copyValues(Learned())
        model.learned = stage(self._call(df, name="learn"))
        return model


class _LearnedWriter(MLWriter):
    def __init__(self, model: Learned):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        self.model.learned.write.parquet(f"{path}/learned")


class _LearnedReader(MLReader):
    def load(self, path: str) -> Learned:
        model = Learned()
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        model.learned = self.sparkSession.read.parquet(f"{path}/learned")
        return model


class Learned(Model, _Taught, MLReadable, MLWritable):
    """What ``Learn`` found, a table of any size, and how to use it."""

    learned: DataFrame

    def _transform(self, df: DataFrame) -> DataFrame:
        return self._call(df, self.learned)

    def write(self) -> MLWriter:
        return _LearnedWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _LearnedReader()


def step(function, **arguments) -> Apply:
    return Apply(function=f"{function.__module__}.{function.__qualname__}", arguments=json.dumps(arguments))


def learnt(learn, function, **arguments) -> Learn:
    """A step whose two functions take the same arguments."""
    name = [f"{f.__module__}.{f.__qualname__}" for f in (learn, function)]
    return Learn(learn=name[0], function=name[1], arguments=json.dumps(arguments))


# Steps that need more than one call.


def typed(df: DataFrame, ddl: str) -> DataFrame:
    return conform(df, T.StructType.fromDDL(ddl))


def weather_flags(df: DataFrame, sky: str, codes: str) -> DataFrame:
    return df.withColumns({
        "obscured": text.has_marker(F.col(sky)).cast("int"),
        "extreme": text.has_any_code(F.col(codes)).cast("int")})


def trip_times(df: DataFrame, date: str, departure: str, arrival: str) -> DataFrame:
    """``dep`` and ``arr`` from a date and two clock texts, the part of the day, and the holiday flag."""
    dep = times.scheduled_timestamp(F.col(date), F.col(departure))
    arr = times.scheduled_timestamp(F.col(date), F.col(arrival))
    return df.withColumns({"dep": dep, "arr": times.roll_past_midnight(dep, arr)}).withColumns({
        "part_of_day": times.day_part(F.col("dep")),
        "holiday": holidays.is_us_holiday(F.col("dep")).cast("int")})


def learn_cap(train: DataFrame, column: str, fraction: float) -> DataFrame:
    return threshold(train, column, fraction)


def apply_cap(df: DataFrame, learned: DataFrame, column: str, fraction: float) -> DataFrame:
    return attach_scalars(df, learned).withColumn(
        f"capped_{column}", numbers.cap(F.col(column), F.col("threshold"))).drop("threshold")


def learn_ranks(train: DataFrame, date: str, origin: str, dest: str, rounds: int) -> DataFrame:
    """Mean over the training years of the yearly rank of every place."""
    edges = train.select(F.year(date).alias("year"), F.col(origin).alias("src"), F.col(dest).alias("dst"))
    ranks = graph.pagerank(edges, by=("year",), iterations=rounds, scale="count")
    return averages_by(ranks, "id", ["rank"]).withColumnRenamed("avg_rank", "rank")


def apply_ranks(
    df: DataFrame, learned: DataFrame, date: str, origin: str, dest: str, rounds: int
) -> DataFrame:
    """The ranks of both ends; a place that no training trip touches has rank 0."""
    ranked = attach_to_ends(df, learned, {origin: f"{origin}_rank", dest: f"{dest}_rank"})
    return ranked.fillna(0.0, [f"{origin}_rank", f"{dest}_rank"]).select(
        *df.columns, f"{origin}_rank", f"{dest}_rank")


def learn_scales(train: DataFrame, columns: list[str]) -> DataFrame:
    return train.agg(*[F.avg(c).alias(f"_mean_{c}") for c in columns],
                     *[F.stddev_samp(c).alias(f"_sd_{c}") for c in columns])


def apply_scales(df: DataFrame, learned: DataFrame, columns: list[str]) -> DataFrame:
    """Columns at mean 0 and deviation 1 of the training rows; one that is constant there becomes 0."""
    return attach_scalars(df, learned).select(*df.columns, *[
        F.when(F.col(f"_sd_{c}") == 0, 0.0).otherwise(
            F.try_divide(F.col(c) - F.col(f"_mean_{c}"), F.col(f"_sd_{c}"))).alias(f"{c}_scaled")
        for c in columns])


def learn_levels(
    train: DataFrame, key: list[str], columns: list[str], numbers: list[str], output: str
) -> DataFrame:
    return encoding.fit_encoding(train, columns, numbers).levels


def apply_levels(
    df: DataFrame, learned: DataFrame, key: list[str], columns: list[str], numbers: list[str], output: str
) -> DataFrame:
    width = learned.agg(F.max("slot")).first()[0]
    fitted = encoding.Encoding(
        learned, columns, numbers, len(numbers) if width is None else width + 1)
    return encoding.encode(df, fitted, key, output)
