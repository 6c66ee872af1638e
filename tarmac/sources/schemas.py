"""Declared schemas, and typing of text columns that never fails a job."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Names and types of the model columns of a trip table. Year and day of week are
# categories, so they stay text; clock times are "HHmm" text.
TRIPS = T.StructType(
    [T.StructField(name, T.StringType()) for name in (
        "YEAR", "DAY_OF_WEEK", "ORIGIN", "DEST", "TAIL_NUM", "OP_CARRIER", "CRS_DEP_TIME",
        "CRS_ARR_TIME", "HourlySkyConditions", "HourlyPresentWeatherType",
    )]
    + [T.StructField(name, T.IntegerType()) for name in ("MONTH", "DAY_OF_MONTH")]
    + [T.StructField("FL_DATE", T.DateType())]
    + [T.StructField(name, T.DoubleType()) for name in (
        "DEP_DELAY_NEW", "ARR_DELAY_NEW", "ACTUAL_ELAPSED_TIME", "DISTANCE", "ELEVATION",
        "HourlyDryBulbTemperature", "HourlyPrecipitation", "HourlyRelativeHumidity",
        "HourlyStationPressure", "HourlyVisibility", "HourlyWindSpeed",
    )]
)


def as_text(schema: T.StructType) -> T.StructType:
    """The same columns, all read as text."""
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Keep the columns of the schema, each cast to its type; unreadable values become null."""
    return df.select(
        [F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields]
    )


def rejects(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Per column, how many non-null values do not read as the declared type. One pass."""
    counted = df.agg(
        *[
            F.count_if(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull())
            .alias(f.name)
            for f in schema.fields
        ]
    )
    return counted.unpivot([], schema.names, "column_name", "rejected")
