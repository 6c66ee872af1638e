"""Readers and writers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.sources.schemas import conform


def read_csv(
    spark: SparkSession, path: str | list[str], schema: T.StructType, sep: str = ",",
    spread: int | None = None,
) -> DataFrame:
    """The declared columns of headed CSV files, gzip included, by header name and as text.

    The files may have more columns, and each its own, in its own order. Files of equal header are
    read together, so there are as many scans as headers; one pass over the lines finds the headers.
    A file that lacks a declared column is an error. A gzip file cannot be split, so one task reads it;
    ``spread`` then distributes its rows over that many partitions.
    """
    groups = files_by_header(spark, path, sep)
    parts = []
    for header, files in groups.items():
        df = spark.read.csv(files, header=True, sep=sep, inferSchema=False, enforceSchema=False)
        missing = [name for name in schema.names if name not in df.columns]
        if missing:
            raise ValueError(f"no column {', '.join(missing)} in the header {header!r} of {files[0]}")
        parts.append(df.select(*[F.col(f"`{name}`") for name in schema.names]))
    if not parts:
        text = T.StructType([T.StructField(name, T.StringType()) for name in schema.names])
        return spark.createDataFrame([], text)
    df = reduce(DataFrame.unionByName, parts)
    return df.repartition(spread) if spread else df


def files_by_header(spark: SparkSession, path: str | list[str], sep: str = ",") -> dict[str, list[str]]:
    """Header line to the files that begin with it. Empty files are left out.

    The first line of a file lies in the one split that begins at its first byte, and that split's task
    sees it first.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")
    first = lines.filter(F.col("start") == 0).groupBy("file").agg(F.first("value").alias("header"))
    groups = first.groupBy("header").agg(F.sort_array(F.collect_list("file")).alias("files")).orderBy("header")
    return {row.header: row.files for row in groups.collect()}


def write_checked(
    df: DataFrame, schema: T.StructType, path: str, required: list[str] | None = None,
    partition_by: list[str] | None = None,
) -> dict[str, int]:
    """Type rows, write good and bad ones apart, and count both, all in the pass that writes.

    A row is bad if a value does not read as its declared type, or if a ``required`` one is missing.
    Returned are the rows, the rejected rows and, for every column with a check, its rejected values:
    observed while writing, from each task once. Bad rows are kept as JSON of the raw values, with the reasons.
    """
    required = required or []
    raw = {f.name: F.col(f"`{f.name}`") for f in schema}
    unread = {f.name: raw[f.name].isNotNull() & raw[f.name].try_cast(f.dataType).isNull() for f in schema}
    reasons = [F.when(unread[f.name], F.lit(f"{f.name}: not {f.dataType.simpleString()}")) for f in schema]
    reasons += [F.when(raw[name].isNull(), F.lit(f"{name}: missing")) for name in required]
    typed = [raw[f.name].try_cast(f.dataType).alias(f.name) for f in schema]
    failed = {name: unread[name] | (raw[name].isNull() if name in required else F.lit(False))
              for name in schema.names}
    checked = df.select(
        *typed, F.struct(*[test.alias(name) for name, test in failed.items()]).alias("_failed"), F.filter(F.array(*reasons), F.isnotnull).alias("_reasons"),
        F.to_json(F.struct(*[raw[name].alias(name) for name in schema.names]), {"ignoreNullFields": "false"}).alias("_raw"))
    bad = F.size("_reasons") > 0
    seen = Observation()
    counts = [F.count(F.lit(1)).alias("rows"), F.count_if(bad).alias("rejected")]
    counts += [F.count_if(f"_failed.{name}").alias(f"rejected_{name}") for name in schema.names]
    kept = checked.observe(seen, *counts).drop("_failed").withColumns({
        "_rejected": bad.cast("int"), "_raw": F.when(bad, F.col("_raw")), "_reasons": F.when(bad, F.col("_reasons"))})
    kept.write.mode("overwrite").partitionBy("_rejected", *(partition_by or [])).parquet(path)
    return {name: int(count) for name, count in seen.get.items()}


def accepted_rows(spark: SparkSession, path: str) -> DataFrame:
    """The good rows of a checked table."""
    rows = spark.read.option("basePath", path).parquet(path)
    return rows.filter("_rejected = 0").drop("_rejected", "_raw", "_reasons")


def rejected_rows(spark: SparkSession, path: str) -> DataFrame:
    """``raw, reasons`` of the bad rows of a checked table."""
    rows = spark.read.option("basePath", path).parquet(path)
    return rows.filter("_rejected = 1").select(F.col("_raw").alias("raw"), F.col("_reasons").alias("reasons"))


def csv_to_parquet(
    spark: SparkSession, source: str | list[str], target: str, schema: T.StructType,
    partition_by: list[str] | None = None, spread: int | None = None,
) -> None:
    """Type CSV files once and keep them as Parquet."""
    rows = read_csv(spark, source, schema, spread=spread)
    write_parquet(conform(rows, schema), target, partition_by)


def read_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    return spark.read.parquet(*paths)


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    df.write.mode("overwrite").partitionBy(*(partition_by or [])).parquet(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def write_lines(df: DataFrame, column: str, path: str) -> None:
    df.select(F.col(column).cast("string").alias("value")).write.mode("overwrite").text(path)


def local_rows(spark: SparkSession, rows: list, schema: str | T.StructType) -> DataFrame:
    """A table from a handful of literal rows."""
    return spark.createDataFrame(rows, schema)


def table_size(df: DataFrame) -> DataFrame:
    """Rows and columns of a table as one row."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "n_columns", F.lit(len(df.columns)).cast("long")
    )


def content_check(df: DataFrame, column: str) -> DataFrame:
    """Row count and latest value, to compare a table before and after a round trip."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.max(column).alias("latest"))
