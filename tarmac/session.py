"""Session helpers: a local session for tests and the bench, and the shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "tarmac", cpus: int | str = 8, partitions: int = 8) -> SparkSession:
    """A session for one machine. On a cluster, pass your own session instead."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder for checkpoints and staged tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session may fall back to a
    temporary folder, because other machines cannot read one.
    """
    context = spark.sparkContext
    folder = context.getCheckpointDir()
    if folder:
        return folder
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        folder = tempfile.mkdtemp(prefix="tarmac-")
    context.setCheckpointDir(folder)
    return folder


def cut(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and cut its lineage with a reliable checkpoint."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def cut_by(df: DataFrame, *columns: str) -> DataFrame:
    """A checkpoint hash-partitioned and sorted by the columns.

    Later joins on all the columns neither shuffle nor sort it again. An adaptive plan does not
    tell its partitioning, so adaptive execution is off for the one job that stores the rows.
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return cut(df.repartition(n, *columns).sortWithinPartitions(*columns))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def new_folder(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into a Parquet table in the shared folder and read it back.

    Chosen over ``cut`` where later steps read only some of the columns.
    """
    spark = df.sparkSession
    path = new_folder(spark, "staged")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Rows over all cores, for a job that passes over them many times.

    Only where it has fewer partitions than there are cores; a large one, in however few files that
    can be split, stays as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)
