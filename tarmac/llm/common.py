"""Small helpers the operators share."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Upper-case and lower-case ASCII letters, the only ones that several contracts fold.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: A side of a join is broadcast only when its measured size stays below this.
BROADCAST_BYTES = 64 << 20

#: Python works on about so many bytes of rows at a time, so that what it makes of them stays small.
SLICE_BYTES = 2 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once for a row, however often ``use`` names it."""
    return F.transform(F.array(value), use)[0]


def ascii_lower(text: Column) -> Column:
    """A-Z folded, every other character as it is. Pure ASCII takes the quick built-in way."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER))


def small_side(df: DataFrame) -> DataFrame:
    """``df`` with a broadcast hint if its measured size is below the bound.

    Beyond the bound the join is left to a shuffle, with the same result. ``df`` is read twice, so
    pass one that is stored.
    """
    width = sum((F.coalesce(F.octet_length(c), F.lit(0)) if kind == "string" else F.lit(0)) + 24
                for c, kind in df.dtypes)
    size = df.select(F.sum(width.cast("long")).alias("size")).first()["size"] or 0
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


_KINDS = (np.int8, np.int16, np.int32, np.int64)


def packed(numbers: np.ndarray) -> tuple[str, bytes]:
    """Whole numbers in the narrowest type that holds them all: its name and the bytes."""
    low, high = (int(numbers.min()), int(numbers.max())) if numbers.size else (0, 0)
    kind = next(k for k in _KINDS if np.iinfo(k).min <= low and high <= np.iinfo(k).max)
    return np.dtype(kind).name, numbers.astype(kind).tobytes()


def unpacked(kind: str, data: bytes, columns: int, rows: int = -1) -> np.ndarray:
    return np.frombuffer(data, kind).reshape(rows, columns).astype(np.int64)


def append_columns(df: DataFrame, inputs: list[str], schema: str, make) -> DataFrame:
    """``df`` with the columns of ``schema``, computed in Python from the ``inputs`` columns.

    ``make`` takes an iterator over batches, each a tuple of lists, and yields for each batch a list
    of rows in the form of tuples. Batches pass as Arrow, in slices; other columns are not converted. Unlike
    a function in a projection, this step accepts any plan below it. A new column takes the place of
    one that has its name, which is given up, also where it was an input.
    """
    import pyarrow as pa
    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_type

    added = T.StructType.fromDDL(schema)
    kinds = [to_arrow_type(field.dataType) for field in added]
    taken = {name.lower() for name in added.names}
    fields = [field for field in df.schema.fields if field.name.lower() not in taken]
    kept = [field.name for field in fields]

    def parts(batch):
        rows = max(1, int(batch.num_rows * SLICE_BYTES / max(batch.nbytes, 1)))
        return (batch.slice(at, rows) for at in range(0, batch.num_rows, rows))

    def run(batches):
        held = []

        def given():
            for batch in (part for whole in batches for part in parts(whole)):
                held.append(batch)
                yield tuple(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in inputs)

        for rows in make(given()):
            batch = held.pop(0)
            columns = list(zip(*rows)) if rows else [[] for _ in kinds]
            new = [pa.array(values, kind) for values, kind in zip(columns, kinds)]
            held_columns = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            yield pa.RecordBatch.from_arrays([*held_columns, *new], names=kept + added.names)

    return df.mapInArrow(run, T.StructType(fields + added.fields))


def unused(df: DataFrame, name: str) -> str:
    """``name``, with so many underscores behind it that no column of ``df`` has it."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def folder_on(folder: str):
    """The file system of a folder that all executors reach, and the folder's path on it."""
    from pyarrow import fs

    if "://" not in folder and not folder.startswith("file:"):
        folder = f"file://{folder}"
    return fs.FileSystem.from_uri(folder.replace("file:///", "file:/").replace("file:/", "file:///"))
