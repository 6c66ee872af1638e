"""Products of block-sparse matrices and vectors.

A matrix over numbered vertices is cut into square blocks, keyed by their range of rows and of
columns; a block without entries is not there. A block holds its entries, and is multiplied densely in
the task that has it.
"""

from __future__ import annotations

import numpy as np
from pyspark import RDD
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.operators.joins import BROADCAST_BYTES, broadcast_if_small
from tarmac.operators.ordered import number_rows_and_count
from tarmac.session import cut, stage

#: Rows and columns of a block, products of two blocks that squaring may take, and those of one task's key.
SIDE, PRODUCTS, PER_KEY = 256, 200_000, 1024
MATRIX = "i int, j int, cells binary, weights binary"
VECTOR = "i int, part binary"


def _dense(cells: bytes, weights: bytes, side: int) -> np.ndarray:
    block = np.zeros(side * side)
    block[np.frombuffer(cells, np.int32)] = np.frombuffer(weights)
    return block.reshape(side, side)


def _entries(block: np.ndarray) -> tuple[bytes, bytes]:
    cells = np.flatnonzero(block).astype(np.int32)
    return cells.tobytes(), block.ravel()[cells].tobytes()


def numbered_vertices(ids: DataFrame) -> tuple[DataFrame, int]:
    """``id, at``: distinct ids with a place from 0, and how many there are."""
    numbered, n = number_rows_and_count(ids.select("id").distinct(), ["id"], "_row")
    return stage(numbered.select("id", (F.col("_row") - 1).alias("at"))), n


def to_blocks(edges: DataFrame, vertices: DataFrame, side: int) -> DataFrame:
    """Blocks of the matrix with the entries ``src, dst, weight``; one entry per pair."""
    places = broadcast_if_small(vertices)
    placed = edges.join(places.select(F.col("id").alias("src"), F.col("at").alias("_r")), "src").join(
        places.select(F.col("id").alias("dst"), F.col("at").alias("_c")), "dst")
    cell = (F.col("_r") % side) * side + F.col("_c") % side

    def pack(row):
        cells = np.array([e.cell for e in row.entries], np.int32)
        weights = np.array([e.weight for e in row.entries], np.float64)
        return row.i, row.j, cells.tobytes(), weights.tobytes()

    grouped = placed.select(
        F.floor(F.col("_r") / side).cast("int").alias("i"), F.floor(F.col("_c") / side).cast("int").alias("j"),
        F.struct(cell.cast("int").alias("cell"), F.col("weight").cast("double").alias("weight")).alias("e"),
    ).groupBy("i", "j").agg(F.collect_list("e").alias("entries"))  # side squared entries at most
    return stage(edges.sparkSession.createDataFrame(grouped.rdd.map(pack), MATRIX))


def _meetings(matrix: DataFrame) -> DataFrame:
    """Per middle range k: the products of a block that ends in it and one that starts in it."""
    left = matrix.groupBy(F.col("j").alias("k")).agg(F.count(F.lit(1)).alias("_l"))
    right = matrix.groupBy(F.col("i").alias("k")).agg(F.count(F.lit(1)).alias("_r"))
    return left.join(right, "k").select("k", (F.col("_l") * F.col("_r")).alias("products"))


def squared(matrix: DataFrame, side: int, most: int = PRODUCTS, per_key: int = PER_KEY) -> DataFrame | None:
    """The product of a stored matrix with itself, or None if that takes more than ``most`` products.

    A range in which many blocks meet is salted: its left blocks are dealt out, its right ones copied.
    """
    meetings = cut(_meetings(matrix))
    if (meetings.agg(F.sum("products")).first()[0] or 0) > most:
        return None
    salts = broadcast_if_small(meetings.select(
        "k", F.ceil(F.col("products") / per_key).cast("int").alias("_salts")))
    left = matrix.withColumnsRenamed({"j": "k", "cells": "a", "weights": "x"}).join(salts, "k").withColumn(
        "_salt", F.pmod(F.hash("i"), F.col("_salts"))).drop("_salts")
    right = matrix.withColumnsRenamed({"i": "k", "cells": "b", "weights": "y"}).join(salts, "k").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1))).drop("_salts")

    def multiply(row):
        return (row.i, row.j), _dense(row.a, row.x, side) @ _dense(row.b, row.y, side)

    added: RDD = left.join(right, ["k", "_salt"]).rdd.map(multiply).reduceByKey(np.add)
    packed = added.map(lambda pair: (*pair[0], *_entries(pair[1]))).filter(lambda row: row[2])
    return stage(matrix.sparkSession.createDataFrame(packed, MATRIX))


def to_vector(values: DataFrame, vertices: DataFrame, side: int) -> DataFrame:
    """Parts of the vector ``id, mass``; ids that are no vertices drop out."""
    placed = values.join(broadcast_if_small(vertices), "id").groupBy("at").agg(F.sum("mass").alias("mass"))

    def pack(row):
        part = np.zeros(side)
        for e in row.entries:
            part[e.at] = e.mass
        return row.i, part.tobytes()

    grouped = placed.select(
        F.floor(F.col("at") / side).cast("int").alias("i"),
        F.struct((F.col("at") % side).cast("int").alias("at"), F.col("mass").cast("double").alias("mass")).alias("e"),
    ).groupBy("i").agg(F.collect_list("e").alias("entries"))  # side entries at most
    return cut(values.sparkSession.createDataFrame(grouped.rdd.map(pack), VECTOR))


def times(vector: DataFrame, matrix: DataFrame, side: int, small: bool) -> DataFrame:
    """The row vector times the matrix, as a reliable checkpoint."""
    def multiply(row):
        return row.j, np.frombuffer(row.part) @ _dense(row.cells, row.weights, side)

    added = matrix.join(F.broadcast(vector) if small else vector, "i").rdd.map(multiply).reduceByKey(np.add)
    return cut(vector.sparkSession.createDataFrame(added.map(lambda p: (p[0], p[1].tobytes())), VECTOR))


def from_vector(vector: DataFrame, vertices: DataFrame, side: int) -> DataFrame:
    """``id, mass`` of every vertex, 0 where the vector has no part."""
    def cells(row):
        part = np.frombuffer(row.part)
        for at in np.flatnonzero(part).tolist():
            yield row.i * side + at, float(part[at])

    found = vector.sparkSession.createDataFrame(vector.rdd.flatMap(cells), "at long, mass double")
    return vertices.join(found, "at", "left").select("id", F.coalesce("mass", F.lit(0.0)).alias("mass"))


def squaring_steps(
    edges: DataFrame, ids: DataFrame, start: DataFrame, steps: int, side: int = SIDE,
    most: int = PRODUCTS, per_key: int = PER_KEY,
) -> DataFrame:
    """The state after ``steps`` steps, each of which squares the matrix after multiplying by it.

    Before each squaring the block products it takes are counted. Where they are too many the matrix
    stays as it is, and a step that wants its power 2^d multiplies the vector 2^d times instead: the
    same state, with more rounds over a matrix that is still sparse.
    """
    vertices, n = numbered_vertices(ids)
    matrix, vector = to_blocks(edges, vertices, side), to_vector(start, vertices, side)
    small, behind = n * 8 <= BROADCAST_BYTES, 0
    for step in range(steps):
        for _ in range(2**behind):
            vector = times(vector, matrix, side, small)
        if step + 1 == steps:
            break
        product = squared(matrix, side, most, per_key) if not behind else None
        if product is None:
            behind += 1
        else:
            matrix = product
    return from_vector(vector, vertices, side)
