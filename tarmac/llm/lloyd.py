"""Centroid clustering sharded by dimension, exact on whole numbers.

The vectors are cut twice: into groups of rows (parts) and into blocks of columns. A shard holds one
block of one part. In each round a shard computes the exact partial distances of its columns to its
slice of the centroids; ``reduceByKey`` adds the blocks of a part and the least sum names the nearest
centroid. The assignment goes back to the shards, which sum up their own columns by cluster, and so
each block of columns updates its own slice. No task holds more than a shard, its slice and a table of
distances of one part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tarmac.llm.common import BROADCAST_BYTES, packed, unpacked
from tarmac.session import cut, cut_by, stage

#: Columns of a block, most vectors of a part, and bytes of a part's table of distances.
COLUMNS, ROWS, TABLE_BYTES = 32, 4096, 8 << 20

def partial_distances(rows: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances over the columns given, exact: in doubles only where they cannot round."""
    most = max((int(np.abs(a).max()) if a.size else 0) for a in (rows, centroids))
    kind = np.float64 if 4 * most * most * max(rows.shape[1], 1) < 2**52 else np.int64
    a, c = rows.astype(kind), centroids.astype(kind)
    found = (a * a).sum(1)[:, None] + (c * c).sum(1) - 2 * (a @ c.T)
    return found.astype(np.int64)


def _add(a, b):
    """Sum of two packed tables of distances, packed again."""
    (columns, *left), (_, *right) = a, b
    return columns, *packed(unpacked(*left, columns) + unpacked(*right, columns))


def _floor_columns(values: pa.Array, width: int, scale: int) -> np.ndarray:
    whole = np.floor(scale * values.flatten().to_numpy(zero_copy_only=False).reshape(-1, width))
    # 2 * most is the greatest difference of two components, and its squares are summed
    most = float(np.abs(whole).max()) if whole.size else 0.0
    if 4 * most * most * max(width, 1) >= 2**63:
        raise ValueError(f"a component of {most:.3g} has squared distances beyond a long")
    return whole.astype(np.int64)


def usable(vectors: DataFrame, key: str, vector: str, dim: int) -> DataFrame:
    """``id, v`` of the vectors with exactly ``dim`` components, none null or not finite."""
    v = F.col(vector).cast("array<double>")
    return vectors.select(F.col(key).alias("id"), v.alias("v")).filter(
        F.col("v").isNotNull() & (F.size("v") == dim)).filter(
        ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))


def _shards(rows: DataFrame, dim: int, scale: int, per_part: int, columns: int) -> DataFrame:
    """Stored shards: part, block, kind and data, and the ids of the part with its first block."""
    id_kind = rows.schema["id"].dataType
    schema = T.StructType([
        T.StructField("part", T.LongType()), T.StructField("block", T.IntegerType()),
        T.StructField("kind", T.StringType()), T.StructField("data", T.BinaryType()),
        T.StructField("ids", T.ArrayType(id_kind))])
    types = [to_arrow_type(f.dataType) for f in schema]

    def run(batches):
        part = TaskContext.get().partitionId() << 33
        for batch in batches:
            for at in range(0, batch.num_rows, per_part):
                some = batch.slice(at, per_part)
                numbers = _floor_columns(some.column(1), dim, scale)
                made = [(part, block, *packed(numbers[:, low:low + columns]),
                         some.column(0).to_pylist() if not block else None)
                        for block, low in enumerate(range(0, dim, columns))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*made), types)], names=schema.names)
                part += 1

    return stage(rows.mapInArrow(run, schema))


def _first_slices(rows: DataFrame, k: int, seed: int, dim: int, scale: int, columns: int) -> DataFrame:
    """Slices of the k vectors whose id and seed hash lowest; k rows pass one task."""
    lowest = rows.withColumn("h", F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
                             ).orderBy(F.asc_nulls_last("h"), "v").limit(k)

    def slices(found):
        numbers = np.floor(scale * np.array([row.v for row in found], np.float64).reshape(-1, dim))
        numbers = numbers.astype(np.int64)
        for block, low in enumerate(range(0, dim, columns)):
            yield (block, *packed(numbers[:, low:low + columns]))

    one = lowest.coalesce(1).rdd.mapPartitions(lambda found: slices(list(found)))
    return cut(rows.sparkSession.createDataFrame(one, "block int, slice_kind string, slice binary"))


def kmeans(vectors: DataFrame, k: int = 16, rounds: int = 3, key: str = "vec_id",
           vector: str = "embedding", dim: int = 64, scale: int = 64, seed: int = 1,
           columns: int = COLUMNS) -> tuple[DataFrame, DataFrame]:
    """``(id, cluster, distance)`` of every usable vector, and the final ``(cluster, centroid)``.

    A vector takes part if it has exactly ``dim`` components, none null or not finite; each component x
    counts as floor(scale * x). Centroids start as the k vectors whose "seed:id" has the lowest SHA-256,
    ties by their components, null ids last; fewer vectors give fewer centroids. Each round assigns
    every vector to the nearest centroid by squared distance, ties to the smaller number, and sets
    every centroid that has vectors to the floor of their mean; the others stay. Then vectors are
    assigned once more. All of it is exact; components so great that a squared distance could pass a
    long are an error. Repeated rows count as often as they are there, null ids too; other columns are
    not looked at; an empty table gives no rows.

    Shuffled in a round: one table of k distances per vector and block, in the narrowest type, and one
    cluster number per vector and block. Slices are broadcast while all of them stay below 64 MB and
    joined by block beyond. Every round ends in a reliable checkpoint.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, key, vector, dim)
    per_part = max(1, min(ROWS, TABLE_BYTES // (8 * k)))
    widths = [min(columns, dim - low) for low in range(0, dim, columns)]
    stored = _shards(rows, dim, scale, per_part, columns)
    shards = cut_by(stored.select("part", "block", "kind", "data"), "part", "block")
    ids = stored.filter("block = 0").select("part", "ids")
    slices = _first_slices(rows, k, seed, dim, scale, columns)

    def beside(df):
        return df.join(F.broadcast(slices) if k * dim * 8 <= BROADCAST_BYTES else slices, "block")

    def distances(row):
        width = widths[row.block]
        centroids = unpacked(row.slice_kind, row.slice, width)
        found = partial_distances(unpacked(row.kind, row.data, width), centroids)
        return row.part, (len(centroids), *packed(found))

    def nearest(found):
        part, (n, kind, data) = found
        sums = unpacked(kind, data, n)
        best = sums.argmin(1)
        return part, best.tolist(), sums[np.arange(len(sums)), best].tolist()

    def assign():
        added = beside(shards).rdd.map(distances).reduceByKey(_add)
        return stage(spark.createDataFrame(
            added.map(nearest), "part long, clusters array<int>, distances array<long>"))

    def sums(row):
        width = widths[row.block]
        old = unpacked(row.slice_kind, row.slice, width)
        numbers, clusters = unpacked(row.kind, row.data, width), np.asarray(row.clusters)
        total = np.zeros_like(old)
        np.add.at(total, clusters, numbers)
        return row.block, (old, total, np.bincount(clusters, minlength=len(old)))

    def together(a, b):
        return a[0], a[1] + b[1], a[2] + b[2]

    def updated(found):
        block, (old, total, n) = found
        new = np.where(n[:, None] > 0, total // np.maximum(n, 1)[:, None], old)
        return (block, *packed(new))

    for _ in range(rounds):
        blocks = F.explode(F.sequence(F.lit(0), F.lit(len(widths) - 1)))
        known = assign().select("part", "clusters", blocks.alias("block"))
        own = beside(shards.join(known, ["part", "block"])).rdd.map(sums)
        slices = cut(spark.createDataFrame(own.reduceByKey(together).map(updated), slices.schema))

    last = assign().join(ids, "part").select(F.inline(F.arrays_zip(
        F.col("ids").alias("id"), F.col("clusters").alias("cluster"),
        F.col("distances").alias("distance"))))

    def columns_of(row):
        for cluster, numbers in enumerate(unpacked(row.slice_kind, row.slice, widths[row.block])):
            yield cluster, row.block, numbers.tolist()

    pieces = spark.createDataFrame(
        slices.rdd.flatMap(columns_of), "cluster int, block int, numbers array<long>")
    centroids = pieces.groupBy("cluster").agg(F.flatten(F.transform(
        F.array_sort(F.collect_list(F.struct("block", "numbers"))), lambda p: p["numbers"])).alias("centroid"))
    return last, centroids


def clusters(vectors: DataFrame, k: int = 16, key: str = "vec_id", **params) -> DataFrame:
    """One row per vector of ``kmeans``: its cluster and distance, the inertia of the cluster and of
    all, and the digest of its centroid."""
    assigned, centroids = kmeans(vectors, k, key=key, **params)
    assigned = stage(assigned)
    inertia = assigned.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    text = F.array_join(F.col("centroid").cast("array<string>"), ",")
    about = centroids.select("cluster", F.sha2(text, 256).alias("centroid_sha256")).join(
        inertia, "cluster").crossJoin(F.broadcast(assigned.agg(F.sum("distance").alias("inertia"))))
    # k rows of about a hundred bytes
    about = F.broadcast(about) if k * 128 <= BROADCAST_BYTES else about
    return assigned.join(about, "cluster").select(
        F.col("id").alias(key), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _sql(k: int = 16, rounds: int = 3, dim: int = 64, scale: int = 64, seed: int = 1) -> str:
    steps = ""
    for i in range(rounds + 1):
        steps += f""",
d{i} AS MATERIALIZED (SELECT r, c, CAST(sum((x - y) * (x - y)) AS BIGINT) AS distance
  FROM x JOIN c{i} USING (i) GROUP BY 1, 2),
a{i} AS MATERIALIZED (SELECT r, arg_min(c, (distance, c)) AS c, min(distance) AS distance FROM d{i} GROUP BY 1)"""
        if i < rounds:
            steps += f""",
m{i} AS (SELECT c, i, sum(x) AS s, count(*) AS n FROM a{i} JOIN x USING (r) GROUP BY 1, 2),
c{i + 1} AS MATERIALIZED (SELECT c, i, CAST(CASE WHEN n IS NULL THEN y
    ELSE (s - ((s % n) + n) % n) // n END AS BIGINT) AS y FROM c{i} LEFT JOIN m{i} USING (c, i))"""
    return f"""
WITH v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, embedding::DOUBLE[] AS e,
    row_number() OVER (ORDER BY sha256('{seed}:' || vec_id) NULLS LAST, embedding) - 1 AS c
  FROM embeddings WHERE len(embedding) = {dim}
    AND len(list_filter(embedding::DOUBLE[], lambda x: x IS NULL OR NOT isfinite(x))) = 0),
x AS MATERIALIZED (SELECT r, unnest(range({dim})) AS i,
    CAST(floor({scale} * unnest(e)) AS BIGINT) AS x FROM v),
c0 AS MATERIALIZED (SELECT CAST(c AS INT) AS c, i, x AS y FROM v JOIN x USING (r) WHERE c < {k}){steps},
t AS (SELECT c, CAST(sum(distance) AS BIGINT) AS cluster_inertia FROM a{rounds} GROUP BY 1),
s AS (SELECT c, sha256(string_agg(y, ',' ORDER BY i)) AS centroid_sha256 FROM c{rounds} GROUP BY 1)
SELECT vec_id, c AS cluster, distance, cluster_inertia,
  (SELECT CAST(sum(distance) AS BIGINT) FROM a{rounds}) AS inertia, centroid_sha256
FROM a{rounds} JOIN (SELECT r, vec_id FROM v) USING (r) JOIN t USING (c) JOIN s USING (c)"""


SQL = _sql()
