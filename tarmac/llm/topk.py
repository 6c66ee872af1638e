"""Exact largest inner products through an index of pivots and distances.

Every vector is keyed by its nearest pivot and its distance to it, sorted by that key over all tasks,
and cut into annuli: runs of neighbouring distances in the cell of one pivot. For a query at distance d
from a pivot, the triangle inequality puts every vector of an annulus [lo, hi] at least
max(0, lo - d, d - hi) away, and with the greatest norm of the annulus that bounds the inner product
from above, since 2 q.x = |q|^2 + |x|^2 - |q - x|^2. Queries expand annuli in the order of this bound,
more of them in each round, and stop when no annulus left can hold one of their k best.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import Accumulator, TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.llm.common import BROADCAST_BYTES, packed, small_side, unpacked
from tarmac.session import stage

#: Pivots of the vectors of one length, one for so many vectors at most, the lengths that have any,
#: and the bytes of all pivots. Vectors of further lengths are keyed by their distance to the origin.
PIVOTS, PER_PIVOT, LENGTHS, PIVOT_BYTES = 64, 256, 64, 16 << 20
#: Most vectors of an annulus and queries of a block, and queries multiplied at a time.
ANNULUS, QUERIES, AT_ONCE = 4096, 4096, 256
#: Vectors that a block of queries meets in its first round, and the growth of that number.
FIRST, GROWTH = 8192, 8
#: Share of the squares by which bounds are widened: far above the root of what doubles round off,
#: and far below the difference of two whole scores.
SLACK = 1e-6
LOWEST = np.iinfo(np.int64).min

KEYED = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("dim", T.IntegerType()),
    T.StructField("pivot", T.IntegerType()), T.StructField("r", T.DoubleType()),
    T.StructField("square", T.DoubleType()), T.StructField("v", T.ArrayType(T.IntegerType()))])
PACKED = T.StructType([
    T.StructField("block", T.LongType()), T.StructField("dim", T.IntegerType()),
    T.StructField("pivot", T.IntegerType()), T.StructField("n", T.IntegerType()),
    T.StructField("lo", T.DoubleType()), T.StructField("hi", T.DoubleType()),
    T.StructField("square", T.DoubleType()), T.StructField("ids", T.BinaryType()),
    T.StructField("kind", T.StringType()), T.StructField("data", T.BinaryType())])
_PACKED_ARROW = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.float64(),
                 pa.float64(), pa.binary(), pa.string(), pa.binary()]


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """``id, v, dim`` of rows with an id and a vector whose components are finite numbers."""
    rows = vectors.select(F.col(key).cast("long").alias("id"),
                          F.col(vector).cast("array<double>").alias("v")).dropna()
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.filter(~bad).withColumn("dim", F.size("v"))


def _whole(values: np.ndarray, scale: int) -> np.ndarray:
    numbers = np.floor(scale * values)
    most = float(np.abs(numbers).max()) if numbers.size else 0.0
    if most >= 2**31 or most * most * numbers.shape[1] >= 2**62:
        raise ValueError(f"components of {most:.3g} have inner products beyond a long")
    return numbers


def choose_pivots(rows: DataFrame, scale: int, seed: int) -> dict[int, np.ndarray]:
    """By length, a sample of vectors by the hash of their id; its size is bounded, see PIVOTS."""
    sizes = rows.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).orderBy(
        F.desc("n"), "dim").limit(LENGTHS).collect()
    wanted = {s.dim: min(PIVOTS, -(-s.n // PER_PIVOT), PIVOT_BYTES // (8 * max(s.dim, 1) * len(sizes)))
              for s in sizes}
    order = Window.partitionBy("dim").orderBy(F.xxhash64("id", F.lit(seed)), "v")
    few = rows.filter(F.col("dim").isin(list(wanted))).withColumn(
        "place", F.row_number().over(order)).filter(F.col("place") <= PIVOTS)
    sample: dict[int, list] = {}
    for row in few.collect() if wanted else []:
        if row.place <= wanted[row.dim]:
            sample.setdefault(row.dim, []).append(row.v)
    return {dim: np.unique(_whole(np.array(v, np.float64).reshape(len(v), dim), scale), axis=0)
            for dim, v in sample.items()}


def _pivots_of(pivots: dict[int, np.ndarray], dim: int) -> np.ndarray:
    return pivots.get(dim, np.zeros((1, dim)))


def _distances(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    squares = (vectors * vectors).sum(1)[:, None] + (pivots * pivots).sum(1) - 2 * (vectors @ pivots.T)
    return np.sqrt(np.maximum(squares, 0))


def keyed(rows: DataFrame, pivots: dict[int, np.ndarray], scale: int) -> DataFrame:
    """The whole-number vectors with nearest pivot, distance to it and squared norm."""

    def run(batches):
        for batch in batches:
            ids, lists = batch.column(0), batch.column(1)
            dims = batch.column(2).to_numpy()
            for dim in np.unique(dims):
                here = np.flatnonzero(dims == dim)
                values = lists.take(pa.array(here)).flatten().to_numpy(zero_copy_only=False)
                numbers = _whole(values.reshape(len(here), dim), scale)
                far = _distances(numbers, _pivots_of(pivots, int(dim)))
                pivot = far.argmin(1)
                ends = np.arange(len(here) + 1, dtype=np.int32) * dim
                yield pa.RecordBatch.from_arrays([
                    ids.take(pa.array(here)), pa.array(dims[here], pa.int32()),
                    pa.array(pivot, pa.int32()), pa.array(far[np.arange(len(here)), pivot]),
                    pa.array((numbers * numbers).sum(1)),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(numbers.ravel().astype(np.int32))),
                ], names=KEYED.names)

    return rows.select("id", "v", "dim").mapInArrow(run, KEYED)


def blocks(rows: DataFrame, size: int, one_cell: bool) -> DataFrame:
    """Stored runs of at most ``size`` keyed rows in the order of dim, pivot and distance.

    One sort over all tasks; each task cuts its own run. The place of a row ends the order, so equal
    rows, however many, are spread over tasks too. With ``one_cell`` a run stays within one pivot.
    """

    def run(batches):
        block, held, cell, count = TaskContext.get().partitionId() << 33, [], None, 0

        def flush():
            ids, r, square, v = (np.concatenate(parts) for parts in zip(*held))
            row = (block, cell[0], cell[1], len(ids), float(r.min()), float(r.max()), float(square.max()),
                   ids.astype(np.int64).tobytes(), *packed(v))
            return pa.RecordBatch.from_arrays(
                [pa.array([x], t) for x, t in zip(row, _PACKED_ARROW)], names=PACKED.names)

        for batch in batches:
            column = {name: batch.column(i) for i, name in enumerate(KEYED.names)}
            dims, pivots = column["dim"].to_numpy(), column["pivot"].to_numpy()
            if not one_cell:
                pivots = np.zeros_like(pivots)
            change = np.flatnonzero((np.diff(dims) != 0) | (np.diff(pivots) != 0)) + 1
            for start, stop in zip([0, *change], [*change, len(dims)]):
                if start == stop:
                    continue
                here = int(dims[start]), int(pivots[start])
                if held and here != cell:
                    yield flush()
                    block, held, count = block + 1, [], 0
                cell = here
                while start < stop:
                    take = min(stop - start, size - count)
                    held.append((*(column[c].slice(start, take).to_numpy() for c in ("id", "r", "square")),
                                 column["v"].slice(start, take).flatten().to_numpy()))
                    start, count = start + take, count + take
                    if count == size:
                        yield flush()
                        block, held, count = block + 1, [], 0
        if held:
            yield flush()

    place = F.monotonically_increasing_id()
    ordered = rows.withColumn("place", place).orderBy("dim", "pivot", "r", "id", "place")
    return stage(ordered.select(*KEYED.names).mapInArrow(run, PACKED))


def best_of(parts: list[tuple], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, id, score) arrays of the k best of each query, in their order."""
    query, ids, scores = (np.concatenate(columns) for columns in zip(*parts))
    order = np.lexsort((ids, -scores, query))
    query, ids, scores = query[order], ids[order], scores[order]
    rank = np.arange(len(query)) - np.searchsorted(query, query)
    return query[rank < k], ids[rank < k], scores[rank < k]


def scan(query_ids, queries, least, ids, vectors, k: int) -> tuple:
    """The k best of an annulus for each query, of those that reach the query's ``least`` score."""
    most = (int(np.abs(queries).max()) if queries.size else 0) * (
        int(np.abs(vectors).max()) if vectors.size else 0) * max(queries.shape[1], 1)
    kind = np.float64 if most < 2**52 else np.int64
    right, n = vectors.T.astype(kind), len(ids)
    parts = [(np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for low in range(0, len(query_ids), AT_ONCE):
        part = slice(low, low + AT_ONCE)
        scores = (queries[part].astype(kind) @ right).astype(np.int64)
        scores[query_ids[part, None] == ids] = LOWEST
        floor = np.maximum(least[part], LOWEST + 1)
        if n > k:
            floor = np.maximum(floor, np.partition(scores, n - k, axis=1)[:, n - k])
        query, at = np.nonzero(scores >= floor[:, None])
        parts.append(best_of([((query + low).astype(np.int32), ids[at], scores[query, at])], k))
    return tuple(np.concatenate(columns) for columns in zip(*parts))


def exact_topk(vectors: DataFrame, queries: DataFrame, k: int = 20, key: str = "vec_id",
               vector: str = "embedding", scale: int = 64, seed: int = 1,
               products: Accumulator | None = None) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k rows of ``vectors`` with the largest inner product.

    Each component x counts as floor(scale * x); scores are exact whole numbers. ``queries`` has the
    same columns; a row with the query's own id is no candidate of it, and neither is a vector of
    another length. Ties go to the smaller id; repeated rows are candidates as often as they are
    there. Of several queries with one id the smallest vector asks. Null ids, null vectors and
    vectors with a null or non-finite component take no part; zero and empty vectors do. Fewer
    candidates than k are all given, an empty table gives no rows, other columns are not looked at.
    Components so great that a product could pass a long are an error. ``products`` adds up the inner
    products that were computed; the bounds spare the rest.

    Vectors are shuffled once, for the index. A round joins each block of queries with annuli: packed
    rows of a few hundred kilobytes, queries broadcast while they are below 64 MB in all.
    """
    spark = vectors.sparkSession
    base = usable(vectors, key, vector)
    pivots = choose_pivots(base, scale, seed)
    annuli = blocks(keyed(base, pivots, scale), ANNULUS, one_cell=True)
    asked = usable(queries, key, vector).groupBy("id").agg(F.min("v").alias("v")).withColumn(
        "dim", F.size("v"))
    asked = blocks(keyed(asked, pivots, scale), QUERIES, one_cell=False).withColumnRenamed("block", "qblock")

    def reach(row):
        numbers = unpacked(row.kind, row.data, row.dim, row.n).astype(np.float64)
        for pivot, d in enumerate(_distances(numbers, _pivots_of(pivots, row.dim)).T):
            yield row.qblock, row.dim, pivot, float(d.min()), float(d.max()), row.square

    reached = stage(spark.createDataFrame(
        asked.rdd.flatMap(reach), "qblock long, dim int, pivot int, near double, far double, asked double"))
    gap = F.greatest(F.lit(0.0), F.col("lo") - F.col("far"), F.col("near") - F.col("hi"))
    squares = F.col("asked") + F.col("square")
    slack = SLACK * (1 + squares + F.col("far") * F.col("far") + F.col("hi") * F.col("hi"))
    catalog = annuli.select("block", "dim", "pivot", "n", "lo", "hi", "square")
    order = Window.partitionBy("qblock").orderBy(F.desc("bound"), "block")
    pairs = stage(catalog.join(small_side(reached), ["dim", "pivot"]).select(
        "qblock", "block", "n", ((squares - gap * gap) / 2 + slack).alias("bound")).select(
        "qblock", "block", "bound",
        (F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("before")))

    payload = asked.select(
        "qblock", F.col("ids").alias("query_ids"), F.col("n").alias("n_queries"),
        F.col("kind").alias("query_kind"), F.col("data").alias("queries"))
    size = asked.agg(F.sum(F.octet_length("data") + 16 * F.col("n"))).first()[0] or 0

    def verify(row):
        query_ids = np.frombuffer(row.query_ids, np.int64)
        asking = unpacked(row.query_kind, row.queries, row.dim, row.n_queries)
        least = np.full(row.n_queries, LOWEST) if row.least is None else np.frombuffer(row.least, np.int64)
        numbers = asking.astype(np.float64)
        d = _distances(numbers, _pivots_of(pivots, row.dim)[row.pivot][None])[:, 0]
        gap = np.maximum(0, np.maximum(row.lo - d, d - row.hi))
        squares = (numbers * numbers).sum(1) + row.square
        bound = (squares - gap * gap) / 2 + SLACK * (1 + squares + d * d + row.hi * row.hi)
        open_ = np.flatnonzero(bound >= least)
        if products is not None:
            products.add(len(open_) * row.n)
        query, ids, scores = scan(
            query_ids[open_], asking[open_], least[open_], np.frombuffer(row.ids, np.int64),
            unpacked(row.kind, row.data, row.dim, row.n), k)
        return row.qblock, (open_[query].astype(np.int32), ids, scores)

    def merge(a, b):
        return best_of([a, b], k)

    state_schema = ("qblock long, n_queries int, query_ids binary, query binary, ids binary, "
                    "scores binary, least binary, low double")

    def stored(found):
        qblock, (n, query_ids, (query, ids, scores)) = found
        least = np.full(n, LOWEST)
        rank = np.arange(len(query)) - np.searchsorted(query, query)
        least[query[rank == k - 1]] = scores[rank == k - 1]
        low = float(least.min())
        return (qblock, n, query_ids, query.tobytes(), ids.tobytes(), scores.tobytes(), least.tobytes(),
                -np.inf if least.min() == LOWEST else low - abs(low) * SLACK)

    def held(row):
        return row.qblock, tuple(np.frombuffer(x, t) for x, t in (
            (row.query, np.int32), (row.ids, np.int64), (row.scores, np.int64)))

    nothing = F.lit(b"")
    state = asked.select("qblock", F.col("n").alias("n_queries"), F.col("ids").alias("query_ids"),
                         nothing.alias("query"), nothing.alias("ids"), nothing.alias("scores"),
                         F.lit(None).cast("binary").alias("least"), F.lit(float("-inf")).alias("low"))
    done, upto = -1, FIRST
    while True:
        lows = state.select("qblock", "low")
        left = pairs.join(small_side(lows), "qblock").filter(
            (F.col("before") > done) & (F.col("bound") >= F.col("low"))).select("qblock", "block", "before")
        if left.isEmpty():
            break
        todo = left.filter(F.col("before") <= upto)
        n = max(2 * spark.sparkContext.defaultParallelism, todo.count() // 64)
        asking = payload.join(state.select("qblock", "least"), "qblock")
        asking = F.broadcast(asking) if size <= BROADCAST_BYTES else asking
        rows = todo.repartition(n, "block").join(annuli, "block").join(asking, "qblock")
        found = rows.rdd.map(verify)
        names = state.rdd.map(lambda row: (row.qblock, (row.n_queries, row.query_ids)))
        merged = state.rdd.map(held).union(found).reduceByKey(merge, n).join(names, n).mapValues(
            lambda both: (*both[1], both[0]))
        state = stage(spark.createDataFrame(merged.map(stored), state_schema))
        done, upto = upto, upto * GROWTH

    def ranked(row):
        query_ids = np.frombuffer(row.query_ids, np.int64)
        _, (query, ids, scores) = held(row)
        rank = np.arange(len(query)) - np.searchsorted(query, query) + 1
        yield from zip(query_ids[query].tolist(), rank.tolist(), ids.tolist(), scores.tolist())

    return spark.createDataFrame(
        state.rdd.flatMap(ranked), "query_id long, rank int, vec_id long, score long")


SQL = """
WITH v AS MATERIALIZED (SELECT vec_id, list_transform(embedding::DOUBLE[], lambda x: floor(64 * x)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding::DOUBLE[], lambda x: x IS NULL OR NOT isfinite(x))) = 0),
q AS MATERIALIZED (SELECT vec_id AS query_id, min(v) AS q FROM v WHERE vec_id % 20 = 0 GROUP BY 1),
s AS (SELECT query_id, vec_id, CAST(coalesce(list_sum(list_transform(list_zip(q, v), lambda p: p[1] * p[2])), 0)
    AS BIGINT) AS score FROM q JOIN v ON query_id <> vec_id AND len(q) = len(v)),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20"""
