"""Nearest neighbours by collision counting over query-centred windows.

Every vector is projected on the same random lines, and each line's projections are kept as a sorted
array. A query opens a window around its own projection on every line and widens it step by step
(virtual rehashing: the same arrays serve all widths). A vector that lies in the windows of enough
lines is verified with its exact cosine. The search of a block ends when k verified vectors are
nearer than the width answers for, or when the windows hold the whole block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarmac.session import cut

#: Lines, the share of them a candidate must collide on, first half-width and its growth.
LINES, SHARE, WIDTH, GROWTH = 30, 0.6, 0.25, 1.3
#: Vectors and queries of a block: a task holds one block of each.
BLOCK, QUERIES = 8192, 512


def _lines(dim: int, seed: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64([seed, dim])).standard_normal((LINES, dim))


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1."""
    scaled = _near_one(vectors)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def cosine(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Exact cosines on the original vectors, summed alike whatever stands beside a vector.

    Each vector is first brought near 1 by a power of two, which rounds nothing that counts, so that
    no square leaves the range of a double.
    """
    query, vectors = _near_one(query[None, :])[0], _near_one(vectors)
    return ((vectors * query).sum(axis=1)
            / (np.sqrt((query * query).sum()) * np.sqrt((vectors * vectors).sum(axis=1))))


def _near_one(vectors: np.ndarray) -> np.ndarray:
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1, initial=0.0, keepdims=True))[1])


def search_block(query_ids, queries, ids, vectors, k: int, seed: int, times=None):
    """(query id, vector id, cosine) of the k nearest found for each query in one block.

    Of unit vectors, the distance on a standard normal line is normal with the vectors' distance as
    its deviation. A window of half-width w holds a vector at distance d with probability
    P(|N| <= w / d): 0.73 for d = w / 1.1, above the asked share. So vectors within w / 1.1 collide
    often enough, and k verified ones within it end the search. ``times`` says how often each vector
    is there, once by default; it is given that often, k times at most.
    """
    lines = _lines(vectors.shape[1], seed)
    unit, unit_queries = _unit(vectors), _unit(queries)
    shadows = unit @ lines.T
    order = np.argsort(shadows, axis=0, kind="stable").astype(np.int32).T.copy()
    arrays = np.take_along_axis(shadows, order.T, axis=0).T.copy()
    spots = unit_queries @ lines.T
    needed = int(np.ceil(SHARE * LINES))
    n = len(ids)
    middle = np.stack([np.searchsorted(a, x) for a, x in zip(arrays, spots.T)], axis=1)
    lows, highs = middle.copy(), middle
    # of each open query: collisions by vector, the verified vectors and their cosines
    counts = {q: np.zeros(n, np.uint8) for q in range(len(queries))}
    known = {q: np.zeros(n, bool) for q in range(len(queries))}
    seen = {q: (np.zeros(0, np.int64), np.zeros(0)) for q in range(len(queries))}
    best: dict[int, tuple] = {}
    width = WIDTH
    live = list(range(len(queries)))
    while live:
        low = np.stack([np.searchsorted(a, x - width, "left") for a, x in zip(arrays, spots[live].T)], 1)
        high = np.stack([np.searchsorted(a, x + width, "right") for a, x in zip(arrays, spots[live].T)], 1)
        still = []
        for at, q in enumerate(live):
            count = counts[q]
            for j in range(LINES):  # a line names a vector once, so its places are distinct
                count[order[j, low[at, j]:lows[q, j]]] += 1
                count[order[j, highs[q, j]:high[at, j]]] += 1
            lows[q], highs[q] = low[at], high[at]
            rows, scores = seen[q]
            fresh = np.flatnonzero(count >= needed)
            fresh = fresh[~known[q][fresh]]
            known[q][fresh] = True
            fresh = fresh[ids[fresh] != query_ids[q]]
            rows = np.concatenate([rows, fresh])
            scores = np.concatenate([scores, unit[fresh] @ unit_queries[q]])
            seen[q] = rows, scores
            kth = np.partition(scores, -k)[-k] if len(rows) >= k else -np.inf
            if not (high[at] - low[at] == n).all() and 2 - 2 * kth > (width / 1.1) ** 2:
                still.append(q)
                continue
            rows = rows[scores >= kth - 1e-9]  # rounding aside, the k best; then the exact measure
            scores = cosine(queries[q], vectors[rows])
            top = np.lexsort((ids[rows], -scores))[:k]
            if times is not None:
                top = np.repeat(top, np.minimum(times[rows[top]], k))[:k]
            best[q] = (np.full(len(top), query_ids[q]), ids[rows[top]], scores[top])
            del counts[q], known[q], seen[q]
        live = still
        width *= GROWTH
    if not best:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    return tuple(np.concatenate(x) for x in zip(*best.values()))


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """``id, v, dim`` of the vectors that are not null, empty or zero and hold finite numbers only."""
    v = F.col(vector).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.filter(F.col(key).isNotNull() & F.col(vector).isNotNull()).filter(
        ~bad & F.exists(v, lambda x: x != 0)).select(
        F.col(key).cast("long").alias("id"), v.alias("v"), F.size(v).alias("dim"))


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5, key: str = "vec_id",
            vector: str = "embedding", seed: int = 7) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest rows of ``vectors`` by cosine.

    ``queries`` are rows with the same columns; a row with the query's own id is no candidate of it.
    Both sides are cut into blocks by hash, and each pair of blocks is one small search with its own
    arrays, so no task holds more than BLOCK vectors and QUERIES queries on average. The best k of
    each block meet in a last ranking. Ties go to the smaller id. Null, empty and zero vectors and
    those with a null or non-finite component, and null ids, take no part; vectors of another length
    than the query's are no candidates. Repeated rows are one row with a count until they are found,
    then given as often as they are there; repeated queries are answered once, and of several
    vectors under one query id the least, compared part by part, is asked. Fewer candidates than k are all given; empty tables give no rows.
    """
    base = cut(usable(vectors, key, vector).groupBy("id", "v", "dim").agg(
        F.count(F.lit(1)).alias("times")))
    asked = cut(usable(queries, key, vector).groupBy("id").agg(F.min("v").alias("v")).withColumn("dim", F.size("v")))
    v_blocks = max(1, -(-base.count() // BLOCK))
    q_blocks = max(1, -(-asked.count() // QUERIES))

    def block(n: int, salt: int):
        return F.pmod(F.xxhash64(F.lit(salt), "id", "v"), F.lit(n)).cast("int")

    left = asked.withColumn("qb", block(q_blocks, 1)).withColumn(
        "vb", F.explode(F.sequence(F.lit(0), F.lit(v_blocks - 1))))
    right = base.withColumn("vb", block(v_blocks, 2)).withColumn(
        "qb", F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))))

    def search(q: pd.DataFrame, v: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(v):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype(
                {"query_id": "int64", "vec_id": "int64", "score": "float64"})
        found = search_block(q["id"].to_numpy(), np.stack(q["v"]), v["id"].to_numpy(),
                             np.stack(v["v"]), k, seed, v["times"].to_numpy())
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), found)))

    keys = ["qb", "vb", "dim"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(
        search, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
