"""Exact top-k through pivots and annuli, against plain Python whole numbers."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarmac.llm import topk


def plainly(rows, asked, k, scale=64):
    def good(i, v):
        return i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)

    def whole(v):
        return [math.floor(scale * x) for x in v]

    queries = {}
    for i, v in asked:
        if good(i, v):
            queries[i] = min(queries.get(i, v), v)
    out = []
    for i, v in queries.items():
        q = whole(v)
        found = sorted((-sum(a * b for a, b in zip(q, whole(w))), j) for j, w in rows
                       if good(j, w) and j != i and len(w) == len(v))
        out += [(i, rank, j, -s) for rank, (s, j) in enumerate(found[:k], 1)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>")


def found(spark, rows, asked, k, **params):
    return sorted(tuple(r) for r in topk.exact_topk(
        frame(spark, rows).repartition(3), frame(spark, asked), k, **params).collect())


@pytest.mark.parametrize("k, dim, size, seed", [(5, 4, 150, 1), (20, 3, 90, 2), (1, 6, 200, 3)])
def test_equals_plain_python(spark, monkeypatch, k, dim, size, seed):
    for name, value in (("PER_PIVOT", 16), ("ANNULUS", 9), ("QUERIES", 7), ("FIRST", 20), ("GROWTH", 3)):
        monkeypatch.setattr(topk, name, value)
    draw = random.Random(seed)
    # a coarse grid makes scores tie; a third of the rows repeat one vector, some repeat a whole row
    rows = [(i, [draw.randint(-2, 2) / 64 * draw.choice((1, 1, 30)) for _ in range(dim)]) for i in range(size)]
    rows += [(size + i, rows[3][1]) for i in range(size // 2)] + [rows[20]] * 12 + [(40, rows[5][1])]
    rows += [(2000 + i, [draw.uniform(-1, 1) for _ in range(dim + 1)]) for i in range(9)]
    rows += [(3000, []), (3001, []), (3020, []), (3002, [0.0] * dim), (None, [1.0] * dim), (3003, None),
             (3004, [None] + [1.0] * (dim - 1)), (3005, [math.nan] * dim), (3006, [math.inf] * dim)]
    asked = [r for r in rows if r[0] is not None and r[0] % 20 == 0]
    assert found(spark, rows, asked, k) == plainly(rows, asked, k)


def test_bounds_spare_most_products_of_clustered_vectors(spark, monkeypatch):
    monkeypatch.setattr(topk, "ANNULUS", 64)
    monkeypatch.setattr(topk, "FIRST", 128)
    monkeypatch.setattr(topk, "QUERIES", 16)
    draw = np.random.default_rng(5)
    centres = draw.standard_normal((12, 16))
    vectors = centres[draw.integers(0, 12, 3000)] + 0.02 * draw.standard_normal((3000, 16))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    asked = rows[::20]
    count = spark.sparkContext.accumulator(0)
    got = found(spark, rows, asked, 5, products=count)
    whole = np.floor(64 * vectors).astype(int)
    scores = whole[::20] @ whole.T
    scores[np.arange(len(asked)), np.arange(0, 3000, 20)] = -10**9
    want = [(i * 20, rank, int(j), int(s[j])) for i, s in enumerate(scores)
            for rank, j in enumerate(np.lexsort((np.arange(3000), -s))[:5], 1)]
    assert got == sorted(want)
    assert 0 < count.value < 0.35 * len(asked) * len(rows)


def test_great_components_stay_exact_or_are_refused(spark):
    draw = random.Random(3)
    rows = [(i, [draw.uniform(-1, 1) * 2.0**22 for _ in range(3)]) for i in range(300)]
    asked = rows[::20]
    assert found(spark, rows, asked, 7) == plainly(rows, asked, 7)
    with pytest.raises(Exception, match="beyond a long"):
        found(spark, [(0, [1e200, 0.0]), (1, [1.0, 1.0])], [(0, [1e200, 0.0])], 2)


def test_few_rows_empty_tables_and_clashing_names(spark):
    rows = [(0, [1.0, 0.5]), (1, [-1.0, 0.0]), (2, [1.0, 0.5])]
    mine = {c: F.lit("mine") for c in ("id", "v", "dim", "pivot", "r", "block", "score", "rank", "query_id")}
    df = frame(spark, rows).withColumns(mine)
    got = topk.exact_topk(df, df.filter("vec_id = 0"), 20).orderBy("rank")
    assert [tuple(r) for r in got.collect()] == [(0, 1, 2, 5120), (0, 2, 1, -4096)]
    assert found(spark, rows, [], 3) == [] and found(spark, [], rows, 3) == [] and found(spark, [], [], 3) == []
    assert found(spark, [(0, [1.0])], [(0, [1.0])], 3) == []
