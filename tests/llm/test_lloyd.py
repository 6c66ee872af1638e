"""Dimension-sharded Lloyd against plain Python whole numbers."""

import hashlib
import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tarmac.llm import lloyd
from tarmac.llm.common import packed, unpacked


def plainly(rows, k, rounds, dim, scale=64, seed=1):
    kept = [(i, [math.floor(scale * x) for x in v], v) for i, v in rows
            if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (
        r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[2]))
    centroids = [q for _, q, _ in order[:k]]

    def assign():
        out = []
        for i, q, _ in kept:
            far = [sum((a - b) ** 2 for a, b in zip(q, c)) for c in centroids]
            out.append((i, far.index(min(far)), min(far), q))
        return out

    for _ in range(rounds):
        found = assign()
        for c in range(len(centroids)):
            mine = [q for _, cluster, _, q in found if cluster == c]
            if mine:
                centroids[c] = [sum(column) // len(mine) for column in zip(*mine)]
    return [(i, c, d) for i, c, d, _ in assign()], centroids


def found(spark, rows, k, rounds, dim, extra=None, **params):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    if extra:
        df = df.withColumns(extra)
    assigned, centroids = lloyd.kmeans(df.repartition(3), k, rounds, dim=dim, **params)
    got = [tuple(r) for r in assigned.collect()]
    return got, [r.centroid for r in centroids.orderBy("cluster").collect()]


def key(row):
    return tuple((x is None, x) for x in row)


@pytest.mark.parametrize("k, rounds, dim, columns, size", [
    (4, 3, 7, 3, 60), (1, 2, 5, 9, 30), (9, 0, 4, 1, 25), (5, 4, 2, 1, 80)])
def test_equals_plain_python(spark, monkeypatch, k, rounds, dim, columns, size):
    monkeypatch.setattr(lloyd, "ROWS", 7)
    draw = random.Random(k)
    # a coarse grid, so that many distances tie; a third of the rows are one vector
    rows = [(i, [draw.randint(-3, 3) / 64 for _ in range(dim)]) for i in range(size)]
    rows += [(size + i, rows[0][1]) for i in range(size // 2)] + [rows[1]] * 3 + [(None, rows[2][1])]
    rows += [(900, None), (901, [0.0] * (dim + 1)), (902, [None] + [0.0] * (dim - 1)),
             (903, [math.nan] + [0.0] * (dim - 1)), (904, [math.inf] + [0.0] * (dim - 1)), (905, [])]
    want, want_centroids = plainly(rows, k, rounds, dim)
    got, centroids = found(spark, rows, k, rounds, dim, columns=columns)
    assert sorted(got, key=key) == sorted(want, key=key)
    assert centroids == want_centroids


def test_great_components_stay_exact_or_are_refused(spark):
    draw = random.Random(3)
    rows = [(i, [draw.uniform(-1, 1) * 2.0**22 for _ in range(5)]) for i in range(40)]
    want, want_centroids = plainly(rows, 3, 2, 5)
    got, centroids = found(spark, rows, 3, 2, 5, columns=2)
    assert sorted(got) == sorted(want) and centroids == want_centroids
    with pytest.raises(Exception, match="beyond a long"):
        found(spark, [(1, [1e200, 0.0])], 2, 1, 2)


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 6), st.integers(1, 4), st.integers(1, 5), st.sampled_from([9, 2**20, 2**29]), st.integers(0, 99))
def test_partial_distances_are_exact(n, k, width, most, seed):
    draw = np.random.default_rng(seed)
    rows, centroids = draw.integers(-most, most, (n, width)), draw.integers(-most, most, (k, width))
    want = [[sum((int(a) - int(b)) ** 2 for a, b in zip(r, c)) for c in centroids] for r in rows]
    assert lloyd.partial_distances(rows, centroids).tolist() == want
    assert np.array_equal(unpacked(*packed(rows), width), rows)


def test_few_rows_empty_tables_and_clashing_names(spark):
    from pyspark.sql import functions as F

    extra = {c: F.lit("mine") for c in ("cluster", "distance", "id", "v", "part", "block", "h")}
    rows = [(1, [0.5, 0.25]), (2, [0.5, 0.25])]
    got, centroids = found(spark, rows, 16, 3, 2, extra=extra)
    assert sorted(got) == [(1, 0, 0), (2, 0, 0)] and centroids == [[32, 16], [32, 16]]
    assert found(spark, [], 16, 3, 2) == ([], [])
    assert found(spark, [(1, None)], 16, 3, 2) == ([], [])
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns(extra)
    row = lloyd.clusters(df, 2, dim=2).orderBy("vec_id").first()
    assert (row.vec_id, row.cluster, row.distance, row.cluster_inertia, row.inertia) == (1, 0, 0, 0, 0)
    assert row.centroid_sha256 == hashlib.sha256(b"32,16").hexdigest()
