"""One-hot encoding of any width: both ways against plain Python and pyspark.ml."""

import random
from collections import Counter

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tarmac.operators import encoding, features, models

ROWS = 500


def _data():
    draw = random.Random(6)
    out = []
    for i in range(ROWS):
        # a third of the rows share one level; the text has many levels, some of them once
        out.append((i, "hot" if draw.random() < 0.34 else draw.choice(["a", "b", None, ""]),
                    f"note {draw.randrange(300)}", draw.randrange(3), draw.gauss(0, 1)))
    return out


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(_data(), "id long, k string, t string, m int, x double").repartition(4)


def _slots(drop):
    start, slots = 1, {}
    for column, at in (("k", 1), ("t", 2), ("m", 3)):
        counts = Counter(str(r[at]) for r in _data() if r[at] is not None)
        levels = sorted(counts, key=lambda v: (-counts[v], v))
        kept = levels[:-1] if drop else levels
        slots.update({(column, v): start + i for i, v in enumerate(kept)})
        start += len(kept)
    return slots, start


@pytest.mark.parametrize("drop", [False, True])
@pytest.mark.parametrize("limit, hot", [(64 << 20, 10**6), (0, 10**6), (0, 100), (0, 0)])
def test_vectors_by_either_way(spark, rows, drop, limit, hot):
    fitted = encoding.fit_encoding(rows, ["k", "t", "m"], ["x"], drop_last=drop)
    encoded = encoding.encode(rows, fitted, ["id"], broadcast_bytes=limit, hot=hot)
    want, width = _slots(drop)
    assert fitted.width == width
    got = {r.id: r for r in encoded.collect()}
    assert encoded.columns == ["id", "k", "t", "m", "x", "features"] and len(got) == ROWS
    for i, k, t, m, x in _data():
        vector = got[i].features
        slots = [want[c, str(v)] for c, v in (("k", k), ("t", t), ("m", m))
                 if v is not None and (c, str(v)) in want]
        assert vector.size == width and list(vector.indices) == [0, *sorted(slots)]
        assert list(vector.values) == [x] + [1.0] * len(slots)
    assert {(r.column, r.level): r.slot for r in encoding.slot_table(fitted).collect()} == {
        ("x", None): 0, **want}


def test_same_slots_as_the_indexer_of_pyspark_ml(spark, rows):
    known = rows.dropna().filter("k <> ''")
    fitted = encoding.fit_encoding(known, ["k", "t"], drop_last=True)
    encoded = encoding.encode(known, fitted, ["id"])
    stages = features.encoder(["k", "t"], ["x"], unseen="error").fit(known)
    theirs = stages.transform(known).select(
        "id", F.concat(vector_to_array("k_onehot"), vector_to_array("t_onehot")).alias("v"))
    ours = {r.id: r.v for r in encoded.select("id", vector_to_array("features").alias("v")).collect()}
    assert ours == {r.id: r.v for r in theirs.collect()}


@pytest.mark.parametrize("limit", [64 << 20, 0])
def test_unseen_levels_have_no_slot(spark, rows, limit):
    fitted = encoding.fit_encoding(rows.filter("m = 0"), ["m", "k"])
    other = encoding.encode(rows.filter("m = 1 AND k IS NULL"), fitted, ["id"], broadcast_bytes=limit)
    assert other.count() > 0 and all(r.features.numNonzeros() == 0 for r in other.collect())


@pytest.mark.parametrize("limit", [64 << 20, 0])
def test_models_take_the_vectors_and_empty_tables_pass(spark, rows, limit):
    fitted = encoding.fit_encoding(rows, ["t"], ["m"])
    encoded = encoding.encode(rows, fitted, ["id"], broadcast_bytes=limit)
    assert models.linear("x", regParam=0.1, solver="l-bfgs", maxIter=3).fit(encoded).numFeatures == fitted.width
    assert encoding.encode(rows.limit(0), fitted, ["id"], broadcast_bytes=limit).count() == 0
    empty = encoding.fit_encoding(rows.limit(0), ["t"])
    assert empty.width == 0 and empty.levels.count() == 0


def test_small_dictionaries_need_no_shuffle(spark, rows):
    fitted = encoding.fit_encoding(rows, ["k", "t", "m"])
    plan = encoding._slots_in_place(rows.select("id", "k", "t", "m"), fitted)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 0 and text.count("BroadcastHashJoin") == 3
