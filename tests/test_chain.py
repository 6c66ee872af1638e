"""Library steps as pipeline stages: fitted on some rows, saved, read back, applied to others."""

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from tarmac.operators import chain, clean
from tarmac.session import new_folder


@pytest.fixture(scope="module")
def rows(spark):
    data = [(i, "0.0" if i % 5 else "1.0", "0", f"p{i % 3}", f"p{i % 4}", float(i), "ab"[i % 2],
             f"2024-0{1 + i % 2}-03") for i in range(40)]
    data += [(99, "0.0", "0.0", "new", "p0", 1000.0, "z", "2025-01-01")]
    return spark.createDataFrame(
        data, "id long, cancelled string, diverted string, o string, d string, x double, k string, day string")


def _stages():
    return Pipeline(stages=[
        chain.step(clean.keep_completed, cancelled="cancelled", diverted="diverted"),
        chain.step(chain.typed, ddl="id long, o string, d string, x double, k string, day date"),
        chain.learnt(chain.learn_cap, chain.apply_cap, column="x", fraction=0.5),
        chain.learnt(chain.learn_ranks, chain.apply_ranks, date="day", origin="o", dest="d", rounds=3),
        chain.learnt(chain.learn_scales, chain.apply_scales, columns=["x", "d_rank"]),
        chain.learnt(chain.learn_levels, chain.apply_levels, key=["id"], columns=["k"], numbers=["x_scaled"],
                     output="features"),
    ])


def test_a_saved_chain_gives_the_same_rows_and_knows_only_its_training_rows(spark, rows):
    train = rows.filter("id < 30")
    fitted = _stages().fit(train)
    path = new_folder(spark, "chain")
    fitted.save(path)
    read = PipelineModel.load(path)
    a, b = (sorted(map(str, m.transform(rows).collect())) for m in (fitted, read))
    assert a == b and len(a) == 33
    found = {r.id: r for r in read.transform(rows).collect()}
    xs = sorted(i for i in range(30) if i % 5)
    half = (xs[11] + xs[12]) / 2
    mean = sum(xs) / len(xs)
    deviation = (sum((x - mean) ** 2 for x in xs) / (len(xs) - 1)) ** 0.5
    assert found[99].capped_x == half and found[2].capped_x == 2.0
    assert found[99].x_scaled == pytest.approx((1000 - mean) / deviation)
    assert found[99].o_rank == 0.0 and found[99].d_rank > 0
    assert found[99].features.numNonzeros() == 1 and found[2].features.size == 3


def test_an_unfitted_chain_is_saved_too(spark, rows):
    path = new_folder(spark, "chain")
    _stages().write().save(path)
    again = Pipeline.load(path).fit(rows.filter("id < 30")).transform(rows).count()
    assert again == 33


def test_only_functions_of_this_library_are_called(rows):
    with pytest.raises(ValueError, match="no module of this library"):
        chain.Apply(function="os.path.join").transform(rows)


def test_no_training_rows(spark, rows):
    none = rows.filter("id < 0")
    done = _stages().fit(none).transform(rows)
    assert done.count() == 33 and done.filter(F.col("capped_x").isNull()).count() in (0, 33)
