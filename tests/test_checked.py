"""Checked writes, headers that differ, and quantile sketches."""

import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.operators import profile
from tarmac.sources import tables

SCHEMA = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("day", T.DateType()), T.StructField("x", T.DoubleType())])
ROWS = [("1", "2024-01-02", "0.5", "extra"), ("two", "2024-01-02", "1", None), ("3", "soon", "x1", None),
        ("4", None, None, None), (None, "2024-02-30", "7", None), ("6", "2024-03-01", None, "")]


@pytest.fixture(scope="module")
def raw(spark):
    return spark.createDataFrame(ROWS, "id string, day string, x string, note string").repartition(3)


def test_good_and_bad_rows_are_written_apart_and_counted_in_that_pass(spark, raw, tmp_path):
    path = str(tmp_path / "checked")
    counts = tables.write_checked(raw, SCHEMA, path, required=["id"])
    assert counts == {"rows": 6, "rejected": 3, "rejected_id": 2, "rejected_day": 2, "rejected_x": 1}
    good = {r.id: (str(r.day), r.x) for r in tables.accepted_rows(spark, path).collect()}
    assert good == {1: ("2024-01-02", 0.5), 4: ("None", None), 6: ("2024-03-01", None)}
    bad = {r.raw: r.reasons for r in tables.rejected_rows(spark, path).collect()}
    assert {json.loads(k)["x"]: v for k, v in bad.items()} == {
        "1": ["id: not bigint"], "x1": ["day: not date", "x: not double"],
        "7": ["day: not date", "id: missing"]}
    assert all(set(json.loads(k)) == {"id", "day", "x"} for k in bad)
    plan = tables.accepted_rows(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_rejected" in plan


def test_checked_tables_may_be_empty_or_all_good(spark, raw, tmp_path):
    for name, rows in (("none", raw.limit(0)), ("good", raw.filter("id = '1'"))):
        path = str(tmp_path / name)
        counts = tables.write_checked(rows, SCHEMA, path)
        assert counts["rejected"] == 0 and counts["rows"] == (name == "good")
        if name == "good":
            assert tables.accepted_rows(spark, path).count() == 1
            assert tables.rejected_rows(spark, path).count() == 0


def test_each_file_is_read_by_its_own_header(spark, tmp_path):
    (tmp_path / "in").mkdir()
    files = {"a.csv": "id,day,x\n1,2024-01-01,0.5\n", "b.csv": 'x,note,id,day\n1.5,"a, b",2,2024-01-02\n',
             "c.csv": "id,day,x\n3,2024-01-03,2.5\n", "d.csv": "day,id,x\n", "empty.csv": ""}
    for name, text in files.items():
        (tmp_path / "in" / name).write_text(text)
    rows = tables.read_csv(spark, str(tmp_path / "in"), SCHEMA)
    assert sorted(tuple(r) for r in rows.collect()) == [
        ("1", "2024-01-01", "0.5"), ("2", "2024-01-02", "1.5"), ("3", "2024-01-03", "2.5")]
    groups = tables.files_by_header(spark, str(tmp_path / "in"))
    assert {h: len(f) for h, f in groups.items()} == {"id,day,x": 2, "x,note,id,day": 1, "day,id,x": 1}
    (tmp_path / "in" / "e.csv").write_text("id,x\n9,1\n")
    with pytest.raises(ValueError, match="no column day"):
        tables.read_csv(spark, str(tmp_path / "in"), SCHEMA)


def test_merged_sketches_stay_within_their_error(spark):
    draw = random.Random(3)
    data = [(i % 40, float(draw.choice([draw.gauss(0, 1), 7.0, draw.expovariate(0.01)]))) for i in range(20_000)]
    df = spark.createDataFrame([*data, (3, None), (4, float("nan"))], "day int, x double").repartition(6)
    sketches = profile.quantile_sketches(df, "x", ["day"])
    found = profile.quantiles_of_sketches(sketches, [0.0, 0.1, 0.5, 0.99, 1.0])
    values = sorted(x for _, x in data)
    for row in found.collect():
        below, upto = sum(x < row.value for x in values), sum(x <= row.value for x in values)
        assert row.n == 20_000 and below / row.n - 0.01 <= row.fraction <= upto / row.n + 0.01
    errors = profile.rank_errors(df.filter(~F.isnan("x")), "x", found).collect()
    assert len(errors) == 5 and all(r.error <= 0.01 for r in errors)
    wrong = found.withColumn("value", F.col("value") + 1000)
    assert profile.rank_errors(df.filter(~F.isnan("x")), "x", wrong).agg(F.max("error")).first()[0] > 0.3
    assert profile.quantiles_of_sketches(sketches.limit(0), [0.5]).count() == 0
