"""Fill-in-the-middle: against plain strings, and the way back of every row."""

import hashlib
import re

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tarmac.llm import fim


def plainly(text, key, rate=100, spm=50, seed=7):
    text = text or ""
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digest[i:i + 8], 16) for i in range(0, 32, 8)]
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(lines)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    x, m, s = ("".join(part) for part in (lines[:a], lines[a:b], lines[b:]))
    if not text or any(mark in text for mark in fim.MARKERS) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    if h[3] % 100 < spm:
        return n, "spm", len(x), len(m), f"<S>{s}<P>{x}<M>{m}"
    return n, "psm", len(x), len(m), f"<P>{x}<S>{s}<M>{m}"


def numbers(key):
    digest = hashlib.sha256(f"7:{key}".encode()).hexdigest()
    return [int(digest[i:i + 8], 16) for i in range(0, 32, 8)]


pieces = st.lists(st.sampled_from(
    ["\n", "\n\n", "a", "é", "漢字", "🙂", "<", ">", "<P", "S>", "<P>", "<S>", "<M>", " ", "\r\n"]), max_size=12)


@settings(max_examples=300, deadline=None)
@given(st.lists(pieces.map("".join), max_size=6), st.sampled_from([1, 3, 1 << 20]), st.integers(0, 3))
def test_batches_equal_plain_strings(texts, shifts, skipped):
    import numpy as np

    column = pa.array([*["skipped\n"] * skipped, *texts], pa.string()).slice(skipped)
    draws = np.array([numbers(i) for i in range(len(texts))], np.int64).reshape(-1, 4)
    before, fim.SHIFTS = fim.SHIFTS, shifts
    try:
        made = fim.cut_and_move(column, draws, 100, 50, fim.MARKERS)
        back = fim.move_back(made.field("output"), made.field("form"), fim.MARKERS)
    finally:
        fim.SHIFTS = before
    assert [tuple(row.values()) for row in made.to_pylist()] == [
        plainly(text, i) for i, text in enumerate(texts)]
    assert back.to_pylist() == texts


def test_table_with_nulls_long_texts_repeats_and_clashing_names(spark):
    long = "".join(f"line {i} ü\n" for i in range(300_000))
    rows = [(1, "a\nb\nc\nd", "x"), (1, "a\nb\nc\nd", "x"), (2, None, None), (None, "one\ntwo\n", "y"),
            (3, "", "z"), (4, long, "w"), (5, "with <S> inside\nand more", "v"), (6, "\n\n\n", "u")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, draws string").withColumns(
        {"FIM": fim.F.lit(3), "restored": fim.F.lit(4.0), "form": fim.F.lit("mine")})
    done = fim.restore(fim.fill_in_middle(docs))
    assert done.columns == ["doc_id", "text", "draws", "form", "fim", "restored"]
    got = done.collect()
    assert len(got) == len(rows)
    for row in got:
        assert tuple(row.fim) == plainly(row.text, row.doc_id)
        assert row.restored == (row.text or "") and row.form == "mine"
    assert fim.fill_in_middle(docs.limit(0)).count() == 0


def test_rate_and_forms_are_parameters(spark):
    docs = spark.range(300).selectExpr("id AS doc_id", "concat('a', id, '\nb\nc\n') AS text")
    rows = fim.restore(fim.fill_in_middle(docs, rate=40, spm=0, seed=9)).collect()
    for row in rows:
        assert tuple(row.fim) == plainly(row.text, row.doc_id, 40, 0, 9) and row.restored == row.text
    assert {row.fim.form for row in rows} == {"plain", "psm"}


def test_other_markers_null_and_broken_outputs(spark):
    marks = ("[pre]", "(suf)", "{mid}")
    docs = spark.createDataFrame([(7, "x\ny\nz\n[pre"), (8, "<P>\n<S>\n")], "doc_id long, text string")
    done = fim.fill_in_middle(docs, markers=marks)
    assert all(r.fim.form != "plain" for r in done.collect())
    assert all(r.restored == r.text for r in fim.restore(done, markers=marks).collect())
    empty = spark.sql("SELECT named_struct('output', CAST(NULL AS STRING), 'form', 'psm') AS fim")
    assert fim.restore(empty).first().restored is None
    for output in ("no markers", "<S>a<P>b<M>c", "<P>a<S>b<M>c<M>"):
        with pytest.raises(ValueError):
            fim.move_back(pa.array([output]), pa.array(["psm"]), fim.MARKERS)
    for bad in (("<P>", "<P>", "<M>"), ("<<P>", "<S>", "<M>"), ("<P>", "P", "<M>"), ("", "a", "b")):
        with pytest.raises(ValueError):
            fim.fill_in_middle(docs, markers=bad)
