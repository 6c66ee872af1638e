"""The registered queries of the subpackage: against SQL where there is one, else that they run."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from check import compare, connect  # noqa: E402

import corpus_pipeline  # noqa: E402
from tarmac.llm import language, linededup, simhash  # noqa: E402
from tarmac.llm.common import table  # noqa: E402
from tarmac.llm.queries import QUERIES  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    assert compare(spark, connect(FOLDER), name, FOLDER) == ""


def test_held_out_languages(spark):
    docs = table(spark, FOLDER, "documents")
    rows = language.language_id(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert rows and sum(r.lang == r.lang_pred for r in rows) >= 0.95 * len(rows)


def test_pipeline_stages_equal_plain_steps(spark):
    docs = table(spark, FOLDER, "documents")
    first = corpus_pipeline.STAGES[0][1](spark, docs, FOLDER)
    assert first.count() == sum(any(c.isalpha() for c in r.text or "") for r in docs.collect())
    kept = first
    for _, stage in corpus_pipeline.STAGES[1:4]:
        kept = stage(spark, kept, FOLDER)
        assert kept.columns == docs.columns
    lines = linededup.drop_repeated_lines(first)
    groups = simhash.near_duplicates(lines)
    lowest = {r.component_id for r in groups.collect()}
    assert {r.doc_id for r in simhash.drop_near_duplicates(lines).collect()} == lowest
    done = corpus_pipeline.run(spark, FOLDER).collect()
    texts = {r.doc_id: r.text for r in kept.collect()}
    assert {r.doc_id: r.decoded for r in done} == texts and texts
