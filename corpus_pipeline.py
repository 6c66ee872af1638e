"""From raw documents to token ids: five stages, each on all that the one before it kept.

A stage takes (spark, docs, sf_dir) and returns a table that is written and read again as the next
stage's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tarmac.llm import decontaminate, language, linededup, segment, simhash
from tarmac.llm.common import table
from tarmac.session import stage as stored


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a language can be told: those without any letter go."""
    return language.keep_identified(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of three-line passages are cut out; what has no line left goes."""
    return linededup.drop_repeated_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each SimHash group."""
    return simhash.drop_near_duplicates(docs, shingle=3, max_bits=2)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window of ten words with a benchmark item."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"), mode="documents")


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, two sampled segmentations, and the text the ids give back."""
    done = segment.segmentations(docs.select("doc_id", "lang", "source", "text"), k=2)
    return done.select("doc_id", "lang", "source", "pieces.*")


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("sentencepiece", sentencepiece),
]

#: Fingerprints, profiles and samples are beyond SQL; the stages are tested against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, function in STAGES[:-1]:
        docs = stored(function(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
