"""The registered queries of this subpackage, with production parameters, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tarmac.llm import (ann, chat, decontaminate, fim, htmltext, language, linededup, lloyd,
                        segment, simhash, tokencount, topk, warc)
from tarmac.llm.common import table
from tarmac.plans.common import Query


def op1_html_text(spark, folder):
    return htmltext.extract(table(spark, folder, "pages"))


def op2_simhash(spark, folder):
    return simhash.near_duplicates(table(spark, folder, "documents"), shingle=3, max_bits=2)


def op3_language_id(spark, folder):
    return language.language_id(table(spark, folder, "documents"))


def op4_line_dedup(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return linededup.dedup_lines(docs, removed="n_removed")


def op5_decontaminate(spark, folder):
    return decontaminate.report(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op6_token_counts(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return tokencount.count_tokens(docs).drop("text")


def op7_segmentations(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return segment.segmentations(docs, k=2, digests=True).select("doc_id", "pieces.*")


def op8_nearest(spark, folder):
    vectors = table(spark, folder, "embeddings")
    return ann.nearest(vectors, vectors.filter(F.col("vec_id") % 50 == 0), k=5)


def op9_chat_format(spark, folder):
    return chat.format_chats(table(spark, folder, "conversations"))


def op10_warc(spark, folder):
    return warc.archive_round_trip(table(spark, folder, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_centroids(spark, folder):
    return lloyd.clusters(table(spark, folder, "embeddings"), k=16, rounds=3, dim=64, scale=64, seed=1)


def op12_fill_in_middle(spark, folder):
    return fim.report(table(spark, folder, "documents"))


def op13_exact_topk(spark, folder):
    vectors = table(spark, folder, "embeddings")
    return topk.exact_topk(vectors, vectors.filter(F.col("vec_id") % 20 == 0), k=20)


QUERIES = {
    "op1_html_text": Query(op1_html_text),
    "op2_simhash": Query(op2_simhash),
    "op3_language_id": Query(op3_language_id),
    "op4_line_dedup": Query(op4_line_dedup, linededup.SQL),
    "op5_decontaminate": Query(op5_decontaminate, decontaminate.SQL),
    "op6_token_counts": Query(op6_token_counts),
    "op7_segmentations": Query(op7_segmentations),
    "op8_nearest": Query(op8_nearest),
    "op9_chat_format": Query(op9_chat_format, chat.SQL),
    "op10_warc": Query(op10_warc, warc.SQL),
    "op11_centroids": Query(op11_centroids, lloyd.SQL),
    "op12_fill_in_middle": Query(op12_fill_in_middle, fim.SQL),
    "op13_exact_topk": Query(op13_exact_topk, topk.SQL),
}
