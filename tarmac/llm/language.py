"""Language identification by rank-order profiles of character n-grams.

A profile lists a language's most frequent n-grams in order. A text's own most frequent n-grams are
ranked the same way, and each is charged the distance between its two ranks, or the full profile
length where the profile lacks it. The language with the smallest total wins.
"""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.llm.common import append_columns, folder_on, unused
from tarmac.session import cut, shared_folder

#: Longest n-gram, ranks in a profile, and ranks of a text that are compared.
LONGEST, PROFILE, COMPARED = 3, 400, 300
#: Counts a task holds before it hands them on, code points it looks at in one go.
HELD, CHUNK = 500_000, 1 << 20
#: Ranks that a task holds at a time: up to 32 bytes each, so 32 MB at most.
MOST_RANKS = 1_000_000
UNKNOWN = "und"
_SPACE = 32


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def _grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the n-grams of a text and their counts.

    Letters are lower-cased, every run of other characters is one space, and each word has a space
    at both ends. A code holds up to three code points of 21 bits. A space alone is not counted. A
    text is taken in pieces that end at white space; only a run of CHUNK characters without any is
    cut inside, as if a space stood there.
    """
    kinds, counts = [], []
    at = 0
    while at < len(text):
        end = at + CHUNK
        if end < len(text):  # pieces meet at white space, so no gram lies across two of them
            end = max(text.rfind(" ", at, end), text.rfind("\n", at, end)) + 1 or end
        points = np.frombuffer(text[at:end].lower().encode("utf-32-le", "surrogatepass"),
                               "<u4").astype(np.int64)
        at = end
        points = np.concatenate([[_SPACE], np.where(_letters()[points], points, _SPACE), [_SPACE]])
        keep = np.ones(len(points), bool)
        keep[1:] = (points[1:] != _SPACE) | (points[:-1] != _SPACE)
        points = points[keep]
        found = [points]
        for n in range(2, LONGEST + 1):
            code = points[:len(points) - n + 1]
            for k in range(1, n):
                code = (code << 21) | points[k:len(points) - n + 1 + k]
            inner = np.ones(len(code), bool)
            for k in range(1, n - 1):  # a gram doesn't run across two words
                inner &= points[k:len(points) - n + 1 + k] != _SPACE
            found.append(code[inner])
        codes = np.concatenate(found)
        kind, count = np.unique(codes[codes != _SPACE], return_counts=True)
        kinds.append(kind)
        counts.append(count)
    if not kinds:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    if len(kinds) == 1:
        return kinds[0], counts[0]
    return _sum(kinds, counts)


def _sum(kinds: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    kind, place = np.unique(np.concatenate(kinds), return_inverse=True)
    total = np.zeros(len(kind), np.int64)
    np.add.at(total, place, np.concatenate(counts))
    return kind, total


def _count_parts(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held: dict[str, list] = {}
    size = 0

    def out():
        for lang, found in held.items():
            kind, total = _sum([k for k, _ in found], [c for _, c in found])
            yield pd.DataFrame({"lang": lang, "gram": kind, "n": total})

    for part in parts:
        for lang, text in zip(part["lang"], part["text"]):
            found = _grams(text)
            held.setdefault(lang, []).append(found)
            size += len(found[0])
        if size > HELD:  # first merge what is there; hand it on if even that is much
            for lang, found in held.items():
                held[lang] = [_sum([k for k, _ in found], [c for _, c in found])]
            size = sum(len(found[0][0]) for found in held.values())
            if size > HELD:
                yield from out()
                held, size = {}, 0
    yield from out()


def train(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """``lang, gram, rank``: the profile of each language from all rows of ``docs``.

    Rows with a null text or language are left out. Grams are ranked by count, ties by code. Counts
    are summed in the tasks, then over all of them; the best of a language are taken in two steps,
    so no task sorts all grams of one language. The profiles are a checkpoint.
    """
    given = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text")).dropna()
    sums = given.mapInPandas(_count_parts, "lang string, gram long, n long").groupBy(
        "lang", "gram").agg(F.sum("n").alias("n"))
    order = [F.col("n").desc(), F.col("gram")]
    part = Window.partitionBy("lang", F.pmod(F.hash("gram"), F.lit(64))).orderBy(*order)
    best = sums.withColumn("rank", F.row_number().over(part)).filter(F.col("rank") <= PROFILE)
    whole = Window.partitionBy("lang").orderBy(*order)
    return cut(best.withColumn("rank", F.row_number().over(whole)).filter(
        F.col("rank") <= PROFILE).select("lang", "gram", "rank"))


def _model(rows: pd.DataFrame) -> tuple:
    """Languages and grams in order, where each gram's entries start, and their languages and ranks."""
    langs, owner = np.unique(rows["lang"].to_numpy(object), return_inverse=True)
    grams, gram = np.unique(rows["gram"].to_numpy(np.int64), return_inverse=True)
    order = np.argsort(gram, kind="stable")
    start = np.searchsorted(gram[order], np.arange(len(grams) + 1))
    return (langs.tolist(), grams, start, owner[order].astype(np.int32),
            rows["rank"].to_numpy(np.int32)[order])


def _top(text: str | None) -> np.ndarray:
    """The most frequent n-grams of a text in order; none for a null or a text without a letter."""
    kind, count = _grams(text) if text else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    return kind[np.lexsort((kind, -count))[:COMPARED]]


def _nearest(top: np.ndarray, model: tuple) -> tuple[float, str]:
    """The smallest distance from the languages of a model, and the first language that has it."""
    langs, grams, start, owner, rank = model
    at = np.minimum(np.searchsorted(grams, top), len(grams) - 1)
    hit = np.flatnonzero(grams[at] == top)
    first = start[at[hit]]
    n = start[at[hit] + 1] - first
    places = np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())
    saved = PROFILE - np.abs(rank[places] - np.repeat(hit + 1, n))
    away = PROFILE * len(top) - np.bincount(owner[places], saved, len(langs))
    best = int(np.argmin(away))
    return float(away[best]), langs[best]


def classify(texts: list, models) -> list[tuple[str, float]]:
    """The nearest language of each text and 1 minus its distance as a share of the largest possible.

    ``models`` yields the languages in blocks. ``und`` and 0 for a null, for a text without a letter,
    and where no profile was learned. Ties go to the language that sorts first.
    """
    tops = [_top(text) for text in texts]
    best = [(np.inf, UNKNOWN)] * len(tops)
    for model in models:
        for i, top in enumerate(tops):
            if len(top):
                best[i] = min(best[i], _nearest(top, model), key=lambda x: x[0])
    return [(UNKNOWN, 0.0) if away == np.inf else (lang, 1 - away / (PROFILE * len(top)))
            for (away, lang), top in zip(best, tops)]


def _store(rows: pd.DataFrame, path: str) -> None:
    store, base = folder_on(path.rpartition("/")[0])
    store.create_dir(base)
    with store.open_output_stream(f"{base}/{path.rpartition('/')[2]}", compression=None) as out:
        out.write(pickle.dumps(_model(rows)))


def _load(path: str) -> tuple:
    store, base = folder_on(path.rpartition("/")[0])
    with store.open_input_stream(f"{base}/{path.rpartition('/')[2]}", compression=None) as stream:
        return pickle.loads(stream.read())


def identify(docs: DataFrame, profiles: DataFrame, text: str = "text",
             out: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``docs`` with the predicted language and its score in the two columns of ``out``.

    Only the text is an input of the prediction. The profiles of the languages, PROFILE ranks each,
    go to every task if they are at most MOST_RANKS. Beyond, they lie in the shared folder in blocks
    of languages of that size, and a task scores its texts against one block after the other.
    """
    spark = docs.sparkSession
    schema = f"{out[0]} string, {out[1]} double"
    if profiles.count() <= MOST_RANKS:
        rows = profiles.toPandas()
        sent = spark.sparkContext.broadcast([_model(rows)] if len(rows) else [])
        return append_columns(docs, [text], schema, lambda batches: (
            classify(texts, sent.value) for (texts,) in batches))
    langs = sorted(row["lang"] for row in profiles.select("lang").distinct().collect())
    size = max(1, MOST_RANKS // PROFILE)
    folder = f"{shared_folder(spark)}/profiles-{uuid.uuid4().hex}"
    paths = []
    for at in range(0, len(langs), size):
        block = langs[at:at + size]
        paths.append(f"{folder}/{at}")
        _store(profiles.filter(F.col("lang").between(block[0], block[-1])).toPandas(), paths[-1])
    return append_columns(docs, [text], schema, lambda batches: (
        classify(texts, map(_load, paths)) for (texts,) in batches))


def held_out(key: Column) -> Column:
    """True for the third of the keys that no profile learns from; a null key is not one of them."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def language_id(docs: DataFrame, key: str = "doc_id", text: str = "text",
                lang: str = "lang") -> DataFrame:
    """``key, held_out, lang_pred, score`` for every row; profiles are learned from the other rows."""
    given = docs.select(F.col(key).alias(key), F.col(text).alias("_text"), F.col(lang).alias("_lang"))
    profiles = train(given.filter(~held_out(F.col(key))), "_text", "_lang")
    return identify(given.select(key, "_text"), profiles, "_text").select(
        key, held_out(F.col(key)).alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, key: str = "doc_id", text: str = "text",
                    lang: str = "lang") -> DataFrame:
    """``docs`` without the rows that have no text, or no letter in it.

    Where profiles were learned, every other text is nearest to one of them, and so is kept however
    far away it is. Where none was learned (no row has a text and a language), nothing can be told,
    and every text with a letter is kept as well.
    """
    out = (unused(docs, "_language_pred"), unused(docs, "_language_score"))
    profiles = train(docs.filter(~held_out(F.col(key))), text, lang)
    if profiles.isEmpty():
        letter = unused(docs, "_letter")
        told = append_columns(docs, [text], f"{letter} boolean", lambda batches: (
            [(len(_top(t)) > 0,) for t in texts] for (texts,) in batches))
        return told.filter(F.col(letter)).select(*docs.columns)
    return identify(docs, profiles, text, out).filter(F.col(out[0]) != UNKNOWN).select(*docs.columns)
