"""Benchmark decontamination: exact word windows of test items in training documents.

A document that holds a window of L words holds, at a multiple of s = (L + 1) / 2 words, a block of
L - s + 1 of its words. So documents give one hashed block for each s words, which meets the set of
all blocks of the items; only around a meeting are whole windows written out and compared as text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import ascii_lower, let, small_side
from tarmac.session import cut

#: What parts the words of a text whose A-Z are folded: all ASCII but a-z and 0-9. A fixed value.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same words and what parts them in a text as it was given, with its capitals.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
OTHER = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*"
WINDOW = 10


def words(text: Column) -> Column:
    """The words of a text, A-Z folded; none for null.

    The text is split at what is no word, which leaves an empty string where it begins or ends so.
    """
    def inner(parts: Column) -> Column:
        head = F.when(parts[0] == "", 1).otherwise(0)
        tail = F.when(F.element_at(parts, -1) == "", 1).otherwise(0)
        return F.when(F.size(parts) > 1, F.slice(parts, head + 1, F.size(parts) - head - tail)
                      ).otherwise(F.filter(parts, lambda part: part != ""))

    return let(F.split(ascii_lower(F.coalesce(text, F.lit(""))), BETWEEN, -1), inner)


def _stride(length: int) -> int:
    return (length + 1) // 2


def _block(length: int) -> int:
    return length - _stride(length) + 1


def _steps(first: Column, last: Column, step: int = 1) -> Column:
    """first, first + step, ... up to last; nothing if last is smaller."""
    return F.when(last >= first, F.sequence(first, last, F.lit(step))).otherwise(
        F.array().cast("array<int>"))


def _hash(w: Column, at: Column, n: int) -> Column:
    return F.xxhash64(F.slice(w, at + 1, n))


def windows(items: DataFrame, item: str, text: str, window: int) -> DataFrame:
    """``item, length, words``: each item's windows; a shorter item is one, an empty one has none."""
    parts = items.select(F.col(item).alias("item"), words(F.col(text)).alias("w")).filter(
        F.size("w") > 0)
    length = F.least(F.size("w"), F.lit(window))
    at = F.explode(F.sequence(F.lit(0), F.size("w") - length))
    return parts.select("item", "w", length.alias("length"), at.alias("at")).select(
        "item", "length", F.array_join(F.expr("slice(w, at + 1, length)"), " ").alias("words"))


def _all_blocks(blocks_of, n: int):
    return lambda w: blocks_of(w, n, F.lit(n - _block(n)), 1)


def _narrow(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Rows by key and hashes of the text: rows alike in both are one case with one answer."""
    return docs.select(F.col(key).alias("key"), F.xxhash64(text).alias("h"),
                       F.xxhash64(F.lit(1), text).alias("g"), F.col(text).alias("text"))


def _match(left: DataFrame, right: DataFrame) -> DataFrame:
    """``left`` with the columns of ``right`` that belongs to the same key and hashes, or nulls."""
    named = right.withColumnsRenamed({"key": "_key", "h": "_h", "g": "_g"})
    same = (F.col("key").eqNullSafe(F.col("_key")) & (F.col("h") == F.col("_h"))
            & (F.col("g") == F.col("_g")))
    return left.join(named, same, "left").drop("_key", "_h", "_g")


def hits(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text",
         item: str = "item_id", item_text: str = "text", window: int = WINDOW):
    """Three tables: the counts of the documents, the windows found in them, and all windows.

    ``counts`` has ``key, h, g, n_words`` for every row of ``docs``. ``found`` has start, length and
    words of every window of the items that occurs, once for rows alike. None holds whole texts.
    """
    wins = cut(windows(items, item, item_text, window).distinct())
    lengths = sorted(r[0] for r in wins.select("length").distinct().collect())  # at most `window`
    narrow = _narrow(docs, key, text)
    none = "array<struct<length:int,at:int,seed:bigint>>"

    def blocks_of(w: Column, n: int, last: Column, step: int) -> Column:
        return F.transform(_steps(F.lit(0), last, step), lambda at: F.struct(
            F.lit(n).alias("length"), at.alias("at"), _hash(w, at, _block(n)).alias("seed")))

    def seeds(w: Column) -> Column:
        each = [blocks_of(w, n, F.size(w) - _block(n), _stride(n)) for n in lengths]
        return F.concat(*each) if each else F.array().cast(none)

    seeded = narrow.select("key", "h", "g", F.inline(let(words(F.col("text")), seeds)))
    blocks = [wins.filter(F.col("length") == n).select(F.inline(let(
        F.split("words", " "), _all_blocks(blocks_of, n)))).select(
        "length", "seed") for n in lengths]
    if blocks:
        known = blocks[0]
        for more in blocks[1:]:
            known = known.unionByName(more)
        met = seeded.join(small_side(cut(known.distinct())), ["length", "seed"], "left_semi")
    else:
        met = seeded.filter(F.lit(False))
    near = met.groupBy("key", "h", "g").agg(F.collect_set(F.struct("length", "at")).alias("near"))

    def around(w: Column) -> Column:
        """Every window that has a met block, as (start, length, words)."""
        starts = F.array_distinct(F.flatten(F.transform("near", lambda x: F.transform(
            _steps(F.greatest(F.lit(0), x["at"] + 1 - F.floor((x["length"] + 1) / 2).cast("int")),
                F.least(x["at"], F.size(w) - x["length"])),
            lambda s: F.struct(s.alias("start"), x["length"].alias("length"))))))
        return F.transform(starts, lambda s: F.struct(
            s["start"].alias("start"), s["length"].alias("length"),
            F.array_join(F.slice(w, s["start"] + 1, s["length"]), " ").alias("words")))

    both = let(words(F.col("text")), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.when(F.col("near").isNotNull(), around(w)).alias("wins")))
    read = cut(_match(narrow, near).select("key", "h", "g", both.alias("x")).select(
        "key", "h", "g", "x.n_words", "x.wins"))
    tried = read.select("key", "h", "g", F.inline("wins"))
    found = tried.distinct().join(small_side(cut(wins.select("length", "words").distinct())),
                       ["length", "words"], "left_semi")
    return read.select("key", "h", "g", "n_words"), cut(found), wins


def _covered(spans: Column) -> Column:
    """Words in a union of (start, length): spans in order, each adds what lies past the last end."""
    ordered = F.sort_array(spans)
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))
    return F.aggregate(ordered, zero, lambda a, s: F.struct(
        (a["n"] + F.greatest(F.lit(0), s["start"] + s["length"] - F.greatest(a["end"], s["start"]))
         ).alias("n"), F.greatest(a["end"], s["start"] + s["length"]).alias("end")))["n"]


def report(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text",
           item: str = "item_id", item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """``key, n_words, n_hit, n_items, items_sha256, contaminated`` for every row of ``docs``.

    A null text has no words. Repeated rows come back as often as they came in; items with the same
    windows all count. No item, or no item with a word, hits nothing. Items with a null id are left
    out of n_items and the digest. Columns beside the key and the text play no part.
    """
    counts, found, wins = hits(docs, items, key, text, item, item_text, window)
    doc = ["key", "h", "g"]
    spans = found.groupBy(*doc).agg(_covered(F.collect_set(F.struct("start", "length"))).alias("n_hit"))
    named = found.select(*doc, "length", "words").distinct().join(
        small_side(wins.dropna(subset=["item"])), ["length", "words"])
    ids = named.groupBy(*doc).agg(F.sort_array(F.collect_set(F.col("item").cast("string"))).alias("ids"))
    listed = F.coalesce("ids", F.array().cast("array<string>"))
    return _match(_match(counts, spans), ids).select(
        F.col("key").alias(key), "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.size(listed).cast("long").alias("n_items"),
        F.sha2(F.array_join(listed, ","), 256).alias("items_sha256"),
        F.col("n_hit").isNotNull().alias("contaminated"))


def decontaminate(docs: DataFrame, items: DataFrame, mode: str = "documents", key: str = "doc_id",
                  text: str = "text", item: str = "item_id", item_text: str = "text",
                  window: int = WINDOW) -> DataFrame:
    """``docs``, all columns, without the hit documents, or without the hit words of them.

    ``mode="spans"`` takes out each hit word with what stands between it and the word before, and
    keeps the rest of the text as it is. Documents without a hit stay as they are in both modes.
    """
    if mode not in ("documents", "spans"):
        raise ValueError("mode is documents or spans")
    _, found, _ = hits(docs, items, key, text, item, item_text, window)
    spans = found.groupBy("key", "h", "g").agg(
        F.collect_set(F.struct("start", "length")).alias("_spans")).select(
        F.col("key").alias("_key"), F.col("h").alias("_h"), F.col("g").alias("_g"), "_spans")
    same = (docs[key].eqNullSafe(spans["_key"]) & (F.xxhash64(docs[text]) == spans["_h"])
            & (F.xxhash64(F.lit(1), docs[text]) == spans["_g"]))
    if mode == "documents":
        return docs.join(spans, same, "left_anti")
    tokens = F.regexp_extract_all(F.col(text), F.lit(OTHER + WORD), F.lit(0))
    hit = F.flatten(F.transform("_spans", lambda s: F.sequence(s["start"], s["start"] + s["length"] - 1)))
    kept = let(tokens, lambda t: F.array_join(F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(t) - 1), hit), lambda i: t[i]), ""))
    tail = F.regexp_extract(F.col(text), OTHER + r"\z", 0)
    joined = docs.join(spans, same, "left")
    return joined.withColumn(text, F.when(F.col("_spans").isNull(), F.col(text)).otherwise(
        F.concat(kept, tail))).select(*docs.columns)


SQL = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bs AS (
  SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i
  FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS win FROM bs),
ds AS (
  SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i
  FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n),
dw AS (SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS win FROM ds),
f AS (SELECT DISTINCT r, n, i, win FROM dw SEMI JOIN bw USING (n, win)),
h AS (
  SELECT r, count(DISTINCT p) AS n_hit
  FROM (SELECT r, unnest(range(i, i + n)) AS p FROM f) GROUP BY r),
t AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT r, item_id::VARCHAR AS item FROM f JOIN bw USING (n, win)
        WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN h USING (r) LEFT JOIN t USING (r)"""
