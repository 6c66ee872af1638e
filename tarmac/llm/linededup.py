"""Line dedup: windows of three lines that occurred before, anywhere in the corpus, are removed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import let
from tarmac.session import cut

LINES = 3


def _lines(text: Column) -> Column:
    """Lines that are not blank, as (place among all lines, trimmed text)."""
    every = F.transform(F.split(text, "\n", -1), lambda line, i: F.struct(
        i.alias("at"), F.trim(line).alias("line")))
    return F.filter(every, lambda x: x["line"] != "")


def _windows(text: Column) -> Column:
    """(k, h, g) of each window: its first line's number and 128 bits of hash over its lines."""
    hashed = F.transform(_lines(text), lambda x: F.struct(
        F.xxhash64(x["line"]).alias("h"), F.xxhash64(F.lit(1), x["line"]).alias("g")))

    def over(x: Column) -> Column:
        def one(k: Column) -> Column:
            parts = [x[k + i] for i in range(LINES)]
            return F.struct(k.alias("k"), F.xxhash64(*[p["h"] for p in parts]).alias("h"),
                            F.xxhash64(*[p["g"] for p in parts]).alias("g"))
        last = F.size(x) - LINES
        none = F.array().cast("array<struct<k:int,h:bigint,g:bigint>>")
        return F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), one)).otherwise(none)

    return let(hashed, over)


def _kept(text: Column, starts: Column) -> Column:
    """The text without the lines of the windows at ``starts``.

    Covered lines are the union of the windows. A line goes with the blank lines right before it;
    blank lines at the end stay.
    """
    def rebuilt(raw: Column, lines: Column) -> Column:
        covered = F.flatten(F.transform(starts, lambda k: F.sequence(k, k + LINES - 1)))
        left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), covered)

        def with_blanks(j: Column) -> Column:
            first = F.when(j > 0, lines[F.greatest(j - 1, F.lit(0))]["at"] + 1).otherwise(0)
            return F.slice(raw, first + 1, lines[j]["at"] - first + 1)

        end = lines[F.size(lines) - 1]["at"] + 1
        tail = F.slice(raw, end + 1, F.size(raw) - end)
        return F.array_join(F.concat(F.flatten(F.transform(left, with_blanks)), tail), "\n")

    return let(F.split(text, "\n", -1), lambda raw: let(_lines(text), lambda x: rebuilt(raw, x)))


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text",
                removed: str | None = None) -> DataFrame:
    """``docs`` with later occurrences of three-line windows cut out of ``text``.

    A window is three consecutive lines that are not blank, compared without spaces at their ends.
    Its first occurrence, in the order of the key (nulls last), the text's hash and the place in the
    text, stays; the lines of all others go. Repeated rows count as one occurrence and are treated
    alike. A null text stays null; a text of fewer than three lines has no window and stays as it
    is; a text may become empty. ``removed`` names a column to get the number of removed lines.
    """
    keyed = docs.select(F.col(key).alias("_key"), F.xxhash64(text).alias("_text"),
                        F.inline(_windows(F.col(text))))
    place = F.struct(F.col("_key").isNull().alias("last"), "_key", "_text", "k")
    wins = cut(keyed)
    # stored, so that the join shuffles both sides and a very frequent window can be split over tasks
    repeated = cut(wins.groupBy("h", "g").agg(
        F.min(place).alias("first"), F.max(place).alias("other")).filter(
        ~F.col("first").eqNullSafe(F.col("other"))).drop("other"))
    later = wins.join(repeated, ["h", "g"]).filter(~place.eqNullSafe(F.col("first")))
    starts = later.groupBy("_key", "_text").agg(F.collect_set("k").alias("_starts"))
    joined = docs.join(starts, docs[key].eqNullSafe(starts["_key"])
                       & (F.xxhash64(docs[text]) == starts["_text"]), "left")
    cutting = F.col("_starts").isNotNull()
    out = {text: F.when(cutting, _kept(F.col(text), F.col("_starts"))).otherwise(F.col(text))}
    columns = list(docs.columns)
    if removed:
        out[removed] = F.when(cutting, F.size(F.array_distinct(F.flatten(F.transform(
            "_starts", lambda k: F.sequence(k, k + LINES - 1)))))).otherwise(0).cast("long")
        columns.append(removed)
    return joined.withColumns(out).select(*columns)


def drop_repeated_lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``dedup_lines`` without the documents that lost all their lines."""
    marked = dedup_lines(docs, key, text, "_lines_removed")
    return marked.filter((F.col("_lines_removed") == 0) | (F.trim(F.translate(text, "\n", "")) != "")
                         ).select(*docs.columns)


SQL = r"""
WITH d AS (SELECT doc_id, text, row_number() OVER (ORDER BY doc_id) AS r FROM documents),
raw AS (
  SELECT r, unnest(string_split(text, chr(10))) AS line,
    generate_subscripts(string_split(text, chr(10)), 1) AS spot FROM d),
lines AS (
  SELECT r, spot, line, row_number() OVER (PARTITION BY r ORDER BY spot) AS j,
    lag(spot, 1, 0) OVER (PARTITION BY r ORDER BY spot) AS prior
  FROM raw WHERE trim(line) <> ''),
wins AS (
  SELECT r, j, trim(line) AS a, lead(trim(line), 1) OVER o AS b, lead(trim(line), 2) OVER o AS c
  FROM lines WINDOW o AS (PARTITION BY r ORDER BY spot)),
numbered AS (
  SELECT r, j, row_number() OVER (PARTITION BY a, b, c ORDER BY r, j) AS nth
  FROM wins WHERE c IS NOT NULL),
gone AS (SELECT DISTINCT r, unnest([j, j + 1, j + 2]) AS j FROM numbered WHERE nth > 1),
cut AS (SELECT r, prior, spot FROM lines SEMI JOIN gone USING (r, j)),
kept AS (
  SELECT r, string_agg(line, chr(10) ORDER BY spot) AS text FROM raw
  WHERE NOT EXISTS (SELECT 1 FROM cut WHERE cut.r = raw.r AND raw.spot > cut.prior AND raw.spot <= cut.spot)
  GROUP BY r)
SELECT doc_id, CASE WHEN d.text IS NOT NULL THEN coalesce(kept.text, '') END AS text,
  (SELECT count(*) FROM gone WHERE gone.r = d.r) AS n_removed
FROM d LEFT JOIN kept USING (r)"""
