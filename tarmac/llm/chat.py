"""Chat logs: snapshots that a longer conversation continues are dropped, the rest is rendered."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.llm.common import small_side
from tarmac.session import stage

#: Turns in one rendered row; a longer conversation takes several.
SEGMENT = 256
_HASHES = ("h", "g")


def _two_hashes(*values: str) -> list[Column]:
    """128 bits for some columns. A null counts as a value of its own."""
    held = [part for v in values for part in (F.col(v).isNull(), F.col(v))]
    return [F.xxhash64(*held), F.xxhash64(F.lit(1), *held)]


def _named(chats: DataFrame, conv: str, turn: str, role: str, text: str, *also: Column) -> DataFrame:
    """``conv, turn, role`` and the text's hashes ``t1, t2``, which stand for it until it is rendered."""
    t1, t2 = _two_hashes(text)
    return chats.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.col(role).alias("role"),
                        t1.alias("t1"), t2.alias("t2"), *also)


def _positions(named: DataFrame) -> DataFrame:
    """Distinct turns with ``pos`` from 1, the conversation's length ``n`` and its hashes up to there.

    Only hashes of the texts move and are stored. Turns are spread by range, so a conversation of any length lies in several tasks. Each task
    numbers its own part, and the parts before it, one row each, give the offset. The prefix hash
    is the exclusive or of hashes that hold the position, so parts add up the same way.
    """
    order = [F.col("turn").asc_nulls_last(), F.col("role").asc_nulls_last(), "t1", "t2"]
    dealt = stage(named.distinct().repartitionByRange(F.col("conv"), *order).withColumn(
        "part", F.spark_partition_id()))
    inside = Window.partitionBy("conv", "part").orderBy(*order)
    parts_of = Window.partitionBy("conv")
    before = parts_of.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)

    def offset(df: DataFrame, *totals: Column, **sums: Column) -> DataFrame:
        parts = df.groupBy("conv", "part").agg(*totals).select(
            F.col("conv").alias("_conv"), F.col("part").alias("_part"),
            *[c.alias(name) for name, c in sums.items()])
        same = F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("part") == F.col("_part"))
        return df.join(parts, same).drop("_conv", "_part")

    local = dealt.withColumn("pos", F.row_number().over(inside))
    placed = offset(local, F.count(F.lit(1)).alias("n"),
                    skip=F.coalesce(F.sum("n").over(before), F.lit(0)), n=F.sum("n").over(parts_of))
    placed = placed.withColumn("pos", F.col("pos") + F.col("skip")).drop("skip")
    tagged = placed.withColumns(dict(zip(("own_h", "own_g"), _two_hashes("pos", "role", "t1", "t2"))))
    running = Window.partitionBy("conv", "part").orderBy("pos").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    rolled = tagged.withColumns({x: F.bit_xor(f"own_{x}").over(running) for x in _HASHES})
    ends = offset(rolled, *[F.bit_xor(f"own_{x}").alias(f"all_{x}") for x in _HASHES],
                  **{f"base_{x}": F.coalesce(F.bit_xor(f"all_{x}").over(before), F.lit(0))
                     for x in _HASHES})
    return ends.select("conv", "turn", "role", "t1", "t2", "pos", "n", *[
        F.col(x).bitwiseXOR(F.col(f"base_{x}")).alias(x) for x in _HASHES])


def maximal(turns: DataFrame) -> DataFrame:
    """``conv, n_turns, copies`` of the conversations to keep, from the rows of _positions().

    A conversation goes if its turns begin a longer one; of equal ones the smallest id stays.
    """
    whole = turns.filter("pos = n").groupBy("pos", *_HASHES).agg(
        F.min(F.struct(F.col("conv").isNull().alias("last"), "conv")).alias("kept"),
        F.count(F.lit(1)).alias("copies"))
    begun = turns.filter("pos < n").select("pos", *_HASHES).distinct()
    return whole.join(begun, ["pos", *_HASHES], "left_anti").select(
        F.col("kept")["conv"].alias("conv"), F.col("pos").alias("n_turns"), "copies")


def _rendered(role: Column, text: Column) -> Column:
    return F.concat(F.lit("<|im_start|>"), F.coalesce(role, F.lit("")), F.lit("\n"),
                    F.coalesce(text, F.lit("")), F.lit("<|im_end|>\n"))


def format_chats(chats: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                 text: str = "text") -> DataFrame:
    """``conv, segment, n_turns, copies, text`` of every conversation that no longer one continues.

    Turns are ordered by ``turn`` (nulls last), then role and hashes of the text. Conversations are
    told apart and compared by hashes; texts are read again for what is kept, and move once, or twice
    where the places of the kept turns are too many for a broadcast. Repeated rows of a
    conversation count once. Null ids are one conversation; null role and text are rendered empty,
    but are no equal of an empty string when conversations are compared. A conversation of more than
    SEGMENT turns is rendered as several rows, numbered from 0, whose texts joined are the whole;
    n_turns and copies (equal conversations) are those of the whole. Other columns are left out.
    """
    turns = stage(_positions(_named(chats, conv, turn, role, text)))
    kept = maximal(turns).withColumnRenamed("conv", "_conv")
    k1, k2 = _two_hashes("conv", "turn", "role", "t1", "t2")
    places = stage(turns.join(kept, F.col("conv").eqNullSafe(F.col("_conv"))).select(
        k1.alias("k1"), k2.alias("k2"), "conv", "role", "pos", "n_turns", "copies"))
    given = _named(chats, conv, turn, role, text, F.col(text).alias("text")).select(
        k1.alias("k1"), k2.alias("k2"), "text")
    near = small_side(places)
    if near is places:  # the texts must move to their places: repeated rows shrink before
        given = given.groupBy("k1", "k2").agg(F.first("text").alias("text"))
    shown = given.join(near, ["k1", "k2"]).select(
        "conv", "n_turns", "copies", "pos",
        F.floor((F.col("pos") - 1) / SEGMENT).cast("long").alias("segment"),
        _rendered(F.col("role"), F.col("text")).alias("one"))
    lines = F.sort_array(F.collect_set(F.struct("pos", "one")))  # a set, for repeated rows
    return shown.groupBy("conv", "segment", "n_turns", "copies").agg(lines.alias("lines")).select(
        F.col("conv").alias(conv), "segment", F.col("n_turns").cast("long").alias("n_turns"), "copies",
        F.array_join(F.transform("lines", lambda x: x["one"]), "").alias("text"))


SQL = r"""
WITH t AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations),
p AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS pos,
    count(*) OVER (PARTITION BY conv_id) AS n FROM t),
grown AS (
  SELECT conv_id, pos, n, list(struct_pack(role := role, text := text)) OVER (
    PARTITION BY conv_id ORDER BY pos) AS seen FROM p),
whole AS (
  SELECT min(conv_id) AS conv_id, count(*) AS copies, seen FROM grown WHERE pos = n GROUP BY seen),
kept AS (
  SELECT * FROM whole WHERE NOT EXISTS (
    SELECT 1 FROM grown WHERE grown.pos < grown.n AND grown.seen = whole.seen))
SELECT conv_id, ((pos - 1) // 256)::BIGINT AS segment, any_value(n) AS n_turns,
  any_value(copies) AS copies, string_agg('<|im_start|>' || coalesce(role, '') || chr(10) ||
    coalesce(text, '') || '<|im_end|>' || chr(10), '' ORDER BY pos) AS text
FROM p JOIN kept USING (conv_id) GROUP BY conv_id, segment"""
