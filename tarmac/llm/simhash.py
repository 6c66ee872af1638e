"""SimHash fingerprints and near-duplicate groups by Golay-code fuzzy hashing.

A fingerprint of 64 bits is cut into segments of 22, 21 and 21 bits. Of at most two differing bits,
one segment has none and, with the segment that follows it in the cycle 1-2-3 or precedes it, some
pair (exact segment, next segment) has no and at most one error: each of the three ordered pairs
covers the cases where the third segment takes the rest. The next segment is decoded to the Golay
codewords within four bits (one or six), of which two words one bit apart always share the one
nearest to either. So each fingerprint gives one base key and one or six probe keys a pair; equal
keys are joined and every candidate is checked on all 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import append_columns
from tarmac.llm.components import components
from tarmac.llm.golay import nearest, within_four
from tarmac.session import cut, stage

SEED = 42
#: (shift, width) of the segments, and the pairs (exact, fuzzy).
SEGMENTS = ((0, 22), (22, 21), (43, 21))
PAIRS = ((0, 1), (1, 2), (2, 0))
#: Members of a key beyond which pairs are found by shared neighbours instead (see links()).
DENSE = 64
#: Shingles hashed at once, so that one very long text needs little memory.
CHUNK = 100_000

_ROW, _PRINT = "_simhash_row", "_simhash_print"


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The fingerprint as a signed 64-bit number; 0 for null and for a text without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    ones = np.zeros(64, np.int64)
    for start in range(0, n, CHUNK):
        hashes = np.array([
            xxhash.xxh64_intdigest(b" ".join(words[i:i + shingle]), SEED)
            for i in range(start, min(n, start + CHUNK))], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1,
                              bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, out: str, text: str = "text", shingle: int = 3) -> DataFrame:
    """``docs`` with a bigint column ``out``."""

    def prints(batches):
        for (texts,) in batches:
            yield [(fingerprint(t, shingle),) for t in texts]

    return append_columns(docs, [text], f"{out} long", prints)


def _keys(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for part in parts:
        prints = part["print"].to_numpy().astype(np.int64)
        bits = prints.view(np.uint64)
        cuts = [((bits >> np.uint64(s)) & np.uint64((1 << w) - 1)).astype(np.int64)
                for s, w in SEGMENTS]
        for n, (exact, fuzzy) in enumerate(PAIRS):
            head = (np.int64(n) << 40) | (cuts[exact] << 12)
            rows, codes = within_four(cuts[fuzzy])
            yield pd.DataFrame({"key": head[rows] | codes, "print": prints[rows],
                                "base": codes == nearest(cuts[fuzzy])[rows]})


def _balls(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    flips = np.concatenate([[0], np.uint64(1) << np.arange(64, dtype=np.uint64)]).astype(np.uint64)
    for part in parts:
        prints = part["print"].to_numpy().astype(np.int64)
        points = (prints.view(np.uint64)[:, None] ^ flips).view(np.int64)
        yield pd.DataFrame({"point": points.ravel(), "print": np.repeat(prints, 65)})


def links(prints: DataFrame, max_bits: int = 2) -> DataFrame:
    """Edges ``a, b`` between distinct fingerprints (column ``print``) at ``max_bits`` or fewer.

    Keys with up to DENSE members are joined and verified. For the members of denser keys the
    pairs are not written out: fingerprints two bits apart share a point one bit from both, so each
    gives its 65 points within one bit and those at a point (65 at most) are tied to one of them.
    The edges may then be fewer than the pairs, but connect the same fingerprints.
    """
    if not 0 <= max_bits <= 2:
        raise ValueError("max_bits is 0, 1 or 2")
    keys = cut(prints.select("print").distinct().mapInPandas(
        _keys, "key long, print long, base boolean"))
    sizes = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    sized = cut(keys.join(sizes, "key"))
    light = sized.filter(F.col("n") <= DENSE)
    left = light.filter("base").select("key", F.col("print").alias("a"))
    right = light.select("key", F.col("print").alias("b"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    pairs = left.join(right, (left["key"] == right["key"]) & (F.col("a") < F.col("b")) & near)
    points = sized.filter(F.col("n") > DENSE).select("print").distinct().mapInPandas(
        _balls, "point long, print long")
    groups = points.groupBy("point").agg(F.sort_array(F.collect_set("print")).alias("members")).filter(
        F.size("members") > 1)
    hub = F.col("members")[0] if max_bits == 2 else F.col("point")
    stars = groups.withColumn("hub", hub).filter(F.array_contains("members", F.col("hub"))).select(
        F.col("hub").alias("a"), F.explode("members").alias("b")).filter(
        (F.col("a") != F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits))
    return pairs.select("a", "b").unionByName(stars).distinct()


def _groups(marked: DataFrame, key: str, max_bits: int) -> DataFrame:
    """``print, component``: the smallest key reachable from each fingerprint."""
    nodes = cut(marked.groupBy(F.col(_PRINT).alias("print")).agg(F.min(key).alias("low")))
    labels = components(links(nodes, max_bits))
    named = nodes.join(labels.select(F.col("node").alias("print"), "label"), "print", "left").select(
        "print", "low", F.coalesce("label", "print").alias("label"))
    lows = named.groupBy("label").agg(F.min("low").alias("component"))
    return named.join(lows, "label").select("print", "component", "label")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3,
                    max_bits: int = 2) -> DataFrame:
    """``key, fingerprint, component_id`` for every row.

    Equal fingerprints are one node, so a group of copies of any size costs one node. Null and empty
    texts have fingerprint zero and are linked like any other. Repeated rows come back as often as
    they came in. A null key counts only where its whole component has no other; then the component
    is null. Other columns of ``docs``, whatever their names, are left out. An empty table gives none.
    """
    narrow = docs.select(F.col(key).alias(key), F.col(text).alias("_simhash_text"))
    marked = cut(fingerprints(narrow, _PRINT, "_simhash_text", shingle).select(key, _PRINT))
    groups = _groups(marked, key, max_bits)
    return marked.join(groups.withColumnRenamed("print", _PRINT), _PRINT).select(
        key, F.lower(F.lpad(F.hex(_PRINT), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"))


def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3,
                         max_bits: int = 2) -> DataFrame:
    """``docs`` with the row of the smallest key (nulls last) of each group, and all its columns.

    Of repeated rows exactly one stays. Rows are numbered when they are staged, so a task that runs
    again decides alike.
    """
    wide = stage(fingerprints(docs, _PRINT, text, shingle).withColumn(
        _ROW, F.monotonically_increasing_id()))
    narrow = wide.select(key, _PRINT, _ROW)
    groups = _groups(narrow, key, max_bits).select(F.col("print").alias(_PRINT), "label")
    ranked = F.struct(F.col(key).isNull(), F.col(key), F.col(_ROW))
    inside = narrow.join(groups, _PRINT).select("label", _ROW, ranked.alias("rank"))
    # stored, so that the join shuffles both sides and a very large group can be split over tasks
    first = cut(inside.groupBy("label").agg(
        F.min("rank").getField(_ROW).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1"))
    gone = inside.join(first, "label").filter(F.col(_ROW) != F.col("first")).select(_ROW)
    return wide.join(gone, _ROW, "left_anti").select(*docs.columns)
