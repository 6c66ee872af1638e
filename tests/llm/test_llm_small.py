"""Each operator against plain Python on small tables with the odd cases."""

import base64
import hashlib
import html as htmllib
import io
import json
import os
import re
import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tarmac.llm import (ann, chat, decontaminate, golay, htmltext, language, linededup,  # noqa: E402
                        pieces, segment, simhash, tokencount, warc)

DOCS = "doc_id long, text string, lang string, fingerprint string, key string, h long"


def docs_of(spark, rows):
    """Documents with columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, l, "x", "k", 1) for i, t, l in rows], DOCS)


LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(60_000))
ROWS = [(1, None, None), (2, "", "en"), (3, "one", "en"), (4, "The Cat sat on the mat", "en"),
        (5, "the cat SAT on the mat", "en"), (5, "the cat SAT on the mat", "en"),
        (None, "the cat sat on the mat", "en"), (7, LONG, "de"), (8, "   \n\t ", None), (9, "é É 9", "fr")]


# --- SimHash -------------------------------------------------------------------------------------

def test_golay_lists_meet_for_words_one_bit_apart():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 1 << 23, 400)
    near = golay.nearest(words)
    rows, codes = golay.within_four(words)
    lists = [set(codes[rows == i].tolist()) for i in range(len(words))]
    assert all(n in own and len(own) in (1, 6) for n, own in zip(near, lists))
    for bit in range(23):
        other = golay.nearest(words ^ (1 << bit))
        assert all(o in own for o, own in zip(other, lists))


def brute_groups(prints, bits):
    """Smallest index of each component of a list of 64-bit numbers."""
    low = list(range(len(prints)))
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(prints):
            for j, b in enumerate(prints):
                if ((a ^ b) & (1 << 64) - 1).bit_count() <= bits and low[j] < low[i]:
                    low[i], changed = low[j], True
    return low


@pytest.mark.parametrize("bits", [0, 1, 2])
@pytest.mark.parametrize("dense", [1, 64])
def test_links_connect_all_near_fingerprints(spark, monkeypatch, bits, dense):
    monkeypatch.setattr(simhash, "DENSE", dense)
    rng = np.random.default_rng(2)
    prints = []
    for centre in rng.integers(-2**62, 2**62, 12).tolist():
        for _ in range(10):
            x = centre & (1 << 64) - 1
            for bit in rng.integers(0, 64, rng.integers(0, 4)).tolist():
                x ^= 1 << bit
            prints.append(x - (1 << 64) if x >> 63 else x)
    prints = sorted(set(prints))
    marked = spark.createDataFrame([(i, p) for i, p in enumerate(prints)], f"k long, {simhash._PRINT} long")
    got = {r["print"]: r["component"] for r in simhash._groups(marked, "k", bits).collect()}
    assert [got[p] for p in prints] == brute_groups(prints, bits)


def test_near_duplicates_of_odd_rows(spark):
    got = {(r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_duplicates(
        docs_of(spark, ROWS)).collect()}
    by = {i: (f, c) for i, f, c in got}
    assert by[1] == by[2] == by[8] == ("0" * 16, 1)
    assert by[4] == by[5] == by[None] and by[4][1] == 4
    assert by[7][1] == 7 and by[3][1] == 3
    assert simhash.near_duplicates(docs_of(spark, ROWS)).count() == len(ROWS)
    kept = simhash.drop_near_duplicates(docs_of(spark, ROWS))
    assert kept.columns == docs_of(spark, []).columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 4, 7, 9]
    assert simhash.near_duplicates(docs_of(spark, [])).count() == 0


# --- language ------------------------------------------------------------------------------------

def test_languages_are_told_apart_and_odd_texts_are_und(spark):
    words = {"en": "the of and with thing", "de": "der und nicht zwei über", "fr": "le était être pour ça"}
    rows = [(i, " ".join((words[x].split() * 4)[i % 3:]), x) for i, x in enumerate(list(words) * 20)]
    odd = [(100, None, "en"), (101, "", "en"), (102, "12 %\n", "de"), (103, "THE OF", None),
           (None, "der und", "de"), (104, "der und nicht " * 40_000, "de")]
    out = language.language_id(docs_of(spark, rows + odd)).collect()
    assert len(out) == len(rows) + len(odd)
    told = {r.doc_id: r.lang_pred for r in out}
    assert all(told[i] == x for i, _, x in rows)
    assert [told[i] for i in (100, 101, 102, 103, 104, None)] == ["und", "und", "und", "en", "de", "de"]
    assert all(0 <= r.score <= 1 for r in out)
    kept = language.keep_identified(docs_of(spark, rows + odd))
    assert kept.count() == len(rows) + 3 and kept.columns == docs_of(spark, []).columns
    assert language.language_id(docs_of(spark, [])).count() == 0
    assert {r.lang_pred for r in language.language_id(docs_of(spark, odd[:1])).collect()} == {"und"}


def test_texts_are_kept_where_no_language_was_learned(spark):
    rows = [(1, "clean text", None), (2, None, None), (3, "12 %", None), (4, "ça", None)]
    kept = language.keep_identified(docs_of(spark, rows))
    assert sorted(r.doc_id for r in kept.collect()) == [1, 4] and kept.columns == docs_of(spark, []).columns


def test_languages_in_blocks_are_scored_alike(spark, monkeypatch):
    words = {"en": "the of and with thing", "de": "der und nicht zwei über", "fr": "le était être pour ça"}
    rows = [(i, " ".join((words[x].split() * 4)[i % 3:]), x) for i, x in enumerate(list(words) * 20)]
    rows += [(100, None, "en"), (101, "12", None), (102, "the und était", None)]
    whole = sorted(language.language_id(docs_of(spark, rows)).collect())
    monkeypatch.setattr(language, "MOST_RANKS", 1)
    assert sorted(language.language_id(docs_of(spark, rows)).collect()) == whole


def test_grams_of_a_long_text_do_not_depend_on_the_pieces(monkeypatch):
    text = "Ein Wort, zwei Wörter; " * 50
    whole = dict(zip(*map(np.ndarray.tolist, language._grams(text))))
    monkeypatch.setattr(language, "CHUNK", 40)
    assert dict(zip(*map(np.ndarray.tolist, language._grams(text)))) == whole


# --- lines ---------------------------------------------------------------------------------------

def brute_lines(rows):
    seen, out = {}, []
    order = sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0))
    gone = {}
    for key, text in order:
        lines = [x.strip(" ") for x in (text or "").split("\n")]
        at = [i for i, x in enumerate(lines) if x]
        cover = set()
        for j in range(len(at) - 2):
            window = tuple(lines[i] for i in at[j:j + 3])
            if window in seen:
                cover |= {j, j + 1, j + 2}
            seen.setdefault(window, 1)
        raw = (text or "").split("\n")
        drop = set()
        for j in cover:
            drop |= set(range(at[j - 1] + 1 if j else 0, at[j] + 1))
        gone[key, text] = None if text is None else "\n".join(
            x for i, x in enumerate(raw) if i not in drop)
    for key, text in rows:
        out.append((key, gone[key, text]))
    return out


def test_line_dedup_equals_plain_python(spark):
    shared = "a a\n b\nc\nd"
    rows = [(1, shared), (2, "x\n" + shared + "\ny"), (3, "a a\n\nb \n\nc\nz\n"), (4, None), (5, ""),
            (6, "a a\nb"), (7, "q\nq\nq\nq\nq"), (8, "x\n" + shared + "\ny"), (8, "x\n" + shared + "\ny"),
            (None, "c\nd\nx\nb\nc\nd"), (9, "\n".join(f"line {i % 3000}" for i in range(9000)))]
    docs = docs_of(spark, [(i, t, "en") for i, t in rows])
    got = linededup.dedup_lines(docs, removed="n")
    key = lambda r: (r[0] is None, r[0] or 0, r[1] or "")
    assert sorted([(r.doc_id, r.text) for r in got.collect()], key=key) == sorted(brute_lines(rows), key=key)
    assert got.columns == docs.columns + ["n"]
    kept = {r.doc_id for r in linededup.drop_repeated_lines(docs).collect()}
    assert 5 in kept and 4 in kept and 8 not in kept
    assert linededup.dedup_lines(docs_of(spark, [])).count() == 0


# --- benchmark -----------------------------------------------------------------------------------

def brute_report(docs, items, window=10):
    split = lambda t: re.findall(
        r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+",
        "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    wins = {}
    for item, text in items:
        w = split(text)
        n = min(window, len(w))
        for i in range(len(w) - n + 1) if w else ():
            wins.setdefault(tuple(w[i:i + n]), set()).add(item)
    out = []
    for key, text in docs:
        w = split(text)
        hit, found = set(), set()
        for n in {len(x) for x in wins}:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in wins:
                    hit |= set(range(i, i + n))
                    found |= wins[tuple(w[i:i + n])]
        ids = sorted(str(x) for x in found if x is not None)
        out.append((key, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    return out


def test_decontamination_equals_plain_python(spark):
    base = [f"t{i}" for i in range(40)]
    items = [(1, " ".join(base)), (2, "Short One"), (3, ""), (4, None), (5, " ".join(base[5:16])),
             (10, "short one"), (6, "solo"), (None, "null item here")]
    texts = [(1, " ".join(["a"] * 7 + base[3:14] + ["b"])), (2, "a SHORT, one! b"), (3, None), (4, ""),
             (5, " ".join(base[:9])), (6, LONG + " " + " ".join(base)), (7, "Solo"), (7, "Solo"),
             (None, "x null item here"), (8, "... " + " - ".join(base[20:35]) + "?"), (9, "é É")]
    docs = docs_of(spark, [(i, t, "en") for i, t in texts])
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = [tuple(r) for r in decontaminate.report(docs, bench).collect()]
    assert sorted(got, key=str) == sorted(brute_report(texts, items), key=str)
    clean = decontaminate.decontaminate(docs, bench)
    assert sorted(str(r.doc_id) for r in clean.collect()) == ["3", "4", "5", "9"]
    cut = {r.doc_id: r.text for r in decontaminate.decontaminate(docs, bench, "spans").collect()}
    assert cut[1] == " ".join(["a"] * 7 + ["b"]) and cut[2] == "a! b" and cut[5] == texts[4][1]
    assert cut[8] == "?" and cut[3] is None and cut[7] == ""
    none = decontaminate.report(docs, bench.limit(0)).collect()
    assert len(none) == len(texts) and not any(r.contaminated for r in none)
    assert decontaminate.report(docs_of(spark, []), bench).count() == 0


# --- pieces --------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def vocabulary():
    return pieces.load()


def all_ways(token, v):
    if not token:
        return [((), 0.0)]
    out = []
    for n in range(1, len(token) + 1):
        if token[:n] in v.scores:
            first = ((v.ids[token[:n]],), v.scores[token[:n]])
        elif n == 1:
            raw = token[0].encode()
            first = (tuple(v.byte_ids[b] for b in raw), len(raw) * v.byte_score)
        else:
            continue
        out += [(first[0] + ids, first[1] + score) for ids, score in all_ways(token[n:], v)]
    return out


TEXTS = [None, "", " ", "the 丂 cat\nx", "  two  spaces \n", "Hello world, hello!", "🙂é", LONG]


def test_token_counts_equal_the_best_of_all_ways(spark, vocabulary):
    tokens = [p for t in TEXTS[1:-1] for p in pieces.pretokens(t)]
    counts = tokencount.terminal_counts(set(tokens), vocabulary)
    for token in set(tokens):
        best = max(all_ways(token, vocabulary), key=lambda x: x[1])
        assert counts[token] == len(best[0])
    docs = docs_of(spark, [(i, t, "en") for i, t in enumerate(TEXTS)])
    got = {r.doc_id: r.n_tokens for r in tokencount.count_tokens(docs).collect()}
    lattices = segment.Lattices(vocabulary, segment.trie_of(vocabulary))
    best, _ = segment.segment(TEXTS, [0] * len(TEXTS), lattices, 1)
    assert [got[i] for i in range(len(TEXTS))] == [len(b) for b in best] and got[0] == got[1] == 0
    assert tokencount.count_tokens(docs_of(spark, [])).count() == 0


def test_sampling_without_replacement_follows_the_model(vocabulary):
    lattices = segment.Lattices(vocabulary, segment.trie_of(vocabulary))
    text, n = "the cat\nx", 3000
    ways = [((), 0.0)]
    for token in pieces.pretokens(text):
        ways = [(a + b, x + y) for a, x in ways for b, y in all_ways(token, vocabulary)]
    total = np.logaddexp.reduce([x for _, x in ways])
    share = {ids: float(np.exp(x - total)) for ids, x in ways}
    _, drawn = segment.segment([text] * n, [segment.seed_of(i, 1) for i in range(n)], lattices, 3)
    first, estimate = {}, 0.0
    for row in drawn:
        ids = [tuple(s.ids.tolist()) for s in row]
        assert len(set(ids)) == 3 and sorted((s.perturbed for s in row), reverse=True) == [s.perturbed for s in row]
        assert all(abs(share[i] - np.exp(s.log_prob)) < 1e-9 and 0 < s.inclusion <= 1 for i, s in zip(ids, row))
        first[ids[0]] = first.get(ids[0], 0) + 1 / n
        estimate += sum(len(i) * np.exp(s.log_prob) / s.inclusion for i, s in zip(ids, row)) / n
    assert all(abs(first.get(i, 0) - p) < 0.04 for i, p in share.items())
    assert abs(estimate - sum(len(i) * p for i, p in share.items())) < 0.1
    every = segment.segment(["ab"], [1], lattices, 50)[1][0]
    assert len(every) == len(all_ways("▁ab", vocabulary)) and all(s.inclusion == 1 for s in every)


def test_segmentations_decode_to_the_text_and_repeat(spark, vocabulary):
    docs = docs_of(spark, [(i, t, "en") for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], "en")])
    rows = segment.segmentations(docs, k=3, seed=5).collect()
    for r in rows:
        assert r.pieces.decoded == (r.text or "")
        for s in r.pieces.samples:
            assert pieces.decode(s.ids, vocabulary) == (r.text or "")
    twice = [r.pieces for r in rows if r.doc_id == 3]
    assert twice[0] == twice[1]
    again = segment.segmentations(docs.repartition(3), k=3, seed=5).collect()
    assert sorted(map(str, again)) == sorted(map(str, rows))
    assert segment.segmentations(docs_of(spark, [])).count() == 0


# --- neighbours ----------------------------------------------------------------------------------

def test_neighbours_recall_and_exact_scores(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 300)
    monkeypatch.setattr(ann, "QUERIES", 16)
    rng = np.random.default_rng(3)
    vectors = rng.standard_normal((1500, 32)).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    odd = [(5000, None), (5050, []), (5100, [0.0] * 32), (5150, [float("nan")] + [1.0] * 31),
           (5200, [None] + [1.0] * 31), (5250, [1.0, 2.0]), (7, rows[7][1]), (None, rows[8][1])]
    table = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>")
    got = ann.nearest(table, table.filter("vec_id % 50 = 0")).collect()
    found = {}
    for r in got:
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    x = vectors.astype(float)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    hits = 0
    for q in range(0, 1500, 50):
        best = unit @ unit[q]
        best[q] = -2
        mine = sorted(found[q])
        assert [r for r, *_ in mine] == [1, 2, 3, 4, 5]
        assert all(abs(best[v] - s) < 1e-12 for _, v, s in mine)
        hits += len({v for _, v, _ in mine} & set(np.argsort(-best)[:5].tolist()))
    assert hits >= 0.9 * 5 * 30
    assert not {5000, 5050, 5100, 5150, 5200, 5250} & set(found)
    few = spark.createDataFrame(rows[:3], "vec_id long, embedding array<float>")
    assert ann.nearest(few, few.filter("vec_id = 0")).count() == 2
    assert ann.nearest(table.limit(0), table.limit(0)).count() == 0


def test_repeated_vectors_are_searched_once(spark):
    vectors = np.random.default_rng(3).standard_normal((60, 8))
    times = np.ones(60, np.int64)
    times[[3, 7]] = 2, 4000
    ids = np.arange(60)
    counted = ann.search_block(ids[:6], vectors[:6], ids, vectors, 5, 7, times)
    repeated = ann.search_block(ids[:6], vectors[:6], np.repeat(ids, times), np.repeat(vectors, times, 0), 5, 7)
    for a, b in zip(counted, repeated):
        assert np.array_equal(a, b)
    rows = [(int(i), [float(x) for x in vectors[i]]) for i in np.repeat(ids, np.minimum(times, 40))]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = ann.nearest(table, table.filter("vec_id < 6")).collect()
    assert sorted((r.query_id, r.vec_id, r.score) for r in got) == sorted(zip(*(a.tolist() for a in counted)))


def test_cosines_of_huge_and_tiny_vectors(spark):
    vectors = [[1e200, 1e200], [1.0, 1.0], [1e-200, 0.0], [5e-324, 0.0], [-1e308, 1e308]]
    table = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")
    scores = {(r.query_id, r.vec_id): r.score for r in ann.nearest(table, table).collect()}
    assert len(scores) == 20
    assert scores[0, 1] == pytest.approx(1.0) and scores[2, 3] == 1.0 and scores[0, 4] == 0.0
    assert scores[1, 2] == pytest.approx(0.5 ** 0.5) == scores[1, 3]


def test_a_query_id_with_several_vectors_asks_the_least(spark):
    table = spark.createDataFrame(
        [(1, [0.0, 1.0]), (1, [1.0, 0.0]), (2, [0.0, 2.0]), (3, [2.0, 0.1])], "vec_id long, embedding array<double>")
    for order in (table, table.orderBy(F.col("embedding").desc())):
        got = ann.nearest(table, order.filter("vec_id = 1"), k=1).collect()
        assert [(r.query_id, r.rank, r.vec_id, r.score) for r in got] == [(1, 1, 2, 1.0)]


def test_results_take_the_place_of_columns_with_their_names(spark):
    docs = spark.createDataFrame(
        [(1, "the cat", 9, "p", "s", True), (2, None, 9, "p", "s", True)],
        "doc_id long, text string, n_tokens int, Pieces string, _segment_key string, _letter boolean")
    plain = docs.select("doc_id", "text")
    counted = tokencount.count_tokens(docs)
    assert sorted(counted.columns) == sorted([*docs.columns, *set(tokencount.count_tokens(plain).columns) - set(docs.columns)])
    assert [r.n_tokens for r in counted.orderBy("doc_id").collect()] == [
        r.n_tokens for r in tokencount.count_tokens(plain).orderBy("doc_id").collect()]
    cut = segment.segmentations(docs)
    assert cut.columns == ["doc_id", "text", "n_tokens", "_segment_key", "_letter", "pieces"]
    assert [r.pieces for r in cut.orderBy("doc_id").collect()] == [
        r.pieces for r in segment.segmentations(plain).orderBy("doc_id").collect()]
    assert {r._segment_key for r in cut.collect()} == {"s"}
    nothing = docs.withColumns({"lang": F.lit(None).cast("string"), "_letter": F.lit("mine")})
    learned = nothing.withColumns({"lang": F.lit("en"), "_language_pred": F.lit("mine"), "doc_id": F.col("doc_id") + 1})
    assert [tuple(r) for r in language.keep_identified(nothing).collect()] == [
        tuple(r) for r in nothing.filter("doc_id = 1").collect()]
    assert {r._language_pred for r in language.keep_identified(learned).collect()} == {"mine"}


# --- chats ---------------------------------------------------------------------------------------

def test_only_maximal_conversations_stay(spark):
    talk = [("user", "hi"), ("assistant", "yes"), ("user", "more"), ("assistant", None)]
    rows = [(c, i, r, t) for c, n in ((1, 2), (2, 4), (3, 4), (4, 1)) for i, (r, t) in enumerate(talk[:n])]
    rows += [(5, 0, "user", "hi"), (5, 1, "assistant", "no"), (2, 0, "user", "hi"), (None, 0, "user", "null"),
             (6, 0, None, ""), (7, 0, "user", "hi"), (7, 7, "assistant", "yes"), (7, None, "user", "end")]
    rows += [(8, i, "user", f"turn {i}") for i in range(700)]
    schema = "conv_id long, turn long, role string, text string"
    chats = spark.createDataFrame([(*r, 1, 2) for r in rows], schema + ", pos long, conv long")
    got = {(r.conv_id, r.segment): r for r in chat.format_chats(chats).collect()}
    assert {c for c, _ in got} == {2, 5, None, 6, 7, 8}
    assert got[2, 0].copies == 2 and got[2, 0].n_turns == 4
    assert got[2, 0].text == "".join(f"<|im_start|>{r}\n{t or ''}<|im_end|>\n" for r, t in talk)
    assert [got[8, s].text.count("<|im_start|>") for s in range(3)] == [256, 256, 188]
    assert chat.format_chats(chats.limit(0)).count() == 0


def test_texts_of_chats_move_late(spark, monkeypatch):
    """Where nothing is broadcast the rows are the same, and what is stored holds no text."""
    rows = [(c, t, "user" if t % 2 == 0 else None, None if (c + t) % 5 == 0 else f"{t} of {c % 3}")
            for c in range(12) for t in range(2 + c % 4)] * 3
    rows += [(90, 0, None, "user"), (91, 0, "system", None), (92, 0, "system", ""), (93, None, None, None)]
    chats = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    stored = []
    monkeypatch.setattr(chat, "stage", lambda df, keep=chat.stage: stored.append(df.columns) or keep(df))
    near = sorted(map(tuple, chat.format_chats(chats).collect()))
    monkeypatch.setattr(chat, "small_side", lambda df: df)
    assert sorted(map(tuple, chat.format_chats(chats).collect())) == near
    assert {90, 91, 92, 93} <= {r[0] for r in near} and len(stored) == 6
    assert not any("text" in columns for columns in stored)
    turns = {}
    for c, t, role, text in set(rows):
        turns.setdefault(c, []).append((t is None, t or 0, role, text))
    whole = {c: tuple(x[2:] for x in sorted(v, key=lambda x: x[:2])) for c, v in turns.items()}
    maximal = {w for w in whole.values() if not any(o != w and o[:len(w)] == w for o in whole.values())}
    want = sorted((min(c for c in whole if whole[c] == w), 0, len(w), sum(o == w for o in whole.values()), "".join(
        f"<|im_start|>{r or ''}\n{x or ''}<|im_end|>\n" for r, x in w)) for w in maximal)
    assert near == want


# --- pages and archives --------------------------------------------------------------------------

def test_articles_without_furniture_and_templates(spark):
    def page(body):
        return ("<!DOCTYPE html><html><head><title>t</title><script>a='</p>'</script></head><body><header>H"
                f"</header><nav><ul><li>menu</ul></nav>{body}<footer>f</footer></body></html>")
    rows = [(i, f"http://A.org/{i}", page(
        f"<div class='box'>same words</div><p>own <b>te</b>xt&nbsp;{i} &amp;\n more<p>two{i}<div class=comments>c</div>"))
        for i in range(6)]
    rows += [(10, "http://b.org/", page("<article><h1>Head</h1><p>a<br>b<aside>x</aside></article><p>out")),
             (11, None, "plain <unclosed"), (12, "u", None), (13, "u", ""), (10, "http://b.org/", page("<main>m</main>")),
             (14, "http://c.org", "<p>x" * 20_000), (15, "http://d", "<div>" * 5000 + "deep")]
    pages = spark.createDataFrame([(*r, "z", 3) for r in rows], "page_id long, url string, html string, host string, n_chars int")
    got = sorted((r.page_id, r.text, r.n_chars) for r in htmltext.extract(pages).collect())
    texts = {}
    for i, t, n in got:
        texts.setdefault(i, []).append(t)
        assert n == len(t)
    assert [texts[i] for i in range(6)] == [[f"own text {i} & more two{i}"] for i in range(6)]
    assert texts[10] == ["Head a b", "m"] and texts[12] == texts[13] == [""] and texts[11] == ["plain"]
    assert texts[14] == [" ".join(["x"] * 20_000)] and texts[15] == ["deep"]
    shuffled = htmltext.extract(pages, broadcast_bytes=-1).collect()
    assert sorted((r.page_id, r.text, r.n_chars) for r in shuffled) == got
    assert htmltext.extract(pages.limit(0)).count() == 0


def test_all_subtrees_are_counted_before_rules():
    page = "<body><div>Some long words in an unnamed box</div><nav><ul><li>menu</ul></nav><p>text</body>"
    root = htmltext.page_of(page)
    assert {"div", "ul", "nav"} >= {n.tag for n in htmltext._postorder(root) if n.hash in htmltext.subtrees(root)} >= {"div"}
    long = htmltext.page_of("<body><nav><a href=x>A long entry of the menu of a site</a></nav><p>own</body>")
    assert {n.tag for n in htmltext._postorder(long) if n.hash in htmltext.subtrees(long)} == {"nav", "a"}


def test_plain_rules_keep_article_text():
    long = "The text of the page stands here and is long. " * 3
    assert htmltext.text_of(f"<main><div>{long}</div><article class=card>More to read</article></main>") == f"{long}More to read"
    assert htmltext.text_of(f"<body><div>{long}</div><article class=card>More to read</article></body>") == f"{long}More to read"
    assert htmltext.text_of(f"<main><h1>Head</h1><article>{long}</article></main>") == f"Head {long}".strip()
    assert htmltext.text_of(f"<body><h1>Head</h1><article>{long}</article></body>") == f"Head {long}".strip()
    inner = ("<section id='related-work'>Related work</section><h2 id='comments-on-x'>On x</h2>"
             "<div class='share prices'>Prices</div><p class='notice'>Note</p><div class='related-posts'>gone</div>")
    assert htmltext.text_of(f"<article>{inner}</article>") == "Related work On x Prices Note"


def test_templates_need_no_majority_and_near_copies_make_none(spark):
    def own(k, n):
        return f"<p>Page {k} of this site has words of its own, such as {k * 7919} and {k * 104729}, {n} times.</p>"
    box, inline = "<div>Read all about our offers of this week</div>", "<x-banner>Buy now</x-banner>"
    rows = [(k, "http://big.org/", f"<body>{own(k, 1)}{own(k, 2)}{box if k % 5 < 2 else ''}{inline if k % 5 == 3 else ''}")
            for k in range(40)]
    rows += [(100 + k, None, f"<body>{own(k, 3)}{own(k, 4)}{box}" if k < 6 else f"<body>{own(k, 3)}") for k in range(20)]
    shared = "".join(f"<p>Paragraph {i} stands in each of the copies of one long article.</p>" for i in range(6))
    rows += [(200 + k, "http://copies.org/", f"<body><article>{own(k, 5)}{shared}</article>") for k in range(30)]
    rows += [(300 + k, "http://quotes.org/", f"<body><article><h1>The heading of every weekly report</h1>{own(k, 6)}{own(k, 7)}"
              f"{'<p>A sentence that some of the articles quote.</p>' if k < 10 else '<p>Released under the licence of this site.</p>'}")
             for k in range(40)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in htmltext.extract(pages).collect()}
    assert not any("offers" in t or "Buy now" in t for t in got.values())
    assert all(f"{k * 7919}" in got[k] for k in range(40))
    assert all(got[200 + k].count("Paragraph") == 6 for k in range(30))
    assert all("quote" in got[300 + k] for k in range(10)) and not any("licence" in t for t in got.values())
    assert all(got[300 + k].startswith("The heading") for k in range(40))
    assert {r.page_id: r.text for r in htmltext.extract(pages, broadcast_bytes=-1).collect()} == got


def test_archives_come_back_whole(spark, tmp_path):
    big = "<p>" + "x" * 200
    rows = [(1, "http://a/ü?q=1", big), (2, None, big), (3, "u", "short"), (4, "u", "short"), (5, "u", None),
            (6, "u", ""), (None, "u", big), (7, "u", "é" * 50), (8, "u", "é" * 50), (9, "u", "y" * 3_000_000), (1, "w", big)]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, digest long")
    got = warc.archive_round_trip(pages, payload=True).collect()
    assert len(got) == len(rows) and all(r.valid for r in got)
    for r in got:
        texts = [h or "" for i, u, h in rows if i == r.page_id and u == r.url]
        assert r.payload_digest == hashlib.sha256(texts[0].encode()).hexdigest()
        assert r.payload_bytes == len(texts[0].encode())
        assert (r.payload is None) == (r.record_type == "revisit")
        assert r.payload is None or bytes(r.payload) == texts[0].encode()
    refers = sorted((str(r.page_id), r.refers_to) for r in got if r.record_type == "revisit")
    assert refers == [("2", 1), ("8", 7), ("None", 1)]
    assert warc.archive_round_trip(pages.limit(0)).count() == 0


def test_reader_finds_damage():
    whole = warc.record(1, "u", b"payload" * 30, None) + warc.record(2, "u", b"", None)
    assert [r["page_id"] for r in warc.records(io.BytesIO(whole))] == [1, 2]
    with pytest.raises(warc.Damaged):
        list(warc.records(io.BytesIO(whole[:-12])))
    other = warc.record(1, "u", b"payload" * 30, None)
    import gzip
    changed = gzip.compress(gzip.decompress(other).replace(b"payloadp", b"paylaodp", 1))
    assert [r["valid"] for r in warc.records(io.BytesIO(changed))] == [False]


def test_digests_are_of_what_was_read(spark, tmp_path):
    import gzip
    whole = gzip.decompress(warc.record(1, "u", b"payload" * 30, None)).replace(b"payloadp", b"paylaodp", 1)
    (tmp_path / "part-0.warc.gz").write_bytes(gzip.compress(whole))
    rows = warc.read_archives(spark, str(tmp_path))
    (row,) = rows.collect()
    assert not row.valid and row.payload_digest == hashlib.sha256(bytes(row.payload)).hexdigest()
    for column in ("page_id", "payload_digest"):
        with pytest.raises(Exception, match="damaged record of page 1"):
            warc.checked(rows).select(column).collect()
