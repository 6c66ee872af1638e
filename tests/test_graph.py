"""Ranks and matrices of small graphs against plain Python, on every physical plan."""

import random

import pytest
from pyspark.sql import functions as F

from tarmac.operators import blocks, graph

TOY = "AB AD BC BE CD DE EA EB EC".split()
DANGLING_TOY = "AB AC AD BD BE CA CE DB".split()
# Broadcast ranks; sliced join with one slice per source; sliced join with many slices.
PLANS = [{}, {"broadcast_rows": 0}, {"broadcast_rows": 0, "edges_per_slice": 1}]


def _edges(spark, pairs, by=None):
    rows = [(p[0], p[1]) if by is None else (by, p[0], p[1]) for p in pairs]
    return spark.createDataFrame(
        rows, "src string, dst string" if by is None else "y int, src string, dst string")


def _plain_ranks(weighted, iterations, alpha=0.15, count_scale=False):
    nodes = sorted({n for pair in weighted for n in pair})
    out = {n: sum(w for (s, _), w in weighted.items() if s == n) for n in nodes}
    rank = {n: 1.0 if count_scale else 1 / len(nodes) for n in nodes}
    for _ in range(iterations):
        lost = sum(rank[n] for n in nodes if not out[n])
        sums = dict.fromkeys(nodes, 0.0)
        for (s, d), w in weighted.items():
            sums[d] += rank[s] * w / out[s]
        base = alpha if count_scale else alpha / len(nodes)
        extra = 0 if count_scale else lost / len(nodes)
        rank = {n: base + (1 - alpha) * (extra + sums[n]) for n in nodes}
    return rank


def _as_dict(df):
    return {r["id"]: r["rank"] for r in df.collect()}


def test_pagerank_of_toy_graphs(spark):
    ranks = _as_dict(graph.pagerank(_edges(spark, TOY), iterations=20))
    assert ranks["A"] == pytest.approx(0.115071178987, abs=1e-11)
    assert ranks["E"] == pytest.approx(0.300246576359, abs=1e-11)
    ranks = _as_dict(graph.pagerank(_edges(spark, DANGLING_TOY), iterations=20))
    want = {"A": 0.115920309448, "B": 0.302359919281, "C": 0.104396016309,
            "D": 0.232899730911, "E": 0.244424024050}
    assert ranks == pytest.approx(want, abs=1e-11)
    assert sum(ranks.values()) == pytest.approx(1)


@pytest.mark.parametrize("plan", PLANS)
def test_pagerank_with_a_hub_and_weights(spark, plan):
    rng = random.Random(3)
    pairs = [("hub", f"n{i}") for i in range(60)]
    pairs += [(f"n{rng.randrange(40)}", f"n{rng.randrange(60)}") for _ in range(120)]
    weighted = {}
    for pair in pairs:
        weighted[pair] = weighted.get(pair, 0) + 1
    edges = spark.createDataFrame(pairs, "src string, dst string")
    ranks = _as_dict(graph.pagerank(edges, iterations=4, **plan))
    assert ranks == pytest.approx(_plain_ranks(weighted, 4))
    counted = _as_dict(graph.pagerank(edges, iterations=4, scale="count", **plan))
    assert counted == pytest.approx(_plain_ranks(weighted, 4, count_scale=True))
    rescaled = _as_dict(
        graph.pagerank(edges, iterations=4, scale="count", rescale=True, **plan))
    assert sum(rescaled.values()) == pytest.approx(len(rescaled))


@pytest.mark.parametrize("plan", PLANS)
def test_pagerank_per_year_equals_one_run_per_year(spark, plan):
    both = _edges(spark, TOY, 1).unionByName(_edges(spark, DANGLING_TOY, 2))
    ranks = {(r.y, r.id): r["rank"] for r in
             graph.pagerank(both, by=("y",), iterations=6, **plan).collect()}
    for year, pairs in ((1, TOY), (2, DANGLING_TOY)):
        want = _plain_ranks({(p[0], p[1]): 1 for p in pairs}, 6)
        assert {n: ranks[year, n] for n in want} == pytest.approx(want)


def test_pagerank_stops_at_the_tolerance(spark):
    loose = _as_dict(graph.pagerank(_edges(spark, TOY), iterations=50, tolerance=0.05))
    exact = _plain_ranks({(p[0], p[1]): 1 for p in TOY}, 50)
    assert loose != pytest.approx(exact, abs=1e-9)
    assert loose == pytest.approx(exact, abs=0.05)


def test_edges_without_an_end_are_left_out(spark):
    edges = _edges(spark, TOY).unionByName(
        spark.createDataFrame([("A", None), (None, "B")], "src string, dst string"))
    want = _plain_ranks({(p[0], p[1]): 1 for p in TOY}, 3)
    assert _as_dict(graph.pagerank(edges, iterations=3)) == pytest.approx(want)
    assert graph.pagerank(edges.limit(0), iterations=3).count() == 0


def test_isolated_vertices_get_a_rank(spark):
    alone = spark.createDataFrame([("Z",)], "id string")
    ranks = _as_dict(graph.pagerank(_edges(spark, TOY), alone, iterations=5))
    assert len(ranks) == 6 and sum(ranks.values()) == pytest.approx(1)


def test_power_iteration_reaches_the_steady_state(spark):
    matrix = graph.transition_probabilities(graph.weighted_edges(_edges(spark, TOY)))
    start = spark.createDataFrame([("A", 1.0)], "id string, mass double")
    mass = {r.id: r.mass for r in graph.power_iteration(matrix, start, 6, squaring=True).collect()}
    want = {"A": 0.10526316, "B": 0.15789474, "C": 0.18421053, "D": 0.23684211, "E": 0.31578947}
    assert mass == pytest.approx(want, abs=1e-7)


@pytest.mark.parametrize("plan", PLANS)
def test_power_iteration_on_every_plan(spark, plan):
    matrix = graph.transition_probabilities(graph.weighted_edges(_edges(spark, TOY)))
    start = spark.createDataFrame([("A", 1.0)], "id string, mass double")
    got = graph.power_iteration(matrix, start, 3, **plan)
    targets = {}
    for pair in TOY:
        targets.setdefault(pair[0], []).append(pair[1])
    mass = {"A": 1.0}
    for _ in range(3):
        sent = dict.fromkeys("ABCDE", 0.0)
        for source, amount in mass.items():
            for target in targets[source]:
                sent[target] += amount / len(targets[source])
        mass = sent
    assert {r.id: r.mass for r in got.collect()} == pytest.approx(mass)


@pytest.mark.parametrize("side, products, per_key", [(2, 10**6, 1), (3, 10**6, 1024), (256, 10**6, 1024), (2, 9, 2), (4, 0, 1)])
def test_squaring_steps_in_blocks_of_any_size_and_beyond_them(spark, side, products, per_key):
    import random

    import numpy as np

    draw = random.Random(5)
    names = [f"n{i:02}" for i in range(11)]
    # a hub that a third of all edges touch, a vertex without outgoing edges, one that only sends
    pairs = {(draw.choice(names[:10]), draw.choice(names)) for _ in range(18)} | {("n03", n) for n in names[::2]}
    pairs |= {(n, "n03") for n in names[1:9:2]}
    matrix = graph.transition_probabilities(graph.weighted_edges(_edges(spark, sorted(pairs))))
    start = spark.createDataFrame([("n03", 0.75), ("n05", 0.25), ("nowhere", 3.0)], "id string, mass double")
    edges = matrix.withColumnRenamed("probability", "weight")
    got = blocks.squaring_steps(edges, graph.vertices_of(edges), start, 4, side, products, per_key).collect()
    ids = sorted({v for pair in pairs for v in pair})
    dense = np.zeros((len(ids), len(ids)))
    for r in matrix.collect():
        dense[ids.index(r.src), ids.index(r.dst)] = r.probability
    state = np.zeros(len(ids))
    state[ids.index("n03")], state[ids.index("n05")] = 0.75, 0.25
    for _ in range(15):
        state = state @ dense
    assert {r.id: r.mass for r in got} == pytest.approx(dict(zip(ids, state)), abs=1e-12)


def test_power_iteration_loses_mass_at_a_dangling_vertex(spark):
    matrix = graph.transition_probabilities(graph.weighted_edges(_edges(spark, DANGLING_TOY)))
    start = spark.createDataFrame([("A", 1.0)], "id string, mass double")
    assert graph.power_iteration(matrix, start, 5).agg(F.sum("mass")).first()[0] < 1


@pytest.mark.parametrize("plan", PLANS)
def test_transition_probabilities_sum_to_one(spark, plan):
    matrix = graph.transition_probabilities(graph.weighted_edges(_edges(spark, TOY)), **plan)
    assert matrix.count() == len(TOY)
    sums = matrix.groupBy("src").agg(F.sum("probability").alias("s")).collect()
    assert [r.s for r in sums] == pytest.approx([1.0] * 5)


def test_adjacency_line(spark):
    lines = spark.createDataFrame([("1\t{'2': 1, '3': 5}",)], "value string")
    edges = graph.parse_adjacency(lines)
    assert {tuple(r) for r in edges.collect()} == {("1", "2", 1), ("1", "3", 5)}
    degree = graph.out_degrees(edges).first()
    assert (degree.out_degree, degree.out_weight) == (2, 6)
    assert {r.id for r in graph.dangling_vertices(edges).collect()} == {"2", "3"}
    counts = graph.vertex_counts(edges).first()
    assert (counts.vertices, counts.dangling) == (3, 2)


def test_adjacency_lines_of_all_kinds(spark):
    lines = spark.createDataFrame([
        ("a\t{'b': 1}",), ('c\t{"O\'Hare": 2, \'d\': 3}',), ("e\t{}",), ("f\t{'a': 3000000000}",),
        ("no tab",), ("g\t{'x': ",), (None,)], "value string")
    assert {tuple(r) for r in graph.parse_adjacency(lines).collect()} == {
        ("a", "b", 1), ("c", "O'Hare", 2), ("c", "d", 3), ("f", "a", 3_000_000_000)}
    assert {r.id for r in graph.adjacency_vertices(lines).collect()} == set("abcdef") | {"O'Hare"}
    assert tuple(graph.adjacency_rejects(lines).first()) == (7, 3)


def test_edges_with_a_null_end_are_no_transitions(spark):
    edges = spark.createDataFrame([("a", "b", 1), ("a", None, 5), (None, "b", 2), ("a", "c", 3)],
                                  "src string, dst string, weight long")
    rows = {tuple(r) for r in graph.transition_probabilities(edges).collect()}
    assert rows == {("a", "b", 0.25), ("a", "c", 0.75)}


def test_adjacency_lists_are_whole_when_split(spark):
    edges = graph.weighted_edges(_edges(spark, DANGLING_TOY))
    split = graph.adjacency_lists(edges, 1).collect()
    assert sorted(r.src + d for r in split for d in r.neighbours) == sorted(DANGLING_TOY)
    whole = {r.src: r.neighbours for r in graph.adjacency_lists(edges).collect()}
    assert whole == {"A": ["B", "C", "D"], "B": ["D", "E"], "C": ["A", "E"], "D": ["B"]}


def test_adjacency_matrix(spark):
    edges = graph.weighted_edges(_edges(spark, DANGLING_TOY))
    cells = {tuple(r) for r in graph.adjacency_matrix(edges, graph.vertices_of(edges)).collect()}
    assert cells == {tuple(r) for r in edges.collect()} | {("E", None, None)}
    wide = spark.range(3000).select(
        F.col("id").cast("string").alias("src"), (F.col("id") + 1).cast("string").alias("dst"))
    assert graph.adjacency_matrix(wide, graph.vertices_of(wide)).count() == 3001


def test_chunk_features_are_true_means(spark):
    rows = [(0, "a", "b", 1.0), (0, "a", "b", 3.0), (0, "a", "b", 8.0), (1, "a", "b", 6.0)]
    df = spark.createDataFrame(rows, "c long, o string, d string, x double")
    chunks = graph.chunk_edges(df, F.col("c"), "o", "d", [F.col("x")])
    assert {(r.chunk, r.f0) for r in chunks.collect()} == {(0, 4.0), (1, 6.0)}
    n = spark.createDataFrame([(2,)], "n_vertices int")
    targets = graph.chunk_targets(chunks, "f0", n)
    pairs = graph.next_chunk_pairs(chunks, targets).collect()
    assert [(r.chunk, r.f0, r.target) for r in pairs] == [(0, 4.0, 3.0)]


def test_ranks_of_many_vertices_join_a_row_per_source(spark, monkeypatch):
    """Beyond the broadcast bound names are hashed and a hub's edges lie in several lists."""
    pairs = [("hub", f"v{i}") for i in range(40)] + [(f"v{i}", f"v{i * 7 % 40}") for i in range(0, 40, 3)]
    edges, seen, send = _edges(spark, pairs), [], graph._send_lists

    def watched(lists, *rest):
        seen.append((lists.count(), lists.schema["src"].dataType.simpleString()))
        return send(lists, *rest)

    monkeypatch.setattr(graph, "_send_lists", watched)
    wanted = _as_dict(graph.pagerank(edges, iterations=3))
    assert not seen
    monkeypatch.setattr(graph, "LIST_SIZE", 10)
    found = _as_dict(graph.pagerank(edges, iterations=3, broadcast_rows=0))
    assert found == pytest.approx(wanted)
    assert len(seen) == 3 and seen[0][1] == "bigint" and 14 + 2 <= seen[0][0] <= 14 + 4
    monkeypatch.setattr(graph.F, "xxhash64", lambda *_: graph.F.lit(5).cast("long"))  # all alike
    assert _as_dict(graph.pagerank(edges, iterations=3, broadcast_rows=0)) == pytest.approx(wanted)
    assert seen[-1][1] == "string"
