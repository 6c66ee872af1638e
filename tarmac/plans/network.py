"""Graph queries on purchases, trips between nations and links of pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from tarmac.functions.times import time_chunk
from tarmac.operators import graph
from tarmac.operators.features import standardise
from tarmac.operators.joins import attach_to_ends
from tarmac.operators.profile import averages_by
from tarmac.plans.common import (
    PURCHASES_SQL, TRIPS_SQL, Query, purchases, r6, rounded, table, trips,
)
from tarmac.session import cut

_ROUNDS, _YEARLY_ROUNDS, _SQUARINGS = 10, 15, 10
_LIST = 16


def _purchase_edges(spark, folder):
    return graph.weighted_edges(purchases(spark, folder))


def _nation_edges(spark, folder):
    rows = trips(spark, folder).select(F.col("origin").alias("src"), F.col("dest").alias("dst"))
    return graph.weighted_edges(rows)


_NATION_EDGES_SQL = f"""
  SELECT origin AS src, dest AS dst, count(*) AS weight FROM ({TRIPS_SQL}) GROUP BY 1, 2"""


def graph_edges_weighted(spark, folder):
    return _purchase_edges(spark, folder)


def graph_vertices(spark, folder):
    return graph.vertices_of(purchases(spark, folder))


def adjacency_text_edges(spark, folder):
    customers = table(spark, folder, "customer")
    lines = customers.select(F.format_string(
        "c%d\t{'n%d': 1, '%s': 2}", "c_custkey", "c_nationkey", "c_mktsegment").alias("value"))
    return graph.parse_adjacency(lines)


def page_link_edges(spark, folder):
    return graph.edges_from_links(table(spark, folder, "pages"), "url", "html")


def out_degree(spark, folder):
    return graph.out_degrees(_purchase_edges(spark, folder))


def degree_stats(spark, folder):
    return rounded(graph.degree_summary(_purchase_edges(spark, folder)), "mean_degree")


def top_degrees(spark, folder):
    degrees = graph.out_degrees(_purchase_edges(spark, folder))
    return degrees.orderBy(F.desc("out_weight"), "id").limit(10)


def degree_histogram(spark, folder):
    degrees = graph.out_degrees(_purchase_edges(spark, folder))
    return degrees.groupBy("out_weight").agg(F.count(F.lit(1)).alias("n"))


def dangling_nodes(spark, folder):
    return graph.dangling_vertices(_purchase_edges(spark, folder))


def node_count(spark, folder):
    return rounded(graph.vertex_counts(_purchase_edges(spark, folder)), "dangling_share")


def adjacency_list(spark, folder):
    lists = graph.adjacency_lists(_purchase_edges(spark, folder), _LIST)
    return lists.select("src", "block", F.array_join("neighbours", ",").alias("neighbours"))


def adjacency_matrix(spark, folder):
    nations = table(spark, folder, "nation").select(F.col("n_nationkey").alias("id"))
    return graph.adjacency_matrix(_nation_edges(spark, folder), nations)


def transition_probs(spark, folder):
    return rounded(
        graph.transition_probabilities(_purchase_edges(spark, folder)), "probability", digits=8)


def power_iteration(spark, folder, squaring=False):
    matrix = graph.transition_probabilities(_nation_edges(spark, folder))
    start = table(spark, folder, "nation").select(
        F.col("n_nationkey").alias("id"),
        F.when(F.col("n_nationkey") == 0, 1.0).otherwise(0.0).alias("mass"))
    return rounded(graph.power_iteration(matrix, start, _SQUARINGS if squaring else 10, squaring),
                   "mass", digits=8)


def power_iteration_squared(spark, folder):
    return power_iteration(spark, folder, squaring=True)


def _power_sql(multiplications):
    steps = "".join(
        f""",
x{i} AS MATERIALIZED (SELECT dst AS id, sum(mass * p) AS mass FROM x{i - 1} JOIN m ON id = src
  GROUP BY 1)"""
        for i in range(1, multiplications + 1)
    )
    return f"""
WITH e AS MATERIALIZED ({_NATION_EDGES_SQL}),
m AS MATERIALIZED (SELECT src, dst, weight / (sum(weight) OVER (PARTITION BY src))::DOUBLE AS p
  FROM e),
x0 AS (SELECT n_nationkey AS id, CASE WHEN n_nationkey = 0 THEN 1.0::DOUBLE ELSE 0 END AS mass
  FROM nation){steps}
SELECT id, round(mass, 8) AS mass FROM x{multiplications}"""


def _squarings_sql(steps):
    """Each step multiplies the vector by the matrix, and then the matrix by itself."""
    ctes = "".join(
        f""",
x{i} AS MATERIALIZED (SELECT dst AS id, sum(mass * p) AS mass FROM x{i - 1} JOIN m{i - 1} ON id = src
  GROUP BY 1),
m{i} AS MATERIALIZED (SELECT a.src, b.dst, sum(a.p * b.p) AS p FROM m{i - 1} a
  JOIN m{i - 1} b ON a.dst = b.src GROUP BY 1, 2)"""
        for i in range(1, steps + 1)
    )
    return f"""
WITH e AS MATERIALIZED ({_NATION_EDGES_SQL}),
m0 AS MATERIALIZED (SELECT src, dst, weight / (sum(weight) OVER (PARTITION BY src))::DOUBLE AS p
  FROM e),
x0 AS (SELECT n_nationkey AS id, CASE WHEN n_nationkey = 0 THEN 1.0::DOUBLE ELSE 0 END AS mass
  FROM nation){ctes}
SELECT id, round(mass, 8) AS mass FROM x{steps}"""


def pagerank(spark, folder):
    ranks = graph.pagerank(purchases(spark, folder), iterations=_ROUNDS)
    return rounded(ranks, "rank", digits=8)


def pagerank_mass(spark, folder):
    ranks = graph.pagerank(purchases(spark, folder), iterations=_ROUNDS)
    return rounded(graph.total_mass(ranks), "mass", digits=8)


def pagerank_count_scale(spark, folder):
    ranks = graph.pagerank(
        purchases(spark, folder), iterations=_ROUNDS, scale="count", rescale=True)
    return rounded(ranks, "rank", digits=8)


def pagerank_links(spark, folder):
    edges = graph.edges_from_links(table(spark, folder, "pages"), "url", "html")
    return rounded(graph.pagerank(edges, iterations=_ROUNDS), "rank", digits=8)


def pagerank_topk(spark, folder):
    ranks = pagerank(spark, folder)
    return ranks.orderBy(F.desc("rank"), "id").limit(20)


def pagerank_slice(spark, folder):
    ranks = pagerank(spark, folder)
    return ranks.orderBy(F.desc("rank"), "id").offset(20).limit(20)


def _yearly_ranks(trip_rows):
    edges = trip_rows.select(
        "year", F.col("origin").alias("src"), F.col("dest").alias("dst"))
    return graph.pagerank(edges, by=("year",), iterations=_YEARLY_ROUNDS, scale="count")


def _dated_trips(spark, folder):
    return trips(spark, folder).withColumn("year", F.year("o_orderdate"))


def pagerank_by_year(spark, folder):
    return rounded(_yearly_ranks(_dated_trips(spark, folder)), "rank", digits=8)


_ENDS = {"origin": "origin_rank", "dest": "dest_rank"}


def attach_rank_both_ends(spark, folder):
    rows = _dated_trips(spark, folder).select(
        "l_orderkey", "l_linenumber", "l_partkey", "year", "origin", "dest")
    ranks = cut(_yearly_ranks(rows))
    return rounded(attach_to_ends(rows, ranks, _ENDS, by=("year",)), *_ENDS.values(), digits=8)


def mean_rank_holdout(spark, folder):
    rows = _dated_trips(spark, folder).select(
        "l_orderkey", "l_linenumber", "l_partkey", "year", "origin", "dest")
    ranks = _yearly_ranks(rows.filter(F.col("year") != 2000))
    means = cut(averages_by(ranks, "id", ["rank"]).withColumnRenamed("avg_rank", "rank"))
    held_out = rows.filter(F.col("year") == 2000)
    return rounded(attach_to_ends(held_out, means, _ENDS), *_ENDS.values(), digits=8)


def _pagerank_ctes(edges_sql, rounds, scale="probability", by=""):
    """The iterations unrolled as one table expression each; the last one is ``ranks``."""
    key = f"{by}, " if by else ""
    using = f"({by}, id)" if by else "(id)"
    count = "n" if scale == "probability" else "1"
    per_graph = f"JOIN n USING ({by})" if by else ", n"
    group = f"GROUP BY {by}" if by else ""
    lost_join = f"LEFT JOIN lost{{i}} USING ({by})" if by else ", lost{i}"
    ctes = f"""e AS MATERIALIZED ({edges_sql}),
w AS MATERIALIZED (SELECT {key}src AS id, sum(weight)::DOUBLE AS w FROM e GROUP BY ALL),
v AS MATERIALIZED (SELECT {key}src AS id FROM e UNION SELECT {key}dst FROM e),
n AS MATERIALIZED (SELECT {key}count(*)::DOUBLE AS n FROM v {group}),
r0 AS MATERIALIZED (SELECT {key}id, 1.0::DOUBLE / {count} AS rank FROM v {per_graph})"""
    for i in range(rounds):
        join_e = f"e.src = r.id AND e.{by} = r.{by}" if by else "e.src = r.id"
        columns = f"r.{by}, " if by else ""
        new = (
            "0.15 / n + 0.85 * (coalesce(lost, 0) / n + coalesce(s, 0))"
            if scale == "probability" else "0.15 + 0.85 * coalesce(s, 0)"
        )
        ctes += f""",
lost{i} AS MATERIALIZED (SELECT {key}sum(rank) AS lost FROM r{i} ANTI JOIN w USING {using} {group}),
s{i} AS MATERIALIZED (SELECT {columns}dst AS id, sum(rank * weight / w) AS s
  FROM (SELECT * FROM r{i} JOIN w USING {using}) r JOIN e ON {join_e} GROUP BY ALL),
r{i + 1} AS MATERIALIZED (SELECT {key}id, {new} AS rank
  FROM v LEFT JOIN s{i} USING {using} {per_graph} {lost_join.format(i=i)})"""
    return ctes + f",\nranks AS (SELECT * FROM r{rounds})"


_RANKS = _pagerank_ctes(PURCHASES_SQL, _ROUNDS)
_YEAR_EDGES_SQL = f"""SELECT CAST(year(o_orderdate) AS INT) AS year, origin AS src, dest AS dst,
  count(*) AS weight FROM ({TRIPS_SQL}) {{where}} GROUP BY ALL"""
_LINKS_SQL = """SELECT src, dst, count(*) AS weight FROM
  (SELECT url AS src, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS dst FROM pages)
  GROUP BY 1, 2"""

_SCALED = ["l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
           "o_totalprice", "o_custkey"]
_FEATURES = [f"f{i}" for i in range(8)]


def _chunk_rows(spark, folder):
    """Six scaled measures and two delays per day, origin and destination."""
    scaled = standardise(trips(spark, folder), _SCALED)
    vector = graph.vector_features(
        F.array(*[F.col(f"{c}_scaled") for c in _SCALED]), 2, 6,
        [F.greatest(F.datediff("l_shipdate", "o_orderdate"), F.lit(0)) / F.lit(60.0),
         F.col("l_linenumber") / F.lit(60.0)],
    )
    rows = scaled.withColumn("vector", vector)
    return graph.chunk_edges(
        rows, time_chunk(F.col("l_shipdate"), 24), "origin", "dest",
        [F.col("vector")[i] for i in range(8)],
    )


_CHUNKS_SQL = f"""
t AS MATERIALIZED ({TRIPS_SQL}),
m AS MATERIALIZED (SELECT {", ".join(
    f"avg({c}) AS m{i}, stddev_samp({c}) AS d{i}" for i, c in enumerate(_SCALED))} FROM t),
c AS MATERIALIZED (SELECT CAST(floor((epoch(l_shipdate) - 1420070400) / 86400) AS BIGINT) AS chunk,
  origin, dest, {", ".join(
    f"avg(({c} - m{i}) / d{i}) AS f{i - 2}" for i, c in enumerate(_SCALED) if i >= 2)},
  avg(greatest(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)), 0)
      / 60.0::DOUBLE) AS f6,
  avg(l_linenumber / 60.0::DOUBLE) AS f7 FROM t, m GROUP BY ALL),
nv AS (SELECT greatest(max(origin), max(dest)) + 1 AS n FROM c),
y AS MATERIALIZED (SELECT chunk, origin, sum(f6) / any_value(n) AS target FROM c, nv
  GROUP BY 1, 2)"""


def _vertex_total(chunks):
    return chunks.agg((F.greatest(F.max("origin"), F.max("dest")) + 1).alias("n_vertices"))


def chunk_edge_features(spark, folder):
    return rounded(_chunk_rows(spark, folder), *_FEATURES)


def sparse_coords(spark, folder):
    chunks = _chunk_rows(spark, folder)
    return rounded(graph.coordinates(chunks, _FEATURES), "value")


def chunk_node_target(spark, folder):
    chunks = cut(_chunk_rows(spark, folder))
    return rounded(graph.chunk_targets(chunks, "f6", _vertex_total(chunks)), "target")


def chunk_next_pairs(spark, folder):
    chunks = cut(_chunk_rows(spark, folder))
    targets = graph.chunk_targets(chunks, "f6", _vertex_total(chunks))
    pairs = graph.next_chunk_pairs(chunks, targets)
    return rounded(pairs, *_FEATURES, "target")


def chunk_sparsity(spark, folder):
    chunks = cut(_chunk_rows(spark, folder))
    targets = graph.chunk_targets(chunks, "f6", _vertex_total(chunks))
    return rounded(
        graph.chunk_sparsity(chunks, targets, _FEATURES), "mean_cells", "mean_targets")


def vector_slice_append(spark, folder):
    vectors = table(spark, folder, "embeddings")
    cut_out = graph.vector_features(
        F.col("embedding").cast("array<double>"), 2, 6, [F.col("label") / F.lit(60.0)])
    return vectors.select("vec_id", *[
        r6(F.get(cut_out, F.lit(i))).alias(f"v{i}") for i in range(7)])


_ROUNDED_FEATURES = ", ".join(f"round({f}, 6) AS {f}" for f in _FEATURES)

QUERIES = {
    "graph_edges_weighted": Query(graph_edges_weighted, PURCHASES_SQL),
    "graph_vertices": Query(graph_vertices, f"""
SELECT src AS id FROM ({PURCHASES_SQL}) UNION SELECT dst FROM ({PURCHASES_SQL})"""),
    "adjacency_text_edges": Query(adjacency_text_edges, """
SELECT 'c' || c_custkey AS src, 'n' || c_nationkey AS dst, CAST(1 AS INT) AS weight FROM customer
UNION ALL SELECT 'c' || c_custkey, c_mktsegment, 2 FROM customer"""),
    "page_link_edges": Query(page_link_edges, _LINKS_SQL),
    "out_degree": Query(out_degree, f"""
SELECT src AS id, count(*) AS out_degree, CAST(sum(weight) AS BIGINT) AS out_weight
FROM ({PURCHASES_SQL}) GROUP BY 1"""),
    "degree_stats": Query(degree_stats, f"""
WITH d AS (SELECT src, CAST(sum(weight) AS BIGINT) AS w FROM ({PURCHASES_SQL}) GROUP BY 1)
SELECT count(*) AS sources, CAST(sum(w) AS BIGINT) AS total_degree,
       round(avg(w), 6) AS mean_degree FROM d"""),
    "top_degrees": Query(top_degrees, f"""
SELECT src AS id, count(*) AS out_degree, CAST(sum(weight) AS BIGINT) AS out_weight
FROM ({PURCHASES_SQL}) GROUP BY 1 ORDER BY out_weight DESC, id LIMIT 10"""),
    "degree_histogram": Query(degree_histogram, f"""
WITH d AS (SELECT src, CAST(sum(weight) AS BIGINT) AS w FROM ({PURCHASES_SQL}) GROUP BY 1)
SELECT w AS out_weight, count(*) AS n FROM d GROUP BY 1"""),
    "dangling_nodes": Query(dangling_nodes, f"""
SELECT DISTINCT dst AS id FROM ({PURCHASES_SQL})
WHERE dst NOT IN (SELECT src FROM ({PURCHASES_SQL}))"""),
    "node_count": Query(node_count, f"""
WITH e AS ({PURCHASES_SQL}), v AS (SELECT src AS id FROM e UNION SELECT dst FROM e),
d AS (SELECT count(*) AS k FROM v WHERE id NOT IN (SELECT src FROM e))
SELECT count(*) AS vertices, any_value(k) AS dangling,
       round(any_value(k)::DOUBLE / count(*), 6) AS dangling_share FROM v, d"""),
    "adjacency_list": Query(adjacency_list, f"""
WITH e AS (SELECT src, dst, (row_number() OVER (PARTITION BY src ORDER BY dst) - 1) // {_LIST} AS block
  FROM ({PURCHASES_SQL}))
SELECT src, block, string_agg(dst, ',' ORDER BY dst) AS neighbours FROM e GROUP BY 1, 2"""),
    "adjacency_matrix": Query(adjacency_matrix, f"""
WITH e AS ({_NATION_EDGES_SQL})
SELECT n_nationkey AS src, dst, weight FROM nation LEFT JOIN e ON n_nationkey = src"""),
    "transition_probs": Query(transition_probs, f"""
WITH e AS ({PURCHASES_SQL})
SELECT src, dst, round(weight / (sum(weight) OVER (PARTITION BY src))::DOUBLE, 8) AS probability
FROM e"""),
    "power_iteration": Query(power_iteration, _power_sql(10)),
    "power_iteration_squared": Query(power_iteration_squared, _squarings_sql(_SQUARINGS)),
    "pagerank": Query(pagerank, f"""
WITH {_RANKS} SELECT id, round(rank, 8) AS rank FROM ranks"""),
    "pagerank_mass": Query(pagerank_mass, f"""
WITH {_RANKS} SELECT round(sum(rank), 8) AS mass, count(*) AS vertices FROM ranks"""),
    "pagerank_count_scale": Query(pagerank_count_scale, f"""
WITH {_pagerank_ctes(PURCHASES_SQL, _ROUNDS, "count")},
t AS (SELECT sum(rank) AS total FROM ranks)
SELECT id, round(rank * n / total, 8) AS rank FROM ranks, n, t"""),
    "pagerank_links": Query(pagerank_links, f"""
WITH {_pagerank_ctes(_LINKS_SQL, _ROUNDS)} SELECT id, round(rank, 8) AS rank FROM ranks"""),
    "pagerank_topk": Query(pagerank_topk, f"""
WITH {_RANKS} SELECT id, round(rank, 8) AS rank FROM ranks ORDER BY 2 DESC, 1 LIMIT 20"""),
    "pagerank_slice": Query(pagerank_slice, f"""
WITH {_RANKS} SELECT id, round(rank, 8) AS rank FROM ranks ORDER BY 2 DESC, 1
LIMIT 20 OFFSET 20"""),
    "pagerank_by_year": Query(pagerank_by_year, f"""
WITH {_pagerank_ctes(_YEAR_EDGES_SQL.format(where=""), _YEARLY_ROUNDS, "count", "year")}
SELECT year, id, round(rank, 8) AS rank FROM ranks"""),
    "attach_rank_both_ends": Query(attach_rank_both_ends, f"""
WITH {_pagerank_ctes(_YEAR_EDGES_SQL.format(where=""), _YEARLY_ROUNDS, "count", "year")},
t AS (SELECT *, CAST(year(o_orderdate) AS INT) AS year FROM ({TRIPS_SQL}))
SELECT l_orderkey, l_linenumber, l_partkey, t.year, origin, dest,
       round(a.rank, 8) AS origin_rank, round(b.rank, 8) AS dest_rank
FROM t LEFT JOIN ranks a ON a.year = t.year AND a.id = origin
LEFT JOIN ranks b ON b.year = t.year AND b.id = dest"""),
    "mean_rank_holdout": Query(mean_rank_holdout, f"""
WITH {_pagerank_ctes(_YEAR_EDGES_SQL.format(where="WHERE year(o_orderdate) <> 2000"), _YEARLY_ROUNDS,
                     "count", "year")},
a AS (SELECT id, avg(rank) AS rank FROM ranks GROUP BY 1),
t AS (SELECT *, CAST(year(o_orderdate) AS INT) AS year FROM ({TRIPS_SQL}))
SELECT l_orderkey, l_linenumber, l_partkey, year, origin, dest,
       round(o.rank, 8) AS origin_rank, round(d.rank, 8) AS dest_rank
FROM t LEFT JOIN a o ON o.id = origin LEFT JOIN a d ON d.id = dest WHERE year = 2000"""),
    "chunk_edge_features": Query(chunk_edge_features, f"""
WITH {_CHUNKS_SQL} SELECT chunk, origin, dest, {_ROUNDED_FEATURES} FROM c"""),
    "sparse_coords": Query(sparse_coords, f"WITH {_CHUNKS_SQL} " + " UNION ALL ".join(
        f"SELECT chunk, origin, dest, CAST({i} AS INT) AS feature, round(f{i}, 6) AS value FROM c"
        for i in range(8))),
    "chunk_node_target": Query(chunk_node_target, f"""
WITH {_CHUNKS_SQL} SELECT chunk, origin, round(target, 6) AS target FROM y"""),
    "chunk_next_pairs": Query(chunk_next_pairs, f"""
WITH {_CHUNKS_SQL}
SELECT c.chunk, c.origin, dest, {_ROUNDED_FEATURES}, round(coalesce(target, 0), 6) AS target
FROM c LEFT JOIN y ON y.chunk = c.chunk + 1 AND y.origin = c.origin
WHERE c.chunk + 1 IN (SELECT chunk FROM y)"""),
    "chunk_sparsity": Query(chunk_sparsity, f"""
WITH {_CHUNKS_SQL},
k AS (SELECT chunk, count(*) FILTER (WHERE {" OR ".join(f"{f} <> 0" for f in _FEATURES)}) AS cells
  FROM c GROUP BY 1),
z AS (SELECT chunk, count(*) FILTER (WHERE target <> 0) AS ends FROM y GROUP BY 1)
SELECT round(avg(cells), 6) AS mean_cells, round(avg(ends), 6) AS mean_targets
FROM k JOIN z USING (chunk)"""),
    "vector_slice_append": Query(vector_slice_append, "SELECT vec_id, " + ", ".join(
        f"round(embedding[{i + 3}]::DOUBLE, 6) AS v{i}" for i in range(6)
    ) + ", round(label / 60.0::DOUBLE, 6) AS v6 FROM embeddings"),
}
