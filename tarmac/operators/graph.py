"""Graphs as edge tables: parsing, degrees, ranks and matrices.

A graph is a table of edges ``(src, dst, weight)``; with ``by`` columns in front, one table holds
many graphs (one per year, say) and every operator treats them all in one job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.operators import blocks
from tarmac.operators.clean import complete_rows
from tarmac.operators.joins import BROADCAST_ROWS, attach_scalars, broadcast_if_small
from tarmac.operators.ordered import number_rows
from tarmac.session import cut, cut_by, stage

EDGES_PER_SLICE = 1_000_000
LIST_SIZE = 100_000


def parse_adjacency(lines: DataFrame, column: str = "value") -> DataFrame:
    """Edges from lines of the form ``node<TAB>{'neighbour': count, ...}``.

    Names may stand in single or double quotes. A node without neighbours gives no edge but is one
    of ``adjacency_vertices``; a line that cannot be read is counted by ``adjacency_rejects``.
    """
    node, neighbours = _adjacency(column)
    return lines.select(node.alias("src"), F.explode(neighbours).alias("dst", "weight"))


def _adjacency(column: str) -> tuple[Column, Column]:
    parts = F.split(F.col(column), "\t", 2)
    return F.get(parts, 0), F.from_json(F.get(parts, 1), "map<string,bigint>")


def adjacency_vertices(lines: DataFrame, column: str = "value") -> DataFrame:
    """Distinct nodes of the lines that can be read, with or without neighbours, and neighbours."""
    node, neighbours = _adjacency(column)
    names = F.explode(F.concat(F.array(node), F.map_keys(neighbours)))
    return lines.filter(neighbours.isNotNull()).select(names.alias("id")).distinct()


def adjacency_rejects(lines: DataFrame, column: str = "value") -> DataFrame:
    """Lines, and those without a tab or a readable list of neighbours, as one row."""
    _, neighbours = _adjacency(column)
    return lines.agg(F.count(F.lit(1)).alias("lines"),
                     F.count_if(neighbours.isNull()).alias("rejected"))


def edges_from_links(pages: DataFrame, page: str, markup: str) -> DataFrame:
    """Edges from the links inside a markup column; repeats of a link add up to its weight."""
    targets = F.regexp_extract_all(F.col(markup), F.lit('href="([^"]*)"'), F.lit(1))
    return weighted_edges(pages.select(F.col(page).alias("src"), F.explode(targets).alias("dst")))


def weighted_edges(edges: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Merge parallel edges; the weight is their summed weight, or their number."""
    weight = F.sum("weight") if "weight" in edges.columns else F.count(F.lit(1))
    return edges.groupBy(*by, "src", "dst").agg(weight.alias("weight"))


def vertices_of(edges: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Distinct ends of the edges."""
    ends = F.explode(F.array("src", "dst")).alias("id")
    return edges.select(*by, ends).distinct()


def out_degrees(edges: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Number of neighbours and summed weight of every source."""
    return edges.groupBy(*by, F.col("src").alias("id")).agg(
        F.count(F.lit(1)).alias("out_degree"), F.sum("weight").alias("out_weight")
    )


def degree_summary(edges: DataFrame) -> DataFrame:
    """Sources, total and mean weighted out-degree as one row."""
    return out_degrees(edges).agg(
        F.count(F.lit(1)).alias("sources"),
        F.sum("out_weight").alias("total_degree"),
        F.avg("out_weight").alias("mean_degree"),
    )


def dangling_vertices(edges: DataFrame, vertices: DataFrame | None = None) -> DataFrame:
    """Vertices without an out-edge."""
    vertices = vertices_of(edges) if vertices is None else vertices
    return vertices.join(edges.select(F.col("src").alias("id")).distinct(), "id", "left_anti")


def vertex_counts(edges: DataFrame) -> DataFrame:
    """Vertices, and how many of them dangle, as one row."""
    role = edges.select(F.explode(F.array(
        F.struct(F.col("src").alias("id"), F.lit(1).alias("is_source")),
        F.struct(F.col("dst").alias("id"), F.lit(0).alias("is_source")),
    )).alias("end")).select("end.*")
    per_vertex = role.groupBy("id").agg(F.max("is_source").alias("is_source"))
    return per_vertex.agg(
        F.count(F.lit(1)).alias("vertices"), F.count_if(F.col("is_source") == 0).alias("dangling")
    ).withColumn("dangling_share", F.try_divide("dangling", "vertices"))


def _sliced(edges: DataFrame, degrees: DataFrame, per_slice: int, by: tuple[str, ...] = ()):
    """Give every edge of a source with very many edges a slice number, from its destination.

    At most edges / ``per_slice`` sources have more than one slice, so their table is small
    enough to broadcast.
    """
    parts = F.ceil(F.col("out_degree") / F.lit(per_slice)).alias("_parts")
    large = degrees.filter(F.col("out_degree") > per_slice).select(
        *by, F.col("id").alias("src"), parts
    )
    slices = F.coalesce("_parts", F.lit(1))
    return edges.join(F.broadcast(large), [*by, "src"], "left").withColumn(
        "_slice", F.pmod(F.xxhash64("dst"), slices)
    ).drop("_parts")


def adjacency_lists(edges: DataFrame, list_size: int = LIST_SIZE) -> DataFrame:
    """Sorted neighbour lists: ``src, block, neighbours``.

    Block b holds the neighbours from place b * ``list_size`` on in the order of the source, so
    the blocks of a source one after the other are its list, at any number of neighbours, and no
    row and no task has to hold more than a block. The places come from one distributed sort.
    """
    numbered = stage(number_rows(edges.select("src", "dst").distinct(), ["src", "dst"], "_row"))
    starts = stage(numbered.groupBy("src").agg(F.min("_row").alias("_first")))
    placed = numbered.join(broadcast_if_small(starts), "src")
    block = F.floor((F.col("_row") - F.col("_first")) / F.lit(list_size))
    return placed.groupBy("src", block.alias("block")).agg(
        F.sort_array(F.collect_list("dst")).alias("neighbours")
    )


def adjacency_matrix(edges: DataFrame, vertices: DataFrame) -> DataFrame:
    """The matrix in coordinate form, for a graph of any size: ``src, dst, weight`` where not 0.

    A vertex with an empty row has one line with null ``dst`` and ``weight``.
    """
    rows = vertices.select(F.col("id").alias("src")).distinct()
    return rows.join(weighted_edges(edges), "src", "left").select("src", "dst", "weight")


def transition_probabilities(
    edges: DataFrame, edges_per_slice: int = EDGES_PER_SLICE,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Edge weight over the weight of all edges of its source; dangling vertices have no row.

    An edge with a null end is no edge, here as in the ranks, and counts in no total.

    The source totals are aggregated and joined back: a window would gather a source with very
    many edges in one task. Too many totals to broadcast meet the edges slice by slice.
    """
    stored = cut(edges.dropna(subset=["src", "dst"]))
    totals = cut(out_degrees(stored))
    if totals.count() <= broadcast_rows:
        known = totals.select(F.col("id").alias("src"), "out_weight")
        met = stored.join(F.broadcast(known), "src")
    else:
        parts = F.ceil(F.col("out_degree") / F.lit(edges_per_slice))
        known = totals.select(
            F.col("id").alias("src"), "out_weight",
            F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)).alias("_slice"),
        )
        met = _sliced(stored, totals, edges_per_slice).join(known, ["src", "_slice"])
    return met.select("src", "dst", (F.col("weight") / F.col("out_weight")).alias("probability"))


def _lay_out(edges: DataFrame, degrees: DataFrame, per_slice: int, by: tuple[str, ...] = ()):
    """Store the edges partitioned by source and slice, so that no later join moves them."""
    return cut_by(_sliced(edges, degrees, per_slice, by), *by, "src", "_slice")


def _send(edges: DataFrame, senders: DataFrame, by: tuple[str, ...], small: bool) -> DataFrame:
    """What every destination receives: the sender's ``_unit`` times the edge weight.

    ``senders`` has the columns ``(*by, src, _unit, parts)``. A small table is broadcast;
    otherwise a row goes to every slice of its source, where the stored edges lie already.
    """
    if small:
        met = edges.join(F.broadcast(senders.drop("parts")), [*by, "src"])
    else:
        slices = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("_slice")
        met = edges.join(senders.select(*by, "src", "_unit", slices), [*by, "src", "_slice"])
    return met.select(
        *by, F.col("dst").alias("id"), (F.col("_unit") * F.col("weight")).alias("_in")
    )


def _all_text(df: DataFrame, *columns: str) -> bool:
    return all(df.schema[c].dataType.simpleString() == "string" for c in columns)


def _lists(
    edges: DataFrame, degrees: DataFrame, per_list: int, by: tuple[str, ...], hashed: bool
) -> DataFrame:
    """The edges as lists ``(*by, src, _slice, to, weights)``, stored by source and slice."""
    ends = [(F.xxhash64(c) if hashed else F.col(c)).alias(c) for c in ("src", "dst")]
    rows = _sliced(edges, degrees, per_list, by).select(*by, *ends, "_slice", "weight")
    lists = rows.groupBy(*by, "src", "_slice").agg(
        F.collect_list(F.struct("dst", "weight")).alias("_ends"))
    return cut_by(
        lists.select(*by, "src", "_slice", F.col("_ends.dst").alias("to"),
                     F.col("_ends.weight").alias("weights")),
        *by, "src", "_slice")


def _send_lists(lists: DataFrame, senders: DataFrame, by: tuple[str, ...], _) -> DataFrame:
    """What ``_send`` gives, from lists of edges."""
    slices = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("_slice")
    met = lists.join(senders.select(*by, "src", "_unit", slices), [*by, "src", "_slice"])
    return met.select(*by, "_unit", "weights", F.posexplode("to").alias("_at", "id")).select(
        *by, "id", (F.col("_unit") * F.get("weights", F.col("_at"))).alias("_in"))


def pagerank(
    edges: DataFrame, vertices: DataFrame | None = None, *, by: tuple[str, ...] = (),
    alpha: float = 0.15, iterations: int = 10, scale: str = "probability",
    rescale: bool = False, tolerance: float | None = None,
    edges_per_slice: int = EDGES_PER_SLICE, broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Weighted PageRank; one row ``(*by, id, rank)`` per vertex.

    ``scale="probability"``: the ranks of a graph sum to 1 and the mass of dangling vertices is
    shared among all. ``scale="count"``: ranks start at 1, dangling mass is lost, and ``rescale``
    brings the sum back to the number of vertices. ``tolerance`` stops early once no graph's ranks
    moved by more than that in total. Edges with a null end are left out.

    Edges are merged, laid out by source once and kept, as lists of destinations and weights, so that
    an iteration joins a row per source and not per edge. A source with more than ``edges_per_slice``
    edges has several lists, and its rank is sent to each. Up to ``broadcast_rows`` vertices (counted)
    the ranks are broadcast to the edges instead. Beyond, names are stood for by hashes, if these are
    counted to be as many. The state is checkpointed in every iteration, so that a lost executor
    costs one iteration at most.
    """
    by = tuple(by)
    merged = stage(weighted_edges(complete_rows(edges, [*by, "src", "dst"]), by))
    degrees = cut(out_degrees(merged, by))
    known = degrees.select(*by, "id").unionByName(merged.select(*by, F.col("dst").alias("id")))
    if vertices is not None:
        known = known.unionByName(vertices.select(*by, "id"))
    per_list = min(edges_per_slice, LIST_SIZE)
    start = F.lit(1.0)
    state = cut(
        known.distinct().join(degrees, [*by, "id"], "left").select(
            *by, "id", start.alias("rank"), F.lit(0.0).alias("moved"),
            F.coalesce("out_weight", F.lit(0)).alias("out_weight"),
            F.ceil(F.coalesce("out_degree", F.lit(0)) / F.lit(per_list)).alias("parts"),
        )
    )
    n_vertices = state.count()
    small = n_vertices <= broadcast_rows
    hashed = not small and _all_text(merged, "src", "dst") and _all_text(state, "id") and (
        state.select(*by, F.xxhash64("id")).distinct().count() == n_vertices)
    state = state.withColumn("_key", F.xxhash64("id") if hashed else F.col("id"))
    laid_out = merged if small else _lists(merged, degrees, per_list, by, hashed)
    if by:
        sizes = cut(state.groupBy(*by).agg(F.count(F.lit(1)).alias("n_vertices")))
        few_graphs = sizes.count() <= broadcast_rows

    def with_size(rows: DataFrame) -> DataFrame:
        if not by:
            return rows.withColumn("n_vertices", F.lit(max(n_vertices, 1)))
        return rows.join(F.broadcast(sizes) if few_graphs else sizes, list(by))

    def with_fact(rows: DataFrame, fact: DataFrame) -> DataFrame:
        if not by:
            return attach_scalars(rows, fact)
        return rows.join(F.broadcast(fact) if few_graphs else fact, list(by))

    if scale == "probability":
        state = with_size(state).withColumn("rank", 1.0 / F.col("n_vertices")).drop("n_vertices")
    dangling = F.sum(F.when(F.col("out_weight") == 0, F.col("rank")).otherwise(0.0))
    kept = [*by, "id", "_key", "out_weight", "parts"]
    for step in range(iterations):
        senders = state.filter("out_weight > 0").select(
            *by, F.col("_key").alias("src"), (F.col("rank") / F.col("out_weight")).alias("_unit"),
            "parts",
        )
        sent = (_send if small else _send_lists)(laid_out, senders, by, small)
        received = sent.groupBy(*by, F.col("id").alias("_key")).agg(F.sum("_in").alias("_in"))
        sums = state.select(*kept, F.col("rank").alias("_old")).join(
            received, [*by, "_key"], "left").fillna(0.0, subset=["_in"])
        if scale == "probability":
            lost = state.groupBy(*by).agg(dangling.alias("_lost"))
            sums = with_size(with_fact(sums, lost))
            rank = alpha / F.col("n_vertices") + (1 - alpha) * (
                F.col("_lost") / F.col("n_vertices") + F.col("_in")
            )
        else:
            rank = alpha + (1 - alpha) * F.col("_in")
        state = sums.select(
            *kept, rank.alias("rank"), F.abs(rank - F.col("_old")).alias("moved")
        )
        if step + 1 < iterations or tolerance is not None:
            state = cut(state)
        if tolerance is not None:
            widest = state.groupBy(*by).agg(F.sum("moved").alias("m")).agg(F.max("m")).first()[0]
            if widest is not None and widest <= tolerance:
                break
    if rescale:
        state = cut(state)
        totals = state.groupBy(*by).agg(F.sum("rank").alias("_sum"))
        state = with_size(with_fact(state, totals)).withColumn(
            "rank", F.col("rank") * F.col("n_vertices") / F.col("_sum")
        )
    return state.select(*by, "id", "rank")


def total_mass(ranks: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    return ranks.groupBy(*by).agg(
        F.sum("rank").alias("mass"), F.count(F.lit(1)).alias("vertices")
    )


def power_iteration(
    probabilities: DataFrame, start: DataFrame, steps: int, squaring: bool = False,
    edges_per_slice: int = EDGES_PER_SLICE, broadcast_rows: int = BROADCAST_ROWS,
    cut_every: int = 8, side: int = blocks.SIDE, block_products: int = blocks.PRODUCTS,
) -> DataFrame:
    """Multiply the row vector ``start(id, mass)`` with the transition matrix, ``steps`` times.

    ``squaring`` gives the state after ``steps`` steps that square the matrix each time. Step i
    then multiplies by the matrix to the power 2^i, so the whole run is worth 2^steps - 1 plain
    multiplications. The matrix is squared in blocks as long as that takes at most
    ``block_products`` products of blocks, and beyond that the vector is multiplied more often.
    """
    if squaring:
        edges = cut(probabilities.select("src", "dst", F.col("probability").alias("weight")))
        return blocks.squaring_steps(
            edges, vertices_of(edges), start, steps, side, block_products)
    matrix = cut(probabilities.withColumnRenamed("probability", "weight"))
    everyone = cut(vertices_of(matrix))
    small = everyone.count() <= broadcast_rows
    degrees = out_degrees(matrix)
    slices = degrees.select(
        F.col("id").alias("src"),
        F.ceil(F.col("out_degree") / F.lit(edges_per_slice)).alias("parts"),
    )
    if not small:
        matrix = _lay_out(matrix, degrees, edges_per_slice)
    vector = start.select("id", "mass")
    for step in range(1, steps + 1):
        sent = vector.select(F.col("id").alias("src"), F.col("mass").alias("_unit"))
        senders = sent.withColumn("parts", F.lit(1)) if small else sent.join(slices, "src")
        vector = _send(matrix, senders, (), small).groupBy("id").agg(F.sum("_in").alias("mass"))
        if step % cut_every == 0:
            vector = cut(vector)
    return everyone.join(vector, "id", "left").select(
        "id", F.coalesce("mass", F.lit(0.0)).alias("mass")
    )


def chunk_edges(
    df: DataFrame, chunk: Column, origin: str, dest: str, features: list[Column]
) -> DataFrame:
    """One row per chunk, origin and destination, with the mean of every feature."""
    rows = df.select(
        chunk.alias("chunk"), F.col(origin).alias("origin"), F.col(dest).alias("dest"),
        *[f.cast("double").alias(f"f{i}") for i, f in enumerate(features)],
    )
    return rows.groupBy("chunk", "origin", "dest").agg(
        *[F.avg(f"f{i}").alias(f"f{i}") for i in range(len(features))]
    )


def vector_features(vector: Column, first: int, count: int, extra: list[Column]) -> Column:
    """A slice of a feature array with more values appended."""
    return F.concat(F.slice(vector, first + 1, count), F.array(*extra))


def coordinates(edge_rows: DataFrame, features: list[str]) -> DataFrame:
    """Coordinate form of the chunk tensors: one row per chunk, origin, dest and feature."""
    values = F.posexplode(F.array(*[F.col(f) for f in features])).alias("feature", "value")
    return edge_rows.select("chunk", "origin", "dest", values)


def chunk_targets(edge_rows: DataFrame, feature: str, n_vertices: DataFrame) -> DataFrame:
    """Per chunk and origin, the sum of a feature over destinations over the number of vertices.

    ``n_vertices`` is a one-row table with the column ``n_vertices``.
    """
    sums = edge_rows.groupBy("chunk", "origin").agg(F.sum(feature).alias("total"))
    return attach_scalars(sums, n_vertices).select(
        "chunk", "origin", (F.col("total") / F.col("n_vertices")).alias("target")
    )


def next_chunk_pairs(edge_rows: DataFrame, targets: DataFrame) -> DataFrame:
    """Edges of a chunk next to the targets of the following chunk, per origin.

    Origins without a target in the following chunk are 0; chunks without a successor drop out.
    """
    later = targets.select((F.col("chunk") - 1).alias("chunk"), "origin", "target")
    chunks = cut(later.select("chunk").distinct())
    followed = edge_rows.join(broadcast_if_small(chunks), "chunk", "left_semi")
    return followed.join(later, ["chunk", "origin"], "left").fillna(0.0, subset=["target"])


def chunk_sparsity(edge_rows: DataFrame, targets: DataFrame, features: list[str]) -> DataFrame:
    """Mean number of non-zero cells and of non-zero targets per chunk."""
    filled = F.greatest(*[(F.col(f) != 0).cast("int") for f in features])
    cells = edge_rows.groupBy("chunk").agg(F.sum(filled).alias("cells"))
    ends = targets.groupBy("chunk").agg(F.count_if(F.col("target") != 0).alias("ends"))
    return cells.join(ends, "chunk", "left").agg(
        F.avg("cells").alias("mean_cells"),
        F.avg(F.coalesce("ends", F.lit(0))).alias("mean_targets"),
    )
