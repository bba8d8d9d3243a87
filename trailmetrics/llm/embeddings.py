"""Near-duplicate embeddings by neighbour graphs that are refined step by step.

A few random-projection trees give each vector some first neighbours. Then, round
by round, neighbours of a vector are introduced to each other (NN-descent) until
the lists hardly change. Vectors that are linked through their lists form
candidate groups. A vector whose whole list is links may have more, also to other
groups, so it gets a list of its nearest vectors outside its group, until no such
list links two groups. In the groups, all links are counted exactly, in blocks. A
sample of vectors is compared with all others, and as long as links are missing
there, lists grow and the rounds go on.

Two departures from plain NN-descent: full lists are not made longer one by one
(a second graph of neighbours outside the group does that work, as a list of any
length may be full of a group's own members), and links are not the graph's edges
but all pairs of a group that an exact comparison confirms. If no audited vector
has a link, nothing is measured, and the audit passes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trailmetrics.llm.graph import components
from trailmetrics.runtime import Scratch

_BITS = 16
# Single precision finds candidates; they are judged in double precision.
_SLACK = 1e-4
# Audited vectors that are sent to the tasks at once.
_BLOCK_BYTES = 2**25


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, kind, unit) of the vectors that can be linked, at length one.

    Vectors of different labels or numbers of components are of different kinds.
    """
    values = F.col("embedding").cast("array<double>")
    finite = F.forall(
        "given", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    largest = F.array_max(F.transform("given", F.abs))
    norm = F.sqrt(F.aggregate("scaled", F.lit(0.0), lambda total, x: total + x * x))
    return (
        vectors.select("vec_id", "label", values.alias("given"))
        .where("vec_id IS NOT NULL AND label IS NOT NULL AND size(given) > 0")
        .where(finite)
        .withColumn("largest", largest)
        .where("largest > 0")
        .withColumn("scaled", F.transform("given", lambda x: x / F.col("largest")))
        .withColumn("norm", norm)
        .select(
            F.col("vec_id").cast("long"),
            F.concat_ws(":", F.col("label").cast("string"), F.size("scaled")).alias("kind"),
            F.transform("scaled", lambda x: x / F.col("norm")).alias("unit"),
        )
    )


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


_CODED = pa.schema(
    [("node", pa.int64()), ("kind", pa.string()), ("tree", pa.int32()), ("code", pa.int32())]
)


def _codes(trees: int):
    """On which side of random planes each vector lies, as the bits of a number."""

    def run(batches):
        for batch in batches:
            kinds = np.array(batch.column("kind").to_pylist(), object)
            nodes = batch.column("node").to_numpy()
            sizes = np.diff(batch.column("vector").offsets.to_numpy())
            for size in np.unique(sizes):
                rows = np.flatnonzero(sizes == size)
                matrix = _matrix(batch.column("vector").take(pa.array(rows)))
                for tree in range(trees):
                    planes = np.random.default_rng([tree, size]).standard_normal((size, _BITS))
                    code = (matrix @ planes > 0) @ (1 << np.arange(_BITS))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(nodes[rows]),
                            pa.array(kinds[rows], pa.string()),
                            pa.array(np.full(len(rows), tree), pa.int32()),
                            pa.array(code, pa.int32()),
                        ],
                        schema=_CODED,
                    )

    return run


_EDGE = pa.schema([("v", pa.int64()), ("u", pa.int64()), ("sim", pa.float32())])
_EDGE_TYPES = "v long, u long, sim float"


def _edges(v: np.ndarray, u: np.ndarray, sim: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(v, pa.int64()), pa.array(u, pa.int64()), pa.array(sim, pa.float32())],
        schema=_EDGE,
    )


def _nearest(size: int):
    """The nearest `size` vectors of each vector of a block, without those of its own group."""

    def group(table: pa.Table) -> pa.Table:
        nodes, matrix = table["node"].to_numpy(), _matrix(table["vector"])
        own = table["own"].to_numpy()
        sims = matrix @ matrix.T
        sims[own[:, None] == own[None, :]] = -2
        most = min(size, len(nodes) - 1)
        if most < 1:
            return _EDGE.empty_table()
        near = np.argpartition(-sims, most - 1, axis=1)[:, :most]
        rows = np.repeat(np.arange(len(nodes)), most)
        found = _edges(nodes[rows], nodes[near.ravel()], sims[rows, near.ravel()])
        return pa.Table.from_batches([found]).filter(pc.greater(found["sim"], -1.5))

    return group


def _first_graph(nodes: DataFrame, scratch: Scratch, trees: int, block: int, size: int) -> DataFrame:
    """First neighbours, from blocks of vectors that fall into the same cell of a tree.

    A cell that holds more than `block` vectors is dealt into blocks by hash.
    """
    codes = scratch.write(
        nodes.select("node", "kind", "vector").mapInArrow(
            _codes(trees), "node long, kind string, tree int, code int"
        ),
        "codes",
    )
    kinds = codes.where("tree = 0").groupBy("kind").agg(F.count("*").alias("n"))
    bits = F.least(F.greatest(F.ceil(F.log2(F.col("n") / block)), F.lit(0)), F.lit(_BITS))
    celled = codes.join(kinds, "kind").withColumn(
        "cell", F.col("code") % F.pow(F.lit(2), bits).cast("int")
    )
    cells = celled.groupBy("kind", "tree", "cell").agg(F.count("*").alias("held"))
    part = F.pmod(F.xxhash64("node", "tree"), F.ceil(F.col("held") / block))
    placed = celled.join(cells, ["kind", "tree", "cell"]).select(
        "node", "kind", "tree", "cell", part.alias("part")
    )
    return (
        nodes.select("node", "own", "vector")
        .join(placed, "node")
        .groupBy("kind", "tree", "cell", "part")
        .applyInArrow(_nearest(size), _EDGE_TYPES)
    )


def _introduce():
    """Pairs among the members of a list that improve the list of the first of them."""

    def improved(nodes, own, matrix, new, worst) -> pa.RecordBatch:
        sims = matrix @ matrix.T
        better = (sims > worst[:, None]) & (new[:, None] | new[None, :])
        better &= own[:, None] != own[None, :]
        v, u = np.nonzero(better)
        return _edges(nodes[v], nodes[u], sims[v, u])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table])
            via = table["via"].to_numpy()
            # The last list may go on in the next batch.
            whole = int(np.searchsorted(via, via[-1])) if len(via) else 0
            held = table.slice(whole)
            yield from each(table.slice(0, whole))
        if held is not None:
            yield from each(held)

    def each(table: pa.Table) -> Iterator[pa.RecordBatch]:
        if not table.num_rows:
            return
        via, nodes = table["via"].to_numpy(), table["node"].to_numpy()
        own = table["own"].to_numpy()
        new, worst = table["new"].to_numpy(), table["worst"].to_numpy()
        lists = table["vector"].combine_chunks()
        ends = np.flatnonzero(np.diff(via)) + 1
        for start, end in zip([0, *ends], [*ends, len(via)]):
            part = slice(start, end)
            if end - start > 1 and new[part].any():
                matrix = _matrix(lists.slice(start, end - start))
                found = improved(nodes[part], own[part], matrix, new[part], worst[part])
                if found.num_rows:
                    yield found

    return run


def _best(edges: DataFrame, size: int) -> DataFrame:
    """The `size` nearest of each list; an edge found twice keeps its first round."""
    order = Window.partitionBy("v").orderBy(F.desc("sim"), "u")
    return (
        edges.groupBy("v", "u")
        .agg(F.max("sim").alias("sim"), F.min("round").alias("round"))
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= size)
        .drop("rank")
    )


def _refine(
    nodes: DataFrame,
    graph: DataFrame,
    scratch: Scratch,
    name: str,
    size: int,
    rounds: int,
    inside: DataFrame | None = None,
) -> DataFrame:
    """Rounds of introductions until less than one list entry in a thousand changes.

    The lists `inside` the groups of `nodes` take part in introductions and stay as they are.
    """
    vectors = nodes.select("node", "own", "vector")
    order = Window.partitionBy("via").orderBy(F.xxhash64("via", "node"))
    for number in range(1, rounds + 1):
        new = F.col("round") == number - 1
        worst = graph.groupBy("v").agg(
            F.when(F.count("*") >= size, F.min("sim")).otherwise(F.lit(-1.5)).alias("worst")
        )
        forward = graph.select(F.col("v").alias("via"), F.col("u").alias("node"), new.alias("new"))
        # Each list is read both ways; of those that hold a vector, as many as a
        # list has, in an order by hash, are introduced in one round.
        back = (
            graph.select(F.col("u").alias("via"), F.col("v").alias("node"), new.alias("new"))
            .withColumn("rank", F.row_number().over(order))
            .where(F.col("rank") <= size)
            .drop("rank")
        )
        own = graph.select("v").distinct().select(
            F.col("v").alias("via"), F.col("v").alias("node"), F.lit(False).alias("new")
        )
        if inside is not None:
            own = own.unionByName(
                inside.select(F.col("v").alias("via"), F.col("u").alias("node"), F.lit(False).alias("new"))
            )
        members = (
            forward.unionByName(back)
            .unionByName(own)
            .groupBy("via", "node")
            .agg(F.max("new").alias("new"))
        )
        found = (
            members.join(vectors, "node")
            .join(worst.withColumnRenamed("v", "node"), "node", "left")
            .select("via", "node", "own", "new", F.coalesce("worst", F.lit(-1.5)).alias("worst"), "vector")
            .repartition("via")
            .sortWithinPartitions("via")
            .mapInArrow(_introduce(), _EDGE_TYPES)
            .withColumn("round", F.lit(number))
        )
        old = graph
        graph = scratch.write(_best(old.unionByName(found), size), f"{name}_{number}")
        if number > 1:
            scratch.drop(f"{name}_{number - 1}")
        if graph.where(F.col("round") == number).count() * 1000 < graph.count():
            break
    return graph


def _saturated(graph: DataFrame, size: int, least: float) -> DataFrame:
    """The vectors whose lists are full of links, so that they may have more."""
    return (
        graph.groupBy("v")
        .agg(F.count("*").alias("held"), F.min("sim").alias("farthest"))
        .where((F.col("held") >= size) & (F.col("farthest") >= least))
        .select(F.col("v").alias("node"))
    )


def _linked_groups(
    nodes: DataFrame,
    graph: DataFrame,
    scratch: Scratch,
    name: str,
    size: int,
    rounds: int,
    trees: int,
    block: int,
    least: float,
) -> DataFrame:
    """(node, cluster) of the vectors with links: groups that no list links any more.

    A link between two groups that no list holds has two ends with full lists.
    These get lists of the nearest vectors outside their groups; groups that such
    a list links become one, and vectors whose outside lists are full of links
    are asked again. Every pass but the last merges groups.
    """
    near = graph.where(F.col("sim") >= least).select("v", "u")
    crowded = scratch.write(_saturated(graph, size, least), f"{name}_crowded")
    number = 0
    while True:
        groups = scratch.write(
            components(near, scratch, f"{name}_near_{number}").withColumnRenamed("component", "cluster"),
            f"{name}_groups_{number}",
        )
        asked = scratch.write(
            nodes.drop("own").join(crowded, "node").join(groups.withColumnRenamed("cluster", "own"), "node"),
            f"{name}_asked_{number}",
        )
        first = scratch.write(
            _best(_first_graph(asked, scratch, trees, block, size).withColumn("round", F.lit(0)), size),
            f"{name}_outside_{number}",
        )
        if first.isEmpty():
            return groups
        outside = first
        # Up to a block of a kind, all its vectors have met already.
        if not asked.groupBy("kind").count().where(F.col("count") > block).isEmpty():
            inside = near.join(crowded.withColumnRenamed("node", "v"), "v", "left_semi")
            outside = _refine(asked, first, scratch, f"{name}_outside_{number}", size, rounds, inside)
        across = outside.where(F.col("sim") >= least).select("v", "u")
        if across.isEmpty():
            return groups
        near = scratch.write(near.unionByName(across), f"{name}_links_{number}")
        crowded = scratch.write(_saturated(outside, size, least), f"{name}_crowded_{number}")
        number += 1


_COUNTED = pa.schema([("u", pa.int64()), ("v", pa.int64()), ("links", pa.int64())])


def spanning(linked: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect all that a matrix of links connects."""
    found, left = [], np.arange(len(linked))
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            at = queue.pop()
            near = left[linked[at, left]]
            found += [(at, other) for other in near]
            queue += list(near)
            left = left[~linked[at, left]]
    return found


def _count_links(threshold: float):
    """Links of each vector of a block's first side with those of its second side.

    Rows with a `v` are links that connect the block, rows without are counts.
    """

    def group(table: pa.Table) -> pa.Table:
        rows: list[tuple[int, int | None, int]] = []
        groups = table["cluster"].to_numpy()
        for cluster in np.unique(groups):
            part = table.filter(pa.array(groups == cluster))
            nodes, copies = part["node"].to_numpy(), part["copies"].to_numpy()
            side, matrix = part["side"].to_numpy(), _matrix(part["unit"])
            linked = matrix @ matrix.T >= threshold
            linked &= nodes[:, None] != nodes[None, :]
            # Sides 0 and 1 meet each other; side 2 meets itself.
            linked &= (side[:, None] != side[None, :]) | (side[:, None] == 2)
            counts = linked @ copies
            rows += [(int(n), None, int(c)) for n, c in zip(nodes, counts) if c]
            rows += [(int(nodes[a]), int(nodes[b]), 0) for a, b in spanning(linked)]
        columns = zip(*rows) if rows else ([], [], [])
        return pa.table([pa.array(c, pa.int64()) for c in columns], schema=_COUNTED)

    return group


def _confirmed(
    nodes: DataFrame, groups: DataFrame, scratch: Scratch, name: str, block: int, threshold: float
) -> DataFrame:
    """Links and link counts within each group of candidates, by blocks.

    A group of more than `block` vectors is dealt into blocks; each pair of
    blocks meets in one task, which returns counts and a few links, not pairs.
    """
    sizes = groups.groupBy("cluster").agg(F.ceil(F.count("*") / block).alias("blocks"))
    total = groups.count()
    bins = max(1, 4 * total // block)
    placed = (
        groups.join(sizes, "cluster")
        .withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")))
        .withColumn(
            "place",
            F.when(F.col("blocks") > 1, F.col("cluster")).otherwise(
                -1 - F.pmod(F.xxhash64("cluster"), F.lit(bins))
            ),
        )
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "node",
            "cluster",
            "place",
            F.least("own", "other").alias("first"),
            F.greatest("own", "other").alias("second"),
            F.when(F.col("own") == F.col("other"), 2)
            .when(F.col("own") < F.col("other"), 0)
            .otherwise(1)
            .alias("side"),
        )
    )
    return scratch.write(
        nodes.select("node", "unit", "copies")
        .join(placed, "node")
        .groupBy("place", "first", "second")
        .applyInArrow(_count_links(threshold), "u long, v long, links long"),
        name,
    )


def _missed(sent, threshold: float):
    """Links of the audited vectors (all, and those to another group) in a task."""

    def run(batches):
        kinds, nodes, groups, units = sent.value
        for batch in batches:
            kind = np.array(batch.column("kind").to_pylist(), object)
            node = batch.column("node").to_numpy()
            group = batch.column("cluster").to_numpy()
            for one in np.unique(kind):
                mine, asked = np.flatnonzero(kind == one), np.flatnonzero(kinds == one)
                if not len(asked):
                    continue
                matrix = _matrix(batch.column("unit").take(pa.array(mine)))
                linked = np.stack([units[i] for i in asked]) @ matrix.T >= threshold
                linked &= nodes[asked][:, None] != node[mine][None, :]
                apart = linked & (groups[asked][:, None] != group[mine][None, :])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(linked.sum())]), pa.array([int(apart.sum())])],
                    names=["links", "missed"],
                )

    return run


def audit(
    nodes: DataFrame, groups: DataFrame, scratch: Scratch, sample: int, threshold: float
) -> tuple[int, int]:
    """Links of some vectors, found by comparing them with all, and those missed.

    These are every k-th vector of groups by hash, and every l-th of the others, so
    that there are `sample` of each or a few more, up to twice as many. They are
    written down in blocks of about `_BLOCK_BYTES`, and all vectors are compared
    with one block after another, so what is sent to the tasks has the same bound at
    any number of vectors.
    """
    grouped = nodes.join(groups, "node", "left").select(
        "node",
        "kind",
        "unit",
        F.coalesce("cluster", "node").alias("cluster"),
        F.col("cluster").isNotNull().alias("linked"),
    )
    counts = dict(grouped.groupBy("linked").count().collect())
    every = {linked: max(1, counts.get(linked, 0) // sample) for linked in (True, False)}
    chosen = F.pmod(
        F.xxhash64("node", F.lit(3)), F.when(F.col("linked"), every[True]).otherwise(every[False])
    )
    asked = scratch.write(grouped.where(chosen == 0), "asked")
    size = asked.agg(F.sum(8 * F.size("unit"))).first()[0] or 0
    blocks = -(-size // _BLOCK_BYTES)
    links = missed = 0
    for number in range(blocks):
        block = asked.where(F.pmod(F.xxhash64("node", F.lit(4)), F.lit(blocks)) == number).collect()
        if not block:
            continue
        sent = nodes.sparkSession.sparkContext.broadcast(
            (
                np.array([row["kind"] for row in block], object),
                np.array([row["node"] for row in block]),
                np.array([row["cluster"] for row in block]),
                [np.array(row["unit"]) for row in block],
            )
        )
        sums = (
            grouped.mapInArrow(_missed(sent, threshold), "links long, missed long")
            .agg(F.sum("links"), F.sum("missed"))
            .first()
        )
        links, missed = links + (sums[0] or 0), missed + (sums[1] or 0)
        sent.destroy()
    return links, missed


def near_duplicates(
    vectors: DataFrame,
    scratch: Scratch,
    threshold: float = 0.98,
    neighbours: int = 10,
    trees: int = 3,
    block: int = 1024,
    rounds: int = 6,
    audited: int = 256,
    recall: float = 0.999,
    attempts: int = 3,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row of `vectors`.

    Vectors are linked if their labels are equal and their cosine, in double
    precision, is at least `threshold`. Equal vectors are compared once; each of
    them counts as a link of the others. `audited` vectors of groups and as many
    others are compared with all, or the square root of their number if that is
    more: if less than `recall` of their links lie within the groups found, lists
    are doubled and the rounds go on. After `attempts` audits that fail, a
    RuntimeError is raised.

    A vector that is null, empty, zero, or holds null or non-finite components,
    or whose label is null, is linked with nothing; so is a null vec_id, which
    is kept. Rows that share a vec_id are one vector; if they differ, their links
    add up. Other columns are ignored; an empty table gives no rows.
    """
    units = scratch.write(usable(vectors), "units")
    named = units.withColumns({"h1": F.xxhash64("kind", "unit"), "h2": F.xxhash64(F.lit(1), "unit")})
    classes = scratch.write(
        named.groupBy("h1", "h2").agg(
            F.min("vec_id").alias("node"),
            F.count_distinct("vec_id").alias("copies"),
        ),
        "classes",
    )
    nodes = scratch.write(
        named.join(classes, ["h1", "h2"])
        .where("vec_id = node")
        .groupBy("node", "h1", "h2")
        .agg(
            F.first("kind").alias("kind"),
            F.first("unit").alias("unit"),
            F.first("copies").alias("copies"),
        )
        # At first, each vector is its own group.
        .withColumns({"vector": F.col("unit").cast("array<float>"), "own": F.col("node")}),
        "nodes",
    )
    size = neighbours
    asked = max(audited, math.isqrt(nodes.count()))
    first = _first_graph(nodes, scratch, trees, block, size).withColumn("round", F.lit(0))
    graph = scratch.write(_best(first, size), "graph_first")
    for attempt in range(attempts):
        graph = _refine(nodes, graph, scratch, f"graph_{attempt}", size, rounds)
        groups = _linked_groups(
            nodes, graph, scratch, f"linked_{attempt}", size, rounds, trees, block, threshold - _SLACK
        )
        links, missed = audit(nodes, groups, scratch, asked, threshold)
        if missed <= (1 - recall) * links:
            break
        size *= 2
        # All edges count as new for the longer lists.
        graph = scratch.write(graph.withColumn("round", F.lit(0)), f"graph_again_{attempt}")
    else:
        raise RuntimeError(f"{missed} of {links} links of the audited vectors lie outside the groups found")
    counted = _confirmed(nodes, groups, scratch, "counted", block, threshold)
    found = components(counted.where("v IS NOT NULL").select("u", "v"), scratch, "linked")
    degrees = counted.where("v IS NULL").groupBy(F.col("u").alias("node")).agg(
        F.sum("links").alias("links")
    )
    members = (
        named.select("vec_id", "h1", "h2")
        .distinct()
        .join(classes, ["h1", "h2"])
        .join(degrees, "node", "left")
        .join(found, "node", "left")
        .groupBy("vec_id")
        .agg(
            F.sum(F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.min(F.coalesce("component", "node")).alias("component"),
        )
    )
    component = F.coalesce("component", "vec_id")
    return (
        vectors.select(F.col("vec_id").cast("long"))
        .join(members, "vec_id", "left")
        .select(
            "vec_id",
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            component.alias("component_id"),
            F.col("vec_id").eqNullSafe(component).alias("kept"),
        )
    )
