"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmetrics.runtime import Scratch


def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, component) for each end of an edge (u, v); component is the smallest node.

    Every round merges each node into its neighbour (or itself) of least hash
    and carries the edges over to what is left, so long chains shrink by a
    constant share as well. A node with very many edges takes part by minima,
    which tasks find in parts. Edges and parents of each round are tables; the
    driver learns only whether edges are left.
    """
    ends = scratch.write(edges.select("u", "v").where("u <> v").distinct(), f"{name}_edges_0")
    nodes = ends.select(F.col("u").alias("node")).union(ends.select("v")).distinct()
    labels = nodes.withColumn("root", F.col("node"))
    number = 0
    while not ends.isEmpty():
        both = ends.union(ends.select("v", "u"))
        order = F.struct(F.xxhash64("v").alias("h"), F.col("v").alias("node"))
        own = F.struct(F.xxhash64("u").alias("h"), F.col("u").alias("node"))
        parents = scratch.write(
            both.groupBy("u")
            .agg(F.min(order).alias("least"))
            .select(F.col("u").alias("child"), F.least("least", own)["node"].alias("parent")),
            f"{name}_parents_{number}",
        )
        moved = (
            ends.join(parents.withColumnsRenamed({"child": "u", "parent": "pu"}), "u")
            .join(parents.withColumnsRenamed({"child": "v", "parent": "pv"}), "v")
            .where("pu <> pv")
            .select(F.least("pu", "pv").alias("u"), F.greatest("pu", "pv").alias("v"))
            .distinct()
        )
        ends = scratch.write(moved, f"{name}_edges_{number + 1}")
        scratch.drop(f"{name}_edges_{number}") if number else None
        labels = labels.join(parents, labels["root"] == parents["child"], "left").select(
            "node", F.coalesce("parent", "root").alias("root")
        )
        number += 1
    roots = scratch.write(labels, f"{name}_roots")
    least = roots.groupBy("root").agg(F.min("node").alias("component"))
    return roots.join(least, "root").select("node", "component")
