"""Connected components of a graph given by its edges, as DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.session import materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for each node of ``edges`` (a, b); a component has
    the id of its smallest node.  Self-loops only name a node.

    Contraction: each round sends every node to the smallest of itself and its
    neighbours, smallest by a hash that changes each round, so that long chains
    shrink by a constant share too, and goes on with the edges between the
    nodes that are left.  All tables are stored in the shared folder; a node
    with very many edges is summed up map-side, and the joins are between
    stored tables, which Spark can split at a hot node.
    """
    e = materialize(edges.select(F.col("a"), F.col("b")).distinct(), "edges")
    nodes = materialize(e.select(F.col("a").alias("node")).union(e.select("b")).distinct()
                        .select("node", F.col("node").alias("root")), "nodes")
    e = e.filter("a <> b")
    turn = 0
    while not e.isEmpty():
        turn += 1
        rank = lambda c, k=turn: F.struct(F.xxhash64(c, F.lit(k)).alias("h"), F.col(c).alias("id"))
        both = e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        to = materialize(both.groupBy("a").agg(F.min(rank("b")).alias("m")).select(
            F.col("a").alias("of"), F.least("m", rank("a"))["id"].alias("to")), "contraction")
        nodes = materialize(nodes.join(to, nodes.root == to.of, "left").select(
            "node", F.coalesce("to", "root").alias("root")), "nodes")
        half = e.join(to, e.a == to.of).select(F.col("to").alias("a"), "b")
        e = materialize(half.join(to, half.b == to.of).select("a", F.col("to").alias("b"))
                        .filter("a <> b").distinct(), "edges")
    names = materialize(nodes.groupBy("root").agg(F.min("node").alias("component")), "names")
    return nodes.join(names, "root").select("node", "component")
