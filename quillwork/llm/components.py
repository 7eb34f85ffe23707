"""Connected components of an undirected graph, by alternating large-star and small-star rounds.

Neighbourhoods are never gathered: a round takes the least neighbour of each node (combined in the
map tasks) and joins it back, in the map tasks where those are few, else by a shuffle whose oversized
partitions are split.  Every round is written to the shared folder and replaces the one before, in
files sized by the number of edges, which no round raises.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from quillwork.operators.sizing import in_few_files, join_measured, settle_measured
from quillwork.session import Scratch, settle_at


def with_state(edges: DataFrame, path: str) -> tuple[DataFrame, tuple]:
    """Settle edges and tell, from the same job, how many there are and the sum of their hashes."""
    seen = Observation()
    table = settle_at(edges.observe(
        seen, F.count("*").alias("rows"),
        F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("hashes")), path)
    return table, (seen.get["rows"], seen.get["hashes"])


def large_star(scratch: Scratch, edges: DataFrame, count: int) -> DataFrame:
    """Link every larger neighbour of a node to the least node of its neighbourhood."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least, size = scratch.settle(in_few_files(both.groupBy("a").agg(F.min("b").alias("m")).select(
        "a", F.least("a", "m").alias("m")), 2 * count), "large", settle_measured)
    return join_measured(both.filter("b > a"), least, size, ["a"]).select(
        F.col("b").alias("a"), F.col("m").alias("b"))


def small_star(scratch: Scratch, edges: DataFrame, count: int) -> DataFrame:
    """Link a node and its smaller neighbours to the least of them; ``a > b`` holds in edges."""
    least, size = scratch.settle(
        in_few_files(edges.groupBy("a").agg(F.min("b").alias("m")), count), "small", settle_measured)
    others = join_measured(edges, least, size, ["a"]).filter("b <> m").select(
        F.col("b").alias("a"), F.col("m").alias("b"))
    return others.union(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b", count: int | None = None) -> DataFrame:
    """``node, root`` for every node with an edge to another; the root is the component's least node.

    Edges with a null end, and loops, are left out.  Nodes may be of any type that can be ordered.
    ``count`` is the number of edges, or more, if the caller knows it.
    """
    scratch = Scratch(edges.sparkSession)
    linked = edges.select(F.col(a).alias("x"), F.col(b).alias("y")).filter("x <> y")
    first = linked.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct()
    now, seen = scratch.settle(
        first if count is None else in_few_files(first, count), "edges", with_state)
    before = None
    while seen != before and seen[0]:
        before = seen
        star = small_star(scratch, large_star(scratch, now, seen[0]), seen[0])
        now, seen = scratch.settle(in_few_files(star, seen[0]), "edges", with_state)
    scratch.close("edges")
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
