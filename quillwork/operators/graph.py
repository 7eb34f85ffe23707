"""Bounded shortest paths over an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillwork.functions.nulls import present
from quillwork.functions.text import split_on_space
from quillwork.operators.sizing import join_measured, settle_measured
from quillwork.session import Scratch, new_path, settle_at


def edges_from_adjacency(lines: DataFrame, column: str = "value") -> DataFrame:
    """``node: n1 n2 ...`` lines to one ``(src, dst)`` row per edge."""
    halves = F.split(F.col(column), ":", 2)
    return (
        lines.select(
            F.trim(F.get(halves, F.lit(0))).alias("src"),
            F.explode(split_on_space(F.get(halves, F.lit(1)))).alias("dst"),
        )
        .filter("dst <> ''")
    )


def neighbours(links: DataFrame, node: str) -> DataFrame:
    """Edges that leave a node; of edges bucketed by ``src`` one bucket is read."""
    return links.filter(F.col("src") == F.lit(node).cast(links.schema["src"].dataType))


def between(links: DataFrame, least, most) -> DataFrame:
    """Edges that leave nodes of a range; of edges sorted by ``src`` the pages outside it are not read."""
    kind = links.schema["src"].dataType
    return links.filter(F.col("src").between(F.lit(least).cast(kind), F.lit(most).cast(kind)))


def shortest_paths(edges: DataFrame, source: str, max_hops: int = 6,
                   destination: str | None = None) -> DataFrame:
    """``(node, parent, distance)`` of every node within ``max_hops`` of ``source``.

    Among equally short ways the smallest parent is kept.  The edges are exchanged once, into buckets
    sorted by ``src``: the first round reads the source's bucket, a later one joins the nodes found in
    the round before, which alone are broadcast (when measured small) or shuffled, to the edges that
    leave nodes between the least and the greatest of them.  A round keeps one
    parent per new node with a map-side minimum and is written to a directory of its own,
    ``distance=...``, so plans stay small, a lost executor costs one round at most, and who asks for
    one distance reads one directory.  Stops when ``destination`` or nothing new was found.
    """
    spark = edges.sparkSession
    with Scratch(spark) as scratch:
        # Repeated edges stay: each round's map-side minimum absorbs them without a shuffle of their own.
        links = scratch.bucketed(
            edges.select("src", "dst").filter(present("src", "dst")), "edges", "src")
        kind = links.schema["dst"].dataType
        root = new_path(spark, "paths")
        named = T.StructType([T.StructField("node", kind), T.StructField("parent", kind),
                              T.StructField("distance", T.IntegerType())])

        def known() -> DataFrame:
            return spark.read.schema(named).parquet(root)

        settle_at(spark.range(1).select(F.lit(source).cast(kind).alias("node"),
                                        F.lit(None).cast(kind).alias("parent")), f"{root}/distance=0")
        size, span = (1, 0), {}
        for hop in range(1, max_hops + 1):
            frontier = known().filter(F.col("distance") == hop - 1).select(F.col("node").alias("src"))
            leaving = (neighbours(links, source) if hop == 1
                       else join_measured(between(links, **span), frontier, size, ["src"]))
            reached = leaving.groupBy(F.col("dst").alias("node")).agg(F.min("src").alias("parent"))
            seen = Observation()
            found = reached.join(known().select("node"), "node", "left_anti").observe(
                seen, F.min("node").alias("least"), F.max("node").alias("most"))
            fresh, size = settle_measured(found, f"{root}/distance={hop}")
            span = seen.get
            if size[0] == 0 or (destination is not None and not fresh.filter(
                    F.col("node") == F.lit(destination).cast(kind)).isEmpty()):
                break
        return known()


def by_iteration(paths: DataFrame) -> DataFrame:
    """The state after each round: round ``iter`` knows every node up to distance ``iter + 1``."""
    last = paths.agg(F.max("distance")).first()[0] or 0
    first_seen = F.greatest(F.col("distance") - 1, F.lit(0))
    seen_in = F.sequence(first_seen, F.lit(max(last - 1, 0)))
    return paths.withColumn("iter", F.explode(seen_in))


def route(paths: DataFrame, destination: str) -> DataFrame:
    """The nodes from the source to ``destination`` as ``(step, node)``, empty if not reached.

    Walks back from one row: a hop asks for one node at one distance, so it reads one round's directory
    and, there, the files that may hold the node.  The steps, one a hop, are known to the driver.
    """
    spark, kind = paths.sparkSession, paths.schema["node"].dataType

    def at(node, distance: int | None) -> DataFrame:
        here = paths.filter(F.col("node") == F.lit(node).cast(kind))
        return here if distance is None else here.filter(F.col("distance") == distance)

    steps, row = [], at(destination, None).first()
    while row:
        steps.append((row.distance, row.node))
        row = at(row.parent, row.distance - 1).first() if row.distance else None
    return spark.createDataFrame(steps, T.StructType(
        [T.StructField("step", T.IntegerType()), T.StructField("node", kind)]))
