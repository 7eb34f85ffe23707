"""Near-duplicate vectors by an epsilon grid order join.

Vectors are scaled to length one, where a cosine bound is a distance bound epsilon.  Their leading
principal directions are taken from a covariance over all of them (one small sum per task).  Vectors
are sorted by the grid cells of those coordinates, a cell being a quarter of epsilon wide, and cut
into blocks of consecutive vectors with a bounding box.  Starting from the interval of all blocks,
pairs of intervals are split level by level, and pairs whose boxes are more than epsilon apart are
dropped with everything below them: projection never lengthens a distance, so nothing is lost.
Blocks that remain are compared as matrices in double precision, again skipping distant parts; each
comparison returns, per vector, a number of links and one local root, never its pairs.

Equal vectors are one class with a multiplicity, so a vector that a third of all rows have is one
row of one block.  Defined results: a null, empty or zero vector, or one with null, NaN or infinite
components, links with nothing and keeps itself; shorter vectors are filled up with zeros; a null id
is never the least of a component, and its row is kept only if it links with nothing; rows repeated
with their id count as separate vectors; an empty table gives an empty table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillwork.llm.arrow import Answer, map_rows
from quillwork.llm.components import components
from quillwork.session import settle

LEADING = 8          # principal directions that order and prune
COVARIED = 256       # coordinates that the principal directions are taken from, at most
BLOCK = 4096         # vectors in a block
PART = 512           # vectors of a block that are compared or skipped together
FAN_OUT = 8          # intervals an interval is split into
SLACK = 1e-9         # for rounding, on squared distances


def unit(vector) -> np.ndarray | None:
    """The vector at length one in double precision, or none if it can have no cosine."""
    if vector is None or not len(vector):
        return None
    v = np.array(vector, "f8")
    top = np.abs(v).max()
    if not np.isfinite(top) or top == 0:
        return None
    v /= top
    return v / math.sqrt(float(v @ v))


def read_vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """Per row: id, ``key`` (128 bits of the vector, null if it can have no cosine) and ``unit``.

    ``unit`` is given once for each key and batch.
    """
    def read(vectors: list[list[float] | None]) -> Answer:
        keys, units, had = [], [], set()
        for vector in vectors:
            u = unit(vector)
            key = None if u is None else xxhash.xxh3_128_digest(np.trim_zeros(u, "b").tobytes())
            keys.append(key)
            units.append(None if u is None or key in had else u)
            had.add(key)
        return None, {"key": keys, "unit": units}

    return map_rows(df, id_col, [F.col(vec_col)], "key binary, unit array<double>", read, "id")


def as_matrix(units: pd.Series, width: int) -> np.ndarray:
    """Rows of equal width; shorter vectors end in zeros."""
    out = np.zeros((len(units), width))
    for row, u in zip(out, units):
        row[:len(u)] = u
    return out


def principal_directions(classes: DataFrame, width: int) -> np.ndarray:
    """Leading eigenvectors of the covariance of all classes, as columns; zero where there are no more.

    Each task sends at most ``COVARIED`` squared sums, whatever it has read.
    """
    side = min(width, COVARIED)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, mean, n = np.zeros((side, side)), np.zeros(side), 0
        for batch in batches:
            m = as_matrix(batch["unit"], width)[:, :side]
            total += m.T @ m
            mean += m.sum(axis=0)
            n += len(m)
        sums = np.r_[total.ravel(), mean, n]
        yield pd.DataFrame({"place": np.arange(len(sums)), "value": sums})

    sums = classes.select("unit").mapInPandas(run, "place int, value double").groupBy("place").agg(
        F.sum("value").alias("value")).toPandas().sort_values("place")["value"].to_numpy()
    n = max(sums[-1], 1.0)
    mean = sums[-1 - side:-1] / n
    moments = sums[:side * side].reshape(side, side) / n - np.outer(mean, mean)
    _, vectors = np.linalg.eigh(moments)
    directions = np.zeros((width, LEADING))
    found = vectors[:, ::-1][:, :LEADING]
    directions[:side, :found.shape[1]] = found
    return directions


def in_order(classes: DataFrame, directions: np.ndarray, epsilon: float) -> DataFrame:
    """``place`` (position in grid order), ``key``, ``copies``, ``unit`` of every class."""
    width = len(directions)
    parts = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            grid = np.floor(as_matrix(batch["unit"], width) @ directions / (epsilon / 4))
            yield batch.assign(cell=list(grid.astype("i4")))

    def numbered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at = 0
        for batch in batches:
            yield batch.assign(within=np.arange(at, at + len(batch)))
            at += len(batch)

    ordered = (
        classes.mapInPandas(cells, "key binary, copies long, unit array<double>, cell array<int>")
        .repartitionByRange(parts, "cell", "key").sortWithinPartitions("cell", "key")
        .drop("cell").mapInPandas(numbered, "key binary, copies long, unit array<double>, within long")
        .withColumn("split", F.spark_partition_id())
    )
    ordered = settle(ordered)
    # One row per partition: the window orders partitions, not vectors.
    counts = ordered.groupBy("split").agg(F.count("*").alias("rows"))
    before = Window.orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("split", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    return ordered.join(F.broadcast(offsets), "split").select(
        (F.col("start") + F.col("within")).alias("place"), "key", "copies", "unit")


def blocks_of(ordered: DataFrame, directions: np.ndarray) -> DataFrame:
    """``block, low, high`` (its box), ``places, copies`` and ``rows`` (its matrix) of each block."""
    width = len(directions)

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("place")
        rows = as_matrix(group["unit"], width)
        spots = rows @ directions
        return pd.DataFrame({
            "block": [group["place"].iloc[0] // BLOCK], "low": [spots.min(axis=0)],
            "high": [spots.max(axis=0)], "places": [group["place"].to_numpy()],
            "copies": [group["copies"].to_numpy()], "rows": [rows.tobytes()]})

    return ordered.select(F.expr(f"place div {BLOCK}").alias("b"), "place", "copies", "unit").groupBy(
        "b").applyInPandas(pack, "block long, low array<double>, high array<double>, "
                                 "places array<long>, copies array<long>, rows binary")


def near_blocks(blocks: DataFrame, epsilon: float) -> DataFrame:
    """Pairs of blocks (``left <= right``) whose boxes are within epsilon, from the top down."""
    boxes = [blocks.select("block", *[F.col(end).getItem(i).alias(f"{end}_{i}")
                                      for end in ("low", "high") for i in range(LEADING)])]
    last = blocks.agg(F.max("block")).first()[0] or 0
    while last:
        last //= FAN_OUT
        boxes.append(boxes[-1].groupBy(F.expr(f"block div {FAN_OUT}").alias("block")).agg(
            *[F.min(f"low_{i}").alias(f"low_{i}") for i in range(LEADING)],
            *[F.max(f"high_{i}").alias(f"high_{i}") for i in range(LEADING)]))
    pairs = boxes[-1].select(F.col("block").alias("left"), F.col("block").alias("right"))
    children = F.sequence(F.lit(0), F.lit(FAN_OUT - 1))
    for level in reversed(boxes[:-1]):
        split = pairs.select(
            (F.col("left") * FAN_OUT).alias("left"), "right", F.explode(children).alias("a")).select(
            (F.col("left") + F.col("a")).alias("left"), (F.col("right") * FAN_OUT).alias("right"),
            F.explode(children).alias("b")).select(
            "left", (F.col("right") + F.col("b")).alias("right")).filter("left <= right")
        one = level.toDF("left", *[f"a_{c}" for c in level.columns[1:]])
        two = level.toDF("right", *[f"b_{c}" for c in level.columns[1:]])
        gap = " + ".join(
            f"pow(greatest(a_low_{i} - b_high_{i}, b_low_{i} - a_high_{i}, 0), 2)"
            for i in range(LEADING))
        pairs = split.join(one, "left").join(two, "right").filter(
            f"{gap} <= {epsilon ** 2 + SLACK}").select("left", "right")
    return pairs


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least index that links ``a``-``b`` connect each of n indices to."""
    root = np.arange(n)
    while True:
        x, y = root[a], root[b]
        if (x == y).all():
            return root
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while not (root[root] == root).all():
            root = root[root]


def compare(a: np.ndarray, b: np.ndarray, spots_a: np.ndarray, spots_b: np.ndarray,
            cosine: float, epsilon: float) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the pairs of rows with at least that cosine; distant parts are skipped."""
    left, right = [], []
    for i in range(0, len(a), PART):
        low, high = spots_a[i:i + PART].min(axis=0), spots_a[i:i + PART].max(axis=0)
        for j in range(0, len(b), PART):
            other = spots_b[j:j + PART]
            gap = np.maximum(0, np.maximum(low - other.max(axis=0), other.min(axis=0) - high))
            if gap @ gap > epsilon ** 2 + SLACK:
                continue
            x, y = np.nonzero(a[i:i + PART] @ b[j:j + PART].T >= cosine)
            left.append((x + i).astype("i4"))
            right.append((y + j).astype("i4"))
    empty = np.zeros(0, "i4")
    return np.concatenate([empty, *left]), np.concatenate([empty, *right])


def block_links(pairs: DataFrame, blocks: DataFrame, directions: np.ndarray, cosine: float,
                epsilon: float) -> DataFrame:
    """``place, links, root`` of the vectors that link within a pair of blocks."""
    width = len(directions)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                a, b = (np.frombuffer(x).reshape(-1, width) for x in (row.rows_a, row.rows_b))
                x, y = compare(a, b, a @ directions, b @ directions, cosine, epsilon)
                if row.left == row.right:
                    off = x != y
                    x, y = x[off], y[off]
                    places, root = row.places_a, local_roots(len(a), x, y)
                    links = np.bincount(x, row.copies_a[y], len(a))
                else:
                    places = np.r_[row.places_a, row.places_b]
                    root = local_roots(len(places), x, y + len(a))
                    links = np.r_[np.bincount(x, row.copies_b[y], len(a)),
                                  np.bincount(y, row.copies_a[x], len(b))]
                some = links > 0
                yield pd.DataFrame({"place": places[some], "links": links[some].astype("i8"),
                                    "root": places[root[some]]})

    def side(name: str, tag: str) -> DataFrame:
        return blocks.select(F.col("block").alias(name), *[
            F.col(c).alias(f"{c}_{tag}") for c in ("places", "copies", "rows")])

    met = pairs.join(side("left", "a"), "left").join(side("right", "b"), "right")
    return met.mapInPandas(run, "place long, links long, root long")


def near_vectors(df: DataFrame, cosine: float = 0.9, id_col: str = "vec_id",
                 vec_col: str = "embedding") -> DataFrame:
    """Per row of ``df``: ``vec_id, n_links, component_id, kept``.

    Intermediate tables are written to the shared folder when this is called.
    """
    epsilon = math.sqrt(max(0.0, 2 - 2 * cosine))
    rows = settle(read_vectors(df, id_col, vec_col))
    classes = rows.filter("key is not null").groupBy("key").agg(
        F.count("*").alias("copies"), F.max("unit").alias("unit"), F.min("id").alias("id"))
    classes = settle(classes)
    width = classes.agg(F.max(F.size("unit"))).first()[0]
    if width is None:
        return rows.select(F.col("id").alias("vec_id"), F.lit(0).cast("long").alias("n_links"),
                           F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    directions = principal_directions(classes, width)
    ordered = settle(in_order(classes.select("key", "copies", "unit"), directions, epsilon))
    blocks = settle(blocks_of(ordered, directions))
    pairs = settle(near_blocks(blocks, epsilon))
    found = settle(block_links(pairs.repartition("left", "right"), blocks, directions, cosine,
                               epsilon))
    links = found.groupBy("place").agg(F.sum("links").alias("links"))
    roots = components(found.select("place", "root"), "place", "root").withColumnRenamed(
        "node", "place")
    named = ordered.select("place", "key").join(links, "place", "left").join(roots, "place", "left")
    grouped = classes.select("key", "copies", "id").join(named, "key").filter(
        "copies > 1 or links > 0").select(
        "key", "id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("root", "place").alias("root"))
    grouped = settle(grouped)
    least = grouped.groupBy("root").agg(F.min("id").alias("component_id"))
    verdicts = grouped.join(least, "root").select("key", "n_links", "component_id")
    joined = rows.select("id", "key").join(verdicts, "key", "left")
    component = F.when(F.col("n_links").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return joined.select(
        F.col("id").alias("vec_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.when(F.col("n_links").isNull(), True).otherwise(
            F.coalesce(F.col("id") == F.col("component_id"), F.lit(False))).alias("kept"))
