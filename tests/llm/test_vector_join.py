"""The epsilon grid order join against a plain comparison of all vectors."""

import math

import numpy as np
import pytest
from pyspark.sql import types as T

from quillwork.llm import vectorjoin as V

SCHEMA = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())),
    T.StructField("key", T.StringType()), T.StructField("unit", T.IntegerType())])


def expected(rows, cosine=0.9):
    units = [V.unit(v) if v is not None and None not in v else None for _, v in rows]
    width = max((len(u) for u in units if u is not None), default=0)
    full = [None if u is None else np.pad(u, (0, width - len(u))) for u in units]
    n = len(rows)
    links = [[j for j in range(n) if j != i and full[i] is not None and full[j] is not None
              and float(full[i] @ full[j]) >= cosine] for i in range(n)]
    root = list(range(n))
    for _ in range(n):
        new = [min([root[i], *[root[j] for j in links[i]]]) for i in range(n)]
        if new == root:
            break
        root = new
    out = []
    for i, (number, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(n) if root[j] == root[i] and rows[j][0] is not None]
        component = min(ids, default=None) if links[i] else number
        kept = not links[i] or (number is not None and number == component)
        out.append((number, len(links[i]), component, kept))
    return sorted(out, key=str)


def found(spark, rows, parts=3):
    table = spark.createDataFrame([(i, v, "clash", 1) for i, v in rows], SCHEMA)
    return sorted(map(tuple, V.near_vectors(table.repartition(parts)).collect()), key=str)


def cloud(seed, n=300, width=12):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, width))
    rows = centres[rng.integers(0, 12, n)] + rng.normal(scale=0.35, size=(n, width))
    rows = np.vstack((rows, rng.normal(size=(n // 3, width)), np.repeat(rows[:1], 40, axis=0),
                      rows[5:9] * 7.5))
    return [(i + 1, r.tolist()) for i, r in enumerate(rows)]


@pytest.mark.parametrize("block, part", [(4096, 512), (16, 4), (7, 7)])
def test_against_all_pairs(spark, monkeypatch, block, part):
    monkeypatch.setattr(V, "BLOCK", block)
    monkeypatch.setattr(V, "PART", part)
    rows = cloud(block)
    assert found(spark, rows) == expected(rows)


def test_vectors_without_cosine_and_odd_ids(spark):
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [math.nan, 1.0]),
            (6, [math.inf, 1.0]), (None, [1.0, 0.0]), (8, [2.0, 0.1]), (8, [2.0, 0.1]),
            (9, [1e300, 1e299]), (10, [1e-300, 1e-301]), (None, None), (11, [0.0, 1.0]),
            (12, [1.0]), (13, [0.0, 3.0, 0.0])]
    got = found(spark, rows)
    assert got == expected(rows)
    assert {r[0]: r[1] for r in got}[8] == 5


def test_none_can_link_and_empty_table(spark):
    assert found(spark, [(1, None), (2, [0.0])]) == [(1, 0, 1, True), (2, 0, 2, True)]
    assert found(spark, [], 1) == []


def test_distant_blocks_are_skipped_and_near_ones_are_not(spark, monkeypatch):
    monkeypatch.setattr(V, "BLOCK", 8)
    rng = np.random.default_rng(1)
    angles = np.sort(rng.uniform(0, 2 * math.pi, 800))
    rows = [(i, [math.cos(t), math.sin(t), 0.0]) for i, t in enumerate(angles)]
    table = spark.createDataFrame([(i, v, "", 0) for i, v in rows], SCHEMA)
    sets = V.read_vectors(table, "vec_id", "embedding").selectExpr("key", "1L as copies", "unit")
    directions = V.principal_directions(sets, 3)
    blocks = V.settle(V.blocks_of(V.in_order(sets, directions, 0.1), directions))
    pairs = {tuple(r) for r in V.near_blocks(blocks, 0.1).collect()}
    boxes = {r.block: (np.array(r.low), np.array(r.high)) for r in blocks.collect()}
    near = {(i, j) for i in boxes for j in boxes if i <= j and np.linalg.norm(np.maximum(
        0, np.maximum(boxes[i][0] - boxes[j][1], boxes[j][0] - boxes[i][1]))) <= 0.1}
    assert pairs == near and len(pairs) < 0.3 * 100 * 101 / 2


def test_local_roots():
    a, b = np.array([5, 3, 1, 7]), np.array([3, 2, 0, 6])
    assert V.local_roots(9, a, b).tolist() == [0, 0, 2, 2, 4, 2, 6, 6, 8]
