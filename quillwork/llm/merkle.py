"""Merkle manifest of a dataset, with proofs, by nested-interval labels.

Rows are grouped into trees and ranked in each by an order key.  A node carries its level and the
interval ``[lo, hi)`` of leaf ranks it covers; a parent covers two consecutive nodes, the last one of a
level maybe one.  The roots of the trees are the leaves of one more tree, whose root stands for the
dataset.

* *Growing.*  ``STEP`` levels at a time: 64 neighbouring digests, never more, meet in one row and give
  the levels above them, so a tree of a billion leaves takes five rounds.
* *Siblings.*  Nodes join the nodes one level up, bucketed by level and place and tested by containment
  of the intervals; what a parent's interval holds beside the node's own is its sibling's.
* *Ancestors.*  A base node joins, level by level, the ``STEP`` nodes above it that contain it; the rest
  of the way is attached once per group of 64 base nodes, from the top down.  Work and shuffles are in
  proportion to the rows; no table is broadcast but measured small ones, and no tree, however large
  its share of the rows, is ever in one task.

Defined results: a null field is ``-`` in its leaf, any other is its UTF-8 byte count, ``:`` and the
value; a null tree key is a tree, before all others; null order keys come first; rows equal in all
fields are leaves of their own, next to each other; an empty or null text is a leaf like any other; an
empty table has no rows.  Other columns, whatever their names, are not looked at.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillwork.operators.sizing import join_measured, settle_measured
from quillwork.session import settle

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
STEP = 6  # levels of a round: 64 digests meet in one row


def hashed(*digests: Column) -> Column:
    """The digest of digests, each as hexadecimal text; null ones are left out."""
    return F.unhex(F.sha2(F.lower(F.concat(*[F.coalesce(F.hex(d), F.lit("")) for d in digests])), 256))


def shown(digest: Column | str) -> Column:
    """A digest as hexadecimal text."""
    return F.lower(F.hex(digest))


def leaf_digest(*fields: Column) -> Column:
    """The digest of a row's fields."""
    def part(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(
            F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.unhex(F.sha2(F.concat(*map(part, fields)), 256))


def tree_key(column: Column) -> Column:
    """A key that is never null and sorts a null before all texts."""
    return F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit(""))


def ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` of ``tree`` with ``lo``, the rank in the tree, and ``n``, the tree's size.

    Range-partitioned and sorted once; a partition's rows of a tree are then shifted by what earlier
    partitions hold of it, a table of at most partitions plus trees rows.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = settle(rows.withColumn("row", F.monotonically_increasing_id()))
    line = ["tree", *order, "row"]
    placed = settle(rows.repartitionByRange(parts, *line).sortWithinPartitions(*line).drop("row")
                    .withColumn("at", F.monotonically_increasing_id())
                    .withColumn("part", F.shiftright("at", 33)))
    tree = Window.partitionBy("tree")
    earlier = tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    spans, size = settle_measured(
        placed.groupBy("tree", "part").agg(F.count("*").alias("rows"), F.min("at").alias("first"))
        .select("tree", "part", F.sum("rows").over(tree).alias("n"),
                (F.coalesce(F.sum("rows").over(earlier), F.lit(0)) - F.col("first")).alias("shift")))
    return join_measured(placed, spans, size, ["tree", "part"]).withColumn(
        "lo", F.col("at") + F.col("shift")).drop("at", "part", "shift")


def grown(base: DataFrame, low: int) -> DataFrame:
    """The nodes of the ``STEP`` levels above ``base``, the nodes of level ``low``.

    ``base`` has ``tree, n, lo, digest``; the result ``tree, n, level, lo, hi, digest``.
    """
    def above(row: Column, alone: Column) -> Column:
        pairs = F.transform(F.sequence(F.lit(0), F.floor((F.size(row) - 1) / 2).cast("int")),
                            lambda i: hashed(F.get(row, 2 * i), F.get(row, 2 * i + 1)))
        return F.when(alone & (F.size(row) <= 1), F.slice(row, 1, 0)).otherwise(pairs)

    blocks = base.groupBy("tree", "n", F.shiftright("lo", low + STEP).alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("lo", "digest"))).alias("run")).select(
        "tree", "n", "block", F.col("run.digest").alias("row"),
        (F.col("n") <= 1 << low + STEP).alias("alone"))
    levels = F.aggregate(
        F.sequence(F.lit(1), F.lit(STEP)), F.array("row"),
        lambda rows, _: F.concat(rows, F.array(above(F.element_at(rows, -1), F.col("alone")))))
    return (
        blocks.select("tree", "n", "block", F.posexplode(levels).alias("up", "row"))
        .filter("up > 0").select("tree", "n", "block", (F.col("up") + low).alias("level"),
                                 F.posexplode("row").alias("place", "digest"))
        .withColumn("lo", F.expr(f"shiftleft(block, {low + STEP}) + shiftleft(cast(place as long), level)"))
        .withColumn("hi", F.expr("least(lo + shiftleft(1L, level), n)"))
        .select("tree", "n", "level", "lo", "hi", "digest")
    )


def siblings(nodes: DataFrame, parents: DataFrame) -> DataFrame:
    """``tree, level, lo, hi, before, sibling`` of the nodes that have a parent.

    ``before`` tells whether the sibling lies to the left; both are null where the parent covers the
    node alone.
    """
    up = nodes.select("tree", F.struct("lo", "hi", "digest").alias("node"),
                      (F.col("level") + 1).alias("up")).withColumn(
        "span", F.expr("shiftright(node.lo, up)"))
    over = parents.select("tree", F.col("level").alias("up"), F.expr("shiftright(lo, level)").alias("span"),
                          F.col("lo").alias("from"), F.col("hi").alias("to"))
    held = up.join(over, ["tree", "up", "span"]).filter("from <= node.lo and node.hi <= to")
    families = held.groupBy("tree", "up", "span", "from", "to").agg(
        F.collect_list("node").alias("members"))  # at most two
    left_over = F.expr("filter(members, m -> (m.lo = from and m.hi = node.lo) "
                       "or (m.lo = node.hi and m.hi = to))")
    return families.withColumn("node", F.explode("members")).select(
        "tree", (F.col("up") - 1).alias("level"), "node.lo", "node.hi",
        F.get(left_over, F.lit(0)).alias("other")).select(
        "tree", "level", "lo", "hi", F.expr("other.lo < lo").alias("before"),
        F.col("other.digest").alias("sibling"))


def climbed(base: DataFrame, kin: DataFrame, low: int) -> DataFrame:
    """``tree, lo, path``: siblings on the way from nodes of level ``low`` through ``STEP`` levels."""
    asked = base.select("tree", F.col("lo").alias("at"), F.explode(F.sequence(
        F.lit(low), F.lit(low + STEP - 1))).alias("level")).withColumn(
        "slot", F.expr("shiftright(at, level)"))
    held = kin.withColumn("slot", F.expr("shiftright(lo, level)"))
    return asked.join(held, ["tree", "level", "slot"]).filter("lo <= at and at < hi").groupBy(
        "tree", F.col("at").alias("lo")).agg(
        F.sort_array(F.collect_list(F.struct("level", "before", "sibling"))).alias("path"))


def tree_nodes(leaves: DataFrame) -> list[DataFrame]:
    """The nodes above ``leaves`` (``tree, n, lo, digest``), a table for each ``STEP`` levels."""
    largest = leaves.agg(F.max("n")).first()[0] or 1
    tables, base, low = [], leaves, 0
    while not tables or largest > 1 << low:
        tables.append(settle(grown(base, low)))
        low += STEP
        base = tables[-1].filter(F.col("level") == low)
    return tables


def paths(leaves: DataFrame, tables: list[DataFrame]) -> DataFrame:
    """``tree, lo, path``: every leaf's siblings from its own level up to its tree's root."""
    empty = F.expr("cast(array() as array<struct<level:int,before:boolean,sibling:binary>>)")
    full = None
    for step in range(len(tables) - 1, -1, -1):
        low = step * STEP
        base = (leaves.withColumns({"level": F.lit(0), "hi": F.col("lo") + 1}) if step == 0 else
                tables[step - 1].filter(F.col("level") == low))
        base = base.select("tree", "n", "level", "lo", "hi", "digest")
        inner = base.unionByName(tables[step].filter(F.col("level") < low + STEP))
        own = climbed(base, siblings(inner, tables[step]), low)
        if full is not None:
            rest = full.select("tree", F.shiftright("lo", low + STEP).alias("block"),
                               F.col("path").alias("rest"))
            own = own.withColumn("block", F.shiftright("lo", low + STEP)).join(
                rest, ["tree", "block"], "left").select(
                "tree", "lo", F.concat("path", F.coalesce("rest", empty)).alias("path"))
        full = settle(own)
    return full


def tree_roots(leaves: DataFrame, tables: list[DataFrame]) -> DataFrame:
    """``tree, digest`` of the node that covers a whole tree."""
    roots = leaves.filter("n = 1").select("tree", "digest")
    for table in tables:
        roots = roots.union(table.filter("lo = 0 and hi = n").select("tree", "digest"))
    return roots


def manifest(docs: DataFrame, fields: tuple[str, ...] = FIELDS, tree_col: str = "lang",
             order_col: str = "doc_id", carry: Mapping[str, Column] | None = None) -> DataFrame:
    """Per row: ``id`` (the order column), ``leaf``, ``subroot``, ``root`` and ``path``.

    Digests are binary; ``path`` lists ``level, before, sibling`` from the leaf to the root, the levels
    of the tree of subroots after those of the row's own tree.  ``carry`` adds columns computed from
    the row.  Intermediate tables are written to the shared folder when this is called.
    """
    carry = dict(carry or {})
    rows = docs.select(
        tree_key(F.col(tree_col)).alias("tree"), F.col(order_col).alias("id"),
        leaf_digest(*map(F.col, fields)).alias("digest"),
        *[c.alias(f"carry_{name}") for name, c in carry.items()])
    leaves = settle(ranked(rows, ["id", "digest"]))
    tables = tree_nodes(leaves)
    tops = settle(ranked(
        tree_roots(leaves, tables).select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest"),
        ["name"]))
    upper = tree_nodes(tops)
    root = tree_roots(tops, upper).first()
    empty = F.expr("cast(array() as array<struct<level:int,before:boolean,sibling:binary>>)")
    over, size = settle_measured(
        tops.join(paths(tops, upper), ["tree", "lo"], "left").select(
            F.col("name").alias("tree"), F.col("digest").alias("subroot"),
            F.coalesce("path", empty).alias("upper")))
    own = leaves.join(paths(leaves, tables), ["tree", "lo"], "left")
    return join_measured(own, over, size, ["tree"]).select(
        "id", F.col("digest").alias("leaf"), "subroot",
        F.lit(bytes(root.digest) if root else None).cast("binary").alias("root"),
        F.concat(F.coalesce("path", empty), "upper").alias("path"),
        *[F.col(f"carry_{name}").alias(name) for name in carry])


def folded(leaf: Column, path: Column) -> Column:
    """The root that follows from a leaf's digest and the siblings on its path."""
    return F.aggregate(path, leaf, lambda now, step: F.when(step["before"], hashed(
        step["sibling"], now)).otherwise(hashed(now, step["sibling"])))


def proof_digest(path: Column) -> Column:
    """One digest, as text, of a path's siblings."""
    return F.sha2(F.array_join(F.transform(
        F.filter(path, lambda s: s["sibling"].isNotNull()), lambda s: shown(s["sibling"])), ""), 256)
