"""Exact n-gram Jaccard join by vertical partitioning.

A document's set is its distinct 5-word shingles, as 64-bit hashes; their order is the global n-gram
order.  Documents with equal sets are one node, so exact copies never meet.  Then:

1. *Prefixes.*  Of two sets that link, the first common n-grams lie near the front of both.  The
   front quarter of every set is range-partitioned by (n-gram, node), and each partition streams
   over its fragment of the global order, noting n-grams that several nodes have.  Nodes with too
   few of them cannot link and are out; a frequent n-gram is only a long run, cut anywhere.
2. *Fragments.*  The sets of the nodes left are cut at fixed places of the global order.  The overlap
   of a pair is counted in each fragment separately and summed per pair.
3. *Hubs.*  Nodes with the same first n-gram of a fragment are compared with the most typical of
   them, their hub, not with each other.
4. *Beside a hub.*  Two nodes of one hub that are not linked through it must share many of the n-grams
   in which each differs from the hub.  Edits of one's own are shared with nobody, so this leaves
   few nodes, which are joined on the rarest of their shared differences (prefix filter).  First only
   with the one nearest to the hub, which joins most copies of an edited copy.
5. *Across hubs.*  Other links share only n-grams that occur with several hubs and components; nodes
   of which these do not make up four fifths are out, and the filter is repeated on what is left.
   The rest is joined on the rarest of those n-grams, never inside a hub.

Candidates of 4 and 5 are counted as in 2: they meet their sets on (node, fragment), and the overlaps of
the fragments are summed per pair.  Nothing is capped; only those candidates are pairs, and never pairs
of one component.  Defined results: null text, or text without words, has size 0 and links with
nothing; rows with a null id take part, and are never the least id of a component; rows with equal texts
and ids give equal rows; an empty table gives an empty table; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillwork.llm.arrow import Answer, map_rows
from quillwork.llm.components import components
from quillwork.operators.sizing import in_few_files, join_measured, settle_counted, settle_measured
from quillwork.session import Scratch

WORDS = 5
FRAGMENTS = 8
Measured = tuple[DataFrame, tuple[int, int]]  # a settled table, its rows and bytes
# Odd 64-bit constants that mix word hashes by place; any such numbers do.
PLACES = [np.uint64(2 * 0x4F1BBCDCBFA53E0B * (i + 1) + 1 & 0xFFFFFFFFFFFFFFFF) for i in range(WORDS)]


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct shingles of a whole text as signed 64-bit hashes."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, "i8")
    if len(words) < WORDS:
        digest = xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words))
        return np.array([digest], "u8").view("i8")
    hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in words], "u8")
    n = len(words) - WORDS + 1
    mixed = hashes[:n] * PLACES[0]
    for i in range(1, WORDS):
        mixed ^= (hashes[i:i + n] + np.uint64(i)) * PLACES[i]
        mixed ^= mixed >> np.uint64(31)
        mixed *= np.uint64(0xD6E8FEB86659FD93)
    mixed ^= mixed >> np.uint64(32)
    return np.unique(mixed.view("i8"))


def node_of(items: np.ndarray) -> bytes | None:
    """128 bits that stand for a set; none for the empty set."""
    return xxhash.xxh3_128_digest(items.tobytes()) if len(items) else None


def least_common(n):
    """The fewest common n-grams of a set of n with any set it links to: four fifths of it."""
    return (4 * n + 4) // 5


def front_length(n: int) -> int:
    """The common n-grams that :func:`front_needed` counts on lie in this much of a set's front."""
    return n - least_common(n) + 1 + n // 16


def front_needed(n):
    """n-grams in the front of a set of n that a set it links to has in its front, at least.

    The smaller set of a pair shows ``1 + size // 16`` in both fronts; it has at least four fifths
    of the larger one's n-grams.
    """
    return 1 + least_common(n) // 16


# The same in SQL.
LEAST_COMMON = "((4 * n + 4) div 5)"
NEEDED = f"(1 + {LEAST_COMMON} div 16)"
FRONT = f"(n - {LEAST_COMMON} + 1 + n div 16)"


def read_sets(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Per row: id, size, node and the front of its set (null where the batch has had the node)."""
    def read(texts: list[str | None]) -> Answer:
        sizes, nodes, fronts, had = [], [], [], {None}
        for text in texts:
            items = shingles(text)
            node = node_of(items)
            sizes.append(len(items))
            nodes.append(node)
            fronts.append(None if node in had else items[:front_length(len(items))])
            had.add(node)
        return None, {"n": sizes, "node": nodes, "front": fronts}

    return map_rows(docs, id_col, [F.col(text_col)], "n long, node binary, front array<long>", read, "id")


def shared_in_order(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """From rows sorted by (item, short): the distinct ones whose item another ``short`` has too.

    A run at an end of the partition may go on next door and counts as shared.
    """
    held = None
    first = True
    for batch in batches:
        rows = batch[["item", "short"]].to_numpy()
        if held is not None:
            rows = np.vstack((held, rows))
        if not len(rows):
            continue
        new = np.ones(len(rows), bool)
        new[1:] = (rows[1:] != rows[:-1]).any(axis=1)
        rows = rows[new]
        starts = np.flatnonzero(np.r_[True, rows[1:, 0] != rows[:-1, 0]])
        sizes = np.diff(np.r_[starts, len(rows)])
        last = rows[starts[-1]:]
        shared = np.repeat(sizes > 1, sizes)
        if first:
            shared[:sizes[0]] = True
        if len(starts) > 1:
            first = False
        body = rows[:starts[-1]][shared[:starts[-1]]]
        # Of a run that is still open, one row has to stay for comparison, two if it is shared.
        if len(last) > 2:
            body = np.vstack((body, last[:-2]))
            last = last[-2:]
        held = last
        yield pd.DataFrame(body, columns=["item", "short"])
    if held is not None:
        yield pd.DataFrame(held, columns=["item", "short"])


def short_name(node: str) -> Column:
    """Half of a node's bits: enough to find candidates by, which are compared as whole nodes."""
    return F.xxhash64(node)


def survivors(sets: DataFrame) -> DataFrame:
    """``short`` of the nodes whose front holds enough n-grams that other fronts hold too.

    ``rank`` is the share of such n-grams; the original of a group of edited copies has the highest.
    """
    parts = int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    entries = sets.filter("front is not null").select(
        short_name("node").alias("short"), F.explode("front").alias("item"))
    shared = (
        entries.repartitionByRange(parts, "item", "short")
        .sortWithinPartitions("item", "short")
        .mapInPandas(shared_in_order, "item long, short long")
    )
    counts = shared.groupBy("short").agg(F.count("*").alias("found"))
    sizes = sets.filter("front is not null").groupBy(short_name("node").alias("short")).agg(
        F.max("n").alias("n"), F.max(F.size("front")).alias("front"))
    return counts.join(sizes, "short").filter(F.col("found") >= F.expr(NEEDED)).select(
        "short", (F.col("found") / F.col("front")).alias("rank"))


def segments(docs: DataFrame, nodes: Measured, keys: Measured, id_col: str, text_col: str) -> DataFrame:
    """Cut sets of the wanted nodes: ``node, n, rank, part, items, ahead``, a row per fragment.

    ``ahead`` says how many items of the fragment belong to the front of the set.
    Only rows whose ``key`` (id as text) is wanted are read again; a row found by its id whose set
    is another is dropped by its node.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cuts = np.linspace(-2.0 ** 63, 2.0 ** 63, FRAGMENTS + 1)[1:-1].astype("i8")
        for batch in batches:
            out = []
            for text in batch["text"]:
                items = shingles(text)
                node, left = node_of(items), front_length(len(items))
                for part, piece in enumerate(np.split(items, np.searchsorted(items, cuts))):
                    out.append((node, len(items), part, piece, min(left, len(piece))))
                    left -= min(left, len(piece))
            yield pd.DataFrame(out, columns=["node", "n", "part", "items", "ahead"])

    texts = docs.select(key_text(id_col).alias("key"), F.col(text_col).alias("text"))
    cut = join_measured(texts, *keys, ["key"], "left_semi").mapInPandas(
        run, "node binary, n long, part int, items array<long>, ahead int")
    named = cut.filter("node is not null").withColumn("short", short_name("node"))
    return join_measured(named, *nodes, ["short"]).drop("short").dropDuplicates(["node", "part"])


def key_text(id_col: str) -> Column:
    return F.coalesce(F.col(id_col).cast("string"), F.lit(""))


def linked(pairs: DataFrame, cut: DataFrame) -> DataFrame:
    """The pairs ``a, b`` with a Jaccard similarity of four fifths or more.

    A pair meets in each fragment separately, on (node, fragment); the overlaps are counted there and
    summed per pair.
    """
    one = cut.select(F.col("node").alias("a"), "part", F.col("n").alias("n_a"), F.col("items").alias("items_a"))
    two = cut.select(F.col("node").alias("b"), "part", F.col("n").alias("n_b"), F.col("items").alias("items_b"))
    met = pairs.join(one, "a").join(two, ["b", "part"])
    common = F.sum(F.size(F.array_intersect("items_a", "items_b")).cast("long"))
    return met.groupBy("a", "b", "n_a", "n_b").agg(common.alias("common")).filter(
        100 * F.col("common") >= 80 * (F.col("n_a") + F.col("n_b") - F.col("common"))).select("a", "b")


def hubs_of(cut: DataFrame) -> DataFrame:
    """``node, hub``: for nodes that share a fragment's first n-gram with others, one of those.

    In each such bucket the hub is the node of the highest rank; a node takes the hub that most of
    its fragments name.
    """
    keyed = cut.filter("size(items) > 0").select(
        "node", "rank", F.struct("part", F.element_at("items", 1).alias("first")).alias("bucket"))
    named = keyed.groupBy("bucket").agg(
        F.max(F.struct("rank", "node")).alias("top"), F.count("*").alias("members")).filter(
        "members > 1").select("bucket", F.col("top.rank").alias("top"), F.col("top.node").alias("hub"))
    # Dealt by node once, for both groupings.
    votes = keyed.join(named, "bucket").repartition("node").groupBy("node", "hub").agg(
        F.count("*").alias("votes"), F.max("top").alias("top"))
    return votes.groupBy("node").agg(F.max(F.struct("votes", "top", "hub")).alias("best")).select(
        "node", F.col("best.hub").alias("hub")).filter("node <> hub")


def differences(left: pd.Series, right: pd.Series) -> pd.DataFrame:
    """Numbers of common items of sorted arrays, and the items of only one of them."""
    rows = []
    for a, b in zip(left, right):
        only = np.setxor1d(a, b, assume_unique=True)
        rows.append(((len(a) + len(b) - len(only)) // 2, only))
    return pd.DataFrame(rows, columns=["common", "only"])


def compared_with_hubs(scratch: Scratch, cut: DataFrame, nodes: int) -> DataFrame:
    """``node, hub, n, n_hub, common, only`` for each node with a hub it has half in common with.

    ``only`` lists, per fragment, the items that just one of the two has.  Fragments are compared
    separately and put together per node.  ``nodes`` is how many nodes there are at most.
    """
    compare = F.pandas_udf(differences, "common long, only array<long>")
    pairs, size = scratch.settle(in_few_files(hubs_of(cut), nodes), "hubs", settle_measured)
    tops, known = scratch.settle(
        in_few_files(pairs.select("hub").distinct(), nodes), "tops", settle_measured)
    hub = join_measured(
        cut.select(F.col("node").alias("hub"), F.col("n").alias("n_hub"), "part",
                   F.col("items").alias("items_hub")), tops, known, ["hub"], "left_semi")
    parts = join_measured(cut.select("node", "n", "part", "items"), pairs, size, ["node"]).join(
        hub, ["hub", "part"])
    return (
        parts.select("node", "hub", "n", "n_hub", compare("items", "items_hub").alias("x"))
        .groupBy("node", "hub", "n", "n_hub")
        .agg(F.sum("x.common").alias("common"), F.flatten(F.collect_list("x.only")).alias("only"))
        .filter("2 * common >= n + n_hub - common")
    )


def beside_hubs(scratch: Scratch, compared: DataFrame, count: int, roots: Measured | None,
                to_first: bool = False) -> DataFrame | None:
    """Candidate links between nodes of one hub that are not in one component yet.

    ``count`` is the number of rows of ``compared``.

    With ``to_first`` only those to the nearest to the hub of the nodes that share a difference: few,
    and they join most copies of an edited copy.

    Let D(x) be the items in which x and the hub differ.  Then x and y differ in
    ``|D(x)| + |D(y)| - 2 |D(x) & D(y)|`` items, and link if nine times that is at most
    ``n(x) + n(y)``.  As one of them, x, does not link with the hub, D(x) and D(y) must share more
    than ``(9 |D(y)| + n(hub) - n(y)) / 18`` and at least ``|D(x)| - n(x) / 4`` items, and one at
    least.  Edits of one's own never count, so few nodes stay; those are joined on the rarest
    shared differences.
    """
    all_nodes = with_roots(compared, roots).select(
        short_name("node").alias("node"), short_name("root").alias("root"),
        short_name("hub").alias("hub"), "n", "only", "n_hub", "common")
    open_hubs, size = scratch.settle(
        in_few_files(all_nodes.groupBy("hub").agg(
            F.min("root").alias("low"), F.max("root").alias("high")
        ).filter("low <> high").select("hub"), count), "hubs", settle_measured)
    if not size[0]:
        return None
    open_nodes = scratch.settle(join_measured(all_nodes, open_hubs, size, ["hub"]), "open")
    items = open_nodes.select("node", "root", "hub", F.explode("only").alias("item"))
    facts = open_nodes.select(
        "node", "n", F.size("only").cast("long").alias("d"), "n_hub",
        F.expr("9 * size(only) > n + n_hub").alias("apart"))
    as_x = "(apart and size >= greatest(1, d - n div 4))"
    least_y = "greatest(1, (9 * d + n_hub - n) div 18 + if((9 * d + n_hub - n) >= 0, 1, 0))"
    kept, rows = narrowed(scratch, items, ["hub", "item"], facts, "d", f"{as_x} or size >= {least_y}")
    if kept is None:
        return None
    ranked = scratch.settle(in_few_files(kept.selectExpr(
        "node", "root", "hub", "n", "d", "n_hub", "apart", "item", "size",
        "row_number() over (partition by node order by df, item) as place"), rows), "ranked")
    x = ranked.filter(f"{as_x} and place <= size - greatest(1, d - n div 4) + 1").selectExpr(
        "hub", "item", "node as x", "root as root_x", "n as n_x", "d as d_x",
        "size - place + 1 as rest_x")
    y = ranked.filter(f"size >= {least_y} and place <= size - {least_y} + 1").selectExpr(
        "hub", "item", "node as y", "root as root_y", "n as n_y", "d as d_y",
        "size - place + 1 as rest_y")
    if to_first:
        y = y.groupBy("hub", "item").agg(
            F.min(F.struct("d_y", "y", "root_y", "n_y", "rest_y")).alias("first")).select(
            "hub", "item", "first.*")
        return x.join(y, ["hub", "item"]).filter("root_x <> root_y").filter(
            "5 * least(n_x, n_y) >= 4 * greatest(n_x, n_y) and 9 * abs(d_x - d_y) <= n_x + n_y"
        ).select("x", "y").distinct()
    # At a pair's first shared difference, what is left of either bounds how many they share.
    return x.join(y, ["hub", "item"]).filter("root_x <> root_y").filter(
        "5 * least(n_x, n_y) >= 4 * greatest(n_x, n_y) and 9 * abs(d_x - d_y) <= n_x + n_y").filter(
        "18 * least(rest_x, rest_y) >= 9 * (d_x + d_y) - n_x - n_y").select(
        F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()


def narrowed(scratch: Scratch, items: DataFrame, key: list[str], facts: DataFrame, held: str, enough: str,
             differ: tuple[str, ...] = ("root",)) -> tuple[DataFrame | None, int]:
    """Rows of ``items`` whose key has several values in ``differ``, of nodes with enough of them.

    ``items`` has ``node, root, hub, item``, ``facts`` a row per node with what ``enough`` asks for and
    ``held``, its rows in ``items`` or more.
    Repeated while a tenth of the nodes fall out; ``size`` is a node's number of rows left and ``df``
    the key's.  None if no node is left.  Also how many rows there are at most.
    """
    facts, known = scratch.settle(facts, "facts", settle_measured)
    rows = facts.agg(F.sum(F.expr(held))).first()[0] or 0
    before = None
    while True:
        several = items.groupBy(*key).agg(
            F.count("*").alias("df"),
            *[f(c).alias(f"{f.__name__}_{c}") for c in differ for f in (F.min, F.max)]
        ).filter(" and ".join(f"min_{c} <> max_{c}" for c in differ)).select(*key, "df")
        # Keys grow with the items, so they are never broadcast; oversized partitions are split.
        kept = items.join(several.hint("merge"), key).select("node", "root", "hub", "item", "df")
        kept, rows = scratch.settle(in_few_files(kept, rows), "kept", settle_counted)
        counts = kept.groupBy("node").agg(F.count("*").alias("size"))
        nodes, size = scratch.settle(
            in_few_files(join_measured(counts, facts, known, ["node"]).filter(enough), known[0]),
            "nodes", settle_measured)
        if not size[0]:
            return None, 0
        if before is not None and 10 * size[0] >= 9 * before:
            return join_measured(kept, nodes, size, ["node"]), rows
        items = join_measured(kept.drop("df"), nodes.select("node"), size, ["node"], "left_semi")
        before = size[0]


def with_roots(table: DataFrame, roots: Measured | None) -> DataFrame:
    """``table`` with the component found so far of each node as ``root``."""
    if roots is None:
        return table.withColumn("root", F.col("node"))
    return join_measured(table, *roots, ["node"], "left").withColumn("root", F.coalesce("root", "node"))


def across_hubs(scratch: Scratch, cut: DataFrame, compared: DataFrame, roots: Measured | None
                ) -> DataFrame | None:
    """Candidate links between nodes of different hubs and components.

    Such a pair shares only n-grams that nodes of several hubs and components have.  The fronts are
    looked at first; whole sets only of nodes that have enough of those in front.
    """
    hubs, size = scratch.settle(compared.select("node", "hub"), "hubs", settle_measured)
    labelled = scratch.settle(
        join_measured(with_roots(cut, roots), hubs, size, ["node"], "left").select(
            short_name("node").alias("node"), short_name("root").alias("root"),
            F.xxhash64(F.coalesce("hub", "node")).alias("hub"), "part", "n", "items", "ahead"), "labelled")
    columns, differ = ["node", "root", "hub"], ("hub", "root")
    facts = labelled.filter("part = 0").select("node", "n")
    front = labelled.filter("ahead > 0").select(
        *columns, F.explode(F.slice("items", F.lit(1), F.col("ahead"))).alias("item"))
    seen, rows = narrowed(scratch, front, ["item"], facts, FRONT, f"size >= {NEEDED}", differ)
    if seen is None:
        return None
    ahead, size = scratch.settle(
        in_few_files(seen.select("node").distinct(), rows), "ahead", settle_measured)
    whole = join_measured(labelled, ahead, size, ["node"], "left_semi").select(
        *columns, F.explode("items").alias("item"))
    kept, rows = narrowed(scratch, whole, ["item"], facts, "n", f"size >= {LEAST_COMMON}", differ)
    if kept is None:
        return None
    ranked = kept.selectExpr(
        *columns, "n", "item", "size",
        "row_number() over (partition by node order by df, item) as place")
    first = scratch.settle(in_few_files(ranked.filter(f"place <= size - {LEAST_COMMON} + 1").selectExpr(
        *columns, "n", "item", "size - place + 1 as rest"), rows), "first")
    # Pairs within the hub that most rows of a bucket have are never formed.
    main = first.groupBy("item", "hub").agg(F.count("*").alias("m")).groupBy("item").agg(
        F.max(F.struct("m", "hub")).alias("main")).select("item", F.col("main.hub").alias("main"))
    minor = first.join(main, "item").filter("hub <> main").selectExpr(
        "item", "node as node_b", "root as root_b", "hub as hub_b", "n as n_b",
        "rest as rest_b")
    return first.join(minor, "item").filter(
        "root <> root_b and hub <> hub_b and 5 * least(n, n_b) >= 4 * greatest(n, n_b)").filter(
        "9 * least(rest, rest_b) >= 4 * (n + n_b)").select(
        F.least("node", "node_b").alias("x"), F.greatest("node", "node_b").alias("y")).distinct()


def node_components(scratch: Scratch, cut: DataFrame, nodes: int) -> Measured | None:
    """``node, root`` of the nodes that link to others, or none.

    Components are formed again only after a step that found links.  ``nodes`` is how many there are
    at most.
    """
    compared, near = scratch.settle(compared_with_hubs(scratch, cut, nodes), "compared", settle_counted)
    found, count = scratch.settle(
        compared.filter("9 * common >= 4 * (n + n_hub)").select(
            F.col("node").alias("a"), F.col("hub").alias("b")), "found", settle_counted)
    names = scratch.settle(
        cut.filter("part = 0").select("node", short_name("node").alias("short")), "names", settle_measured)
    roots = rooted(scratch, found, count) if count else None
    for name, step in (("nearest", lambda r: beside_hubs(scratch, compared, near, r, to_first=True)),
                       ("beside", lambda r: beside_hubs(scratch, compared, near, r)),
                       ("across", lambda r: across_hubs(scratch, cut, compared, r))):
        pairs = step(roots)
        if pairs is None:
            continue
        for short, node in (("x", "a"), ("y", "b")):
            pairs = join_measured(pairs, names[0].toDF(node, short), names[1], [short])
        pairs, most = scratch.settle(pairs.select("a", "b"), "pairs", settle_counted)
        if not most:
            continue
        more, new = scratch.settle(in_few_files(linked(pairs, cut), most), name, settle_counted)
        if new:
            found, count = found.union(more), count + new
            roots = rooted(scratch, found, count)
    return roots


def rooted(scratch: Scratch, links: DataFrame, count: int) -> Measured:
    """The components of so many links, settled."""
    return scratch.settle(
        in_few_files(components(links, count=count), 2 * count), "roots", settle_measured)


def ngram_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_shingles, component_id``.

    ``component_id`` is the least id reachable by links, the row's own where there are none.
    Computed when this is called; of the tables written to the shared folder only the result is left.
    """
    scratch = Scratch(docs.sparkSession)
    sets, rows = scratch.settle(read_sets(docs, id_col, text_col), "sets", settle_counted)
    classes = sets.filter("node is not null").groupBy("node").agg(
        F.min("id").alias("id"), F.count("*").alias("copies"))
    own = scratch.settle(in_few_files(survivors(sets), rows), "own", settle_measured)
    wanted = join_measured(classes.withColumn("short", short_name("node")), *own, ["short"], "left_semi")
    keys = scratch.settle(
        in_few_files(wanted.select(key_text("id").alias("key")).distinct(), 2 * own[1][0]),
        "keys", settle_measured)
    cut = scratch.settle(segments(docs, own, keys, id_col, text_col), "cut")
    roots = node_components(scratch, cut, own[1][0])
    if roots is None:
        groups = classes.filter("copies > 1").select("node", F.col("id").alias("component_id"))
    else:
        named = join_measured(classes, *roots, ["node"], "left").filter(
            "copies > 1 or root is not null").select("node", "id", F.coalesce("root", "node").alias("root"))
        grouped, rows = scratch.settle(in_few_files(named, rows), "rooted", settle_counted)
        least = grouped.groupBy("root").agg(F.min("id").alias("component_id"))
        groups = in_few_files(grouped.join(least, "root").select("node", "component_id"), rows)
    groups, size = scratch.settle(groups, "groups", settle_measured)
    result = scratch.settle(
        join_measured(sets.select("id", "n", "node"), groups, size, ["node"], "left").select(
            F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"),
            F.coalesce("component_id", "id").alias("component_id")), "result")
    scratch.close("result")
    return result
