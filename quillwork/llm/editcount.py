"""Edit-aware token counts with a stored segment tree of pre-tokens per document.

A text is cut into pre-tokens; a segment tree over groups of ``LEAF`` of them, its leaves, holds
characters and tokens per node.  :func:`build` encodes every document once and gives a table of trees:
per document its text, and the characters and tokens of its pre-tokens, from which the sums follow.

An edit (start, characters to delete, characters to insert) finds its leaves by descending the tree.
The leaves there and one on either side are cut anew, and more of them until the outermost ``CONTEXT``
pre-tokens on both sides come out as they were, in text the edit has not touched.  Only pre-tokens
that were not there before are encoded; the leaves and their ancestors get new sums.  The region's
pre-tokens are dealt to its old leaves, so the tree's shape stays.  :func:`edited` reads the trees of
edited documents only and gives their new rows; :func:`updated` puts those in place of the old.

Edits of a document are applied in their order.  Positions are clipped to the text as it then is.
Defined results: null text is empty; null insert text is empty; a null start, count or order counts
as 0; a document without edits has no new row; edits of unknown documents are ignored; equal edits of
one document count once; rows repeated under an id get the edits each; a null id has no edits; an
empty table gives an empty table; other columns, whatever their names, are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillwork.llm.arrow import Answer, map_rows
from quillwork.llm.bpe import GROUP_CHARS, Encoder, encoder
from quillwork.llm.packed import packed, unpacked
from quillwork.operators.sizing import join_measured, settle_measured
from quillwork.session import settle

CONTEXT = 4   # pre-tokens beside an edit whose cut an edit may change, an added token's included
LEAF = 16     # pre-tokens of a leaf when the tree is built
TREE = "text string, chars binary, tokens binary, n_tokens long, n_pieces long"


def counts_of_texts(own: Encoder, texts: Iterable[str | None]) -> Iterator[tuple[list[str], list[int]]]:
    """Pre-tokens of each text and their tokens; new ones of many texts are encoded side by side."""
    def counted(group: list[list[str]]) -> Iterator[tuple[list[str], list[int]]]:
        own.make_room()
        long = own.learn({p for pieces in group for p in pieces if p not in own.kept})
        known = own.kept.get
        for pieces in group:
            yield pieces, [len(known(p) or long[p]) // 4 for p in pieces]

    group, size = [], 0
    for text in texts:
        group.append(own.cut(text or ""))
        size += len(text or "")
        if size >= GROUP_CHARS:
            yield from counted(group)
            group, size = [], 0
    yield from counted(group)


class CountTree:
    """Characters and tokens of a text, kept up to date under edits."""

    def __init__(self, own: Encoder, text: str, chars: np.ndarray | None = None,
                 tokens: np.ndarray | None = None):
        """From a text, or from a stored tree: the characters and tokens of its pre-tokens as well."""
        self.own, self.encoded = own, 0
        if chars is None:
            pieces, found = next(counts_of_texts(own, [text]))
            self.encoded = len(pieces)
            chars, tokens = np.array(list(map(len, pieces)), "i8"), np.array(found, "i8")
        self.start_text, self.piece_chars, self.piece_tokens = text, chars, tokens
        n = len(chars)
        starts = np.arange(0, n, LEAF)
        self.n_leaves = max(1, len(starts))
        self.leaf_starts = np.concatenate(([0], np.cumsum(chars)))[starts] if n else np.zeros(1, "i8")
        # Leaves an edit has touched; the others are still as they were at the start.
        self.leaves: dict[int, tuple[list[str], list[int]]] = {}
        self.size = 1 << (self.n_leaves - 1).bit_length()
        self.chars, self.tokens = [0] * (2 * self.size), [0] * (2 * self.size)
        if n:
            self.chars[self.size:self.size + len(starts)] = np.add.reduceat(chars, starts).tolist()
            self.tokens[self.size:self.size + len(starts)] = np.add.reduceat(tokens, starts).tolist()
        for node in range(self.size - 1, 0, -1):
            self.add_up(node)

    def leaf(self, number: int) -> tuple[list[str], list[int]]:
        """Pre-tokens of a leaf and their tokens."""
        if number in self.leaves:
            return self.leaves[number]
        own = slice(number * LEAF, (number + 1) * LEAF)
        at, pieces = int(self.leaf_starts[number]), []
        for size in self.piece_chars[own].tolist():
            pieces.append(self.start_text[at:at + size])
            at += size
        return pieces, self.piece_tokens[own].tolist()

    def add_up(self, node: int) -> None:
        self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
        self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]

    def leaf_at(self, place: int) -> tuple[int, int]:
        """The leaf that holds a character, or the last one, and the character it starts at."""
        node, start = 1, 0
        while node < self.size:
            node *= 2
            if place - start >= self.chars[node]:
                start += self.chars[node]
                node += 1
        leaf = min(node - self.size, self.n_leaves - 1)
        if leaf < node - self.size:
            start = self.chars[1] - self.chars[self.size + leaf]
        return leaf, start

    def put(self, leaf: int, pieces: list[str], counts: list[int]) -> None:
        """Replace a leaf and repair the sums above it."""
        self.leaves[leaf] = (pieces, counts)
        node = self.size + leaf
        self.chars[node], self.tokens[node] = sum(map(len, pieces)), sum(counts)
        while node > 1:
            node //= 2
            self.add_up(node)

    def edit(self, start: int, delete: int, insert: str) -> None:
        start = min(max(start, 0), self.chars[1])
        end = min(start + max(delete, 0), self.chars[1])
        first, at = self.leaf_at(start)
        last, _ = self.leaf_at(end)
        # Whole leaves around the edit, one more on either side; further ones if the cuts don't meet.
        if first > 0:
            first -= 1
            at -= self.chars[self.size + first]
        last = min(last + 1, self.n_leaves - 1)
        while True:
            region = [self.leaf(i) for i in range(first, last + 1)]
            old = [p for pieces, _ in region for p in pieces]
            text = "".join(old)
            new = self.own.cut(text[:start - at] + insert + text[end - at:])
            left = first == 0 or self.meets(old, new, start - at, True)
            right = last == self.n_leaves - 1 or self.meets(old, new, len(text) - (end - at), False)
            if left and right:
                break
            if not left:
                first -= 1
                at -= self.chars[self.size + first]
            if not right:
                last += 1
        known = dict(zip(old, (c for _, counts in region for c in counts)))
        for piece in new:
            if piece not in known:
                known[piece] = len(self.own.ids_of(piece)) // 4
                self.encoded += 1
        width = last - first + 1
        share = -(-len(new) // width) if new else 0
        for i in range(width):
            part = new[i * share:(i + 1) * share]
            self.put(first + i, part, [known[p] for p in part])

    @staticmethod
    def meets(old: list[str], new: list[str], untouched: int, from_left: bool) -> bool:
        """Do the outermost ``CONTEXT`` pre-tokens of old and new agree, inside untouched text?"""
        ends = slice(0, CONTEXT) if from_left else slice(-CONTEXT, None)
        mine, yours = old[ends], new[ends]
        return len(mine) == CONTEXT and mine == yours and sum(map(len, mine)) < untouched

    def text(self) -> str:
        return "".join(p for i in range(self.n_leaves) for p in self.leaf(i)[0])

    def stored(self) -> tuple[str, bytes, bytes, int, int]:
        """The tree as a row: text, characters and tokens of its pre-tokens, and their numbers."""
        leaves = [self.leaf(i) for i in range(self.n_leaves)]
        chars = np.array([len(p) for pieces, _ in leaves for p in pieces], "i8")
        tokens = np.array([t for _, counts in leaves for t in counts], "i8")
        return self.text(), packed(chars), packed(tokens), self.tokens[1], len(chars)


def build(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The trees of all documents: ``doc_id, text, chars, tokens, n_tokens, n_pieces``."""
    shipped = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def trees(texts: list[str | None]) -> Answer:
        out: dict[str, list] = {"text": [t or "" for t in texts], "chars": [], "tokens": [],
                                "n_tokens": [], "n_pieces": []}
        for pieces, counts in counts_of_texts(encoder(shipped.value), texts):
            out["chars"].append(packed(np.array(list(map(len, pieces)), "u4")))
            out["tokens"].append(packed(np.array(counts, "u4")))
            out["n_tokens"].append(sum(counts))
            out["n_pieces"].append(len(pieces))
        return None, out

    return map_rows(docs, id_col, [F.col(text_col)], TREE, trees)


def edit_struct() -> Column:
    return F.struct(
        F.coalesce("step", F.lit(0)).cast("long").alias("step"),
        F.coalesce("start", F.lit(0)).cast("long").alias("start"),
        F.coalesce("remove", F.lit(0)).cast("long").alias("remove"),
        F.coalesce("insert", F.lit("")).alias("insert"))


def with_edits(trees: DataFrame, edits: DataFrame) -> DataFrame:
    """The trees of the documents that ``edits`` (``doc_id, step, start, remove, insert``) names, with
    the list of their edits.

    Lists are broadcast when they measure small; else trees of other documents still stay where they
    are if the table is bucketed by id, and only then are moved.
    """
    lists, size = settle_measured(
        edits.filter(F.col("doc_id").isNotNull()).select("doc_id", edit_struct().alias("edit"))
        .distinct().groupBy("doc_id").agg(F.sort_array(F.collect_list("edit")).alias("edits")))
    return join_measured(trees, lists, size, ["doc_id"])


def edited(trees: DataFrame, vocabulary: str, keep: bool = True) -> DataFrame:
    """What the edits make of the trees: their new rows, with ``tokens_before``, ``n_edits`` and
    ``n_encoded_again``, how many pre-tokens were encoded for it.

    ``trees`` has a column ``edits`` (see :func:`with_edits`).  Without ``keep`` only the counts are
    returned.
    """
    shipped = trees.sparkSession.sparkContext.broadcast(vocabulary)

    def change(texts: list, chars: list, tokens: list, lists: list) -> Answer:
        own = encoder(shipped.value)
        own.make_room()
        out: dict[str, list] = {name: [] for name in (
            "tokens_before", "tokens_after", "n_edits", "n_encoded_again", "text", "chars", "tokens",
            "n_tokens", "n_pieces")}
        for text, c, t, steps in zip(texts, chars, tokens, lists):
            tree = CountTree(own, text, unpacked(c).astype("i8"), unpacked(t).astype("i8"))
            out["tokens_before"].append(tree.tokens[1])
            for step in steps or ():
                tree.edit(step["start"], step["remove"], step["insert"])
            out["tokens_after"].append(tree.tokens[1])
            out["n_edits"].append(len(steps or ()))
            out["n_encoded_again"].append(tree.encoded)
            if keep:
                for name, value in zip(("text", "chars", "tokens", "n_tokens", "n_pieces"), tree.stored()):
                    out[name].append(value)
        return None, out

    counts = "tokens_before long, tokens_after long, n_edits long, n_encoded_again long"
    return map_rows(trees, "doc_id", [F.col(c) for c in ("text", "chars", "tokens", "edits")],
                    f"{counts}, {TREE}" if keep else counts, change)


def updated(trees: DataFrame, changed: DataFrame) -> DataFrame:
    """The trees with the changed rows in place of those under their ids."""
    ids, size = settle_measured(changed.select("doc_id").distinct())
    names = ["doc_id", "text", "chars", "tokens", "n_tokens", "n_pieces"]
    same = trees.filter("doc_id is null").unionByName(
        join_measured(trees.filter("doc_id is not null"), ids, size, ["doc_id"], "left_anti"))
    return same.select(*names).unionByName(changed.select(*names))


def edited_counts(docs: DataFrame, edits: DataFrame, vocabulary: str, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """Per document: tokens before and after its edits, and how many pre-tokens were encoded again.

    Builds and stores the trees of all documents, then edits those that have edits.
    """
    trees = settle(build(docs, vocabulary, id_col, text_col))
    changed = edited(with_edits(trees, edits), vocabulary, keep=False)
    ids, size = settle_measured(edits.select("doc_id").distinct())
    rest = trees.filter("doc_id is null").unionByName(
        join_measured(trees.filter("doc_id is not null"), ids, size, ["doc_id"], "left_anti"))
    none = F.lit(0).cast("long")
    return changed.unionByName(rest.select(
        "doc_id", F.col("n_tokens").alias("tokens_before"), F.col("n_tokens").alias("tokens_after"),
        none.alias("n_edits"), none.alias("n_encoded_again")))


def derived_edits(text: str = "text", id_col: str = "doc_id") -> Column:
    """Three edits per document from the crc32 of its id, for tables that bring none.

    One replaces five characters in the text, one appends a copy of its first words, one deletes a
    stretch of up to forty characters.  A null id has none.
    """
    seed, length = f"crc32(cast(`{id_col}` as string))", f"cast(length(coalesce(`{text}`, '')) as long)"
    return F.expr(f"""if(`{id_col}` is null, cast(array() as
        array<struct<step:bigint,start:bigint,remove:bigint,insert:string>>), array(
        struct(0L as step, {seed} % ({length} + 1) as start, 5L as remove, ' edited' as insert),
        struct(1L as step, {length} as start, 0L as remove,
               concat(' ', substring(coalesce(`{text}`, ''), 1, 30)) as insert),
        struct(2L as step, ({seed} div 7) % ({length} + 1) as start, {seed} % 40 as remove,
               '' as insert)))""")
