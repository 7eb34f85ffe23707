"""Byte-level BPE with a segment tree over the ranks of adjacent pairs.

A text is cut at the vocabulary's added tokens, then into pre-tokens.  Each pre-token becomes a row
of byte symbols.  A segment tree holds, for every adjacent pair, ``rank * width + position`` (or no
value when the pair cannot be merged), so its root is the leftmost pair of lowest rank.  Merging it
changes at most three leaves; each change walks up the tree.  The row is done when the root is
empty.  A pre-token of n bytes costs O(n log n), however long it is; short ones are merged side by
side, one tree per row of an array.

Defined results: a null or empty text has no ids and decodes to the empty text; repeated rows are
encoded alike; an empty table gives an empty table.  Other columns of the input are not looked at.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillwork.llm.arrow import Answer, map_rows

# Fixed value: the pattern that the byte-level pre-tokenizer applies.
PRE_TOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# Encoded pre-tokens kept by a Python worker; only those of up to WIDTHS[-1] bytes, so the memory
# is bounded.
KEPT_PIECES = 600_000
WIDTHS = (8, 16, 32)
GROUP_CHARS = 2_000_000
NO_PAIR = np.iinfo("i8").max


def byte_letters() -> dict[str, int]:
    """The printable stand-in of each byte: itself where visible, else the next code above 255."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


class PairTree:
    """Ranks of the adjacent pairs of a row of symbols, with the best pair at the root."""

    def __init__(self, leaves: list[int], none: int):
        self.size = size = 1 << max(0, len(leaves) - 1).bit_length()
        self.tree = tree = [none] * size + leaves + [none] * (size - len(leaves))
        for node in range(size - 1, 0, -1):
            left, right = tree[2 * node], tree[2 * node + 1]
            tree[node] = left if left < right else right

    def best(self) -> int:
        return self.tree[1]

    def put(self, leaf: int, value: int) -> None:
        """Set one leaf and repair its ancestors, stopping where nothing changes."""
        tree, node = self.tree, self.size + leaf
        tree[node] = value
        while node > 1:
            other = tree[node ^ 1]
            low = value if value < other else other
            node >>= 1
            if tree[node] == low:
                return
            tree[node] = value = low


class Encoder:
    """Encodes and decodes texts with one vocabulary, given as the text of its JSON file."""

    def __init__(self, vocabulary: str):
        spec = json.loads(vocabulary)
        letters, ids = byte_letters(), spec["model"]["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.ranks = {(ids[a] << 20) | ids[b]: r for r, (a, b) in enumerate(pairs)}
        self.merged = [ids[a + b] for a, b in pairs]
        self.of_byte = [0] * 256
        for letter, byte in letters.items():
            self.of_byte[byte] = ids[letter]
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.words = [b""] * (1 + max([*ids.values(), *added.values()]))
        for token, number in ids.items():
            self.words[number] = bytes(letters[c] for c in token)
        for token, number in added.items():
            self.words[number] = token.encode()
        self.added = {t: i.to_bytes(4, "little") for t, i in added.items()}
        keys = np.fromiter(self.ranks, "i8", len(self.ranks))
        order = np.argsort(keys)
        self.pair_keys = keys[order]
        self.pair_ranks = np.fromiter(self.ranks.values(), "i8", len(self.ranks))[order]
        self.merged_ids, self.byte_ids = np.array(self.merged), np.array(self.of_byte)
        names = sorted(map(regex.escape, added), key=len, reverse=True)
        self.at_added = regex.compile(f"({'|'.join(names)})") if names else None
        self.pieces = regex.compile(PRE_TOKENS).findall
        self.kept: dict[str, bytes] = dict(self.added)

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one pre-token, by repeated merging of the tree's best pair."""
        row = [self.of_byte[b] for b in piece]
        width = len(row)
        if width < 2:
            return row
        rank, merged, none = self.ranks.get, self.merged, len(self.merged) * width
        leaves = [none] * (width - 1)
        for i in range(width - 1):
            r = rank((row[i] << 20) | row[i + 1])
            if r is not None:
                leaves[i] = r * width + i
        tree = PairTree(leaves, none)
        after, before = list(range(1, width + 1)), list(range(-1, width - 1))
        while (best := tree.best()) != none:
            r, i = divmod(best, width)
            gone = after[i]
            row[i] = merged[r]
            row[gone] = -1
            after[i] = right = after[gone]
            if gone < width - 1:
                tree.put(gone, none)
            r = None
            if right < width:
                before[right] = i
                r = rank((row[i] << 20) | row[right])
            tree.put(i, none if r is None else r * width + i)
            left = before[i]
            if left >= 0:
                r = rank((row[left] << 20) | row[i])
                tree.put(left, none if r is None else r * width + left)
        return [s for s in row if s >= 0]

    def merge_side_by_side(self, pieces: list[bytes], width: int) -> list[bytes]:
        """Ids of many short pre-tokens, whose trees are the rows of one array.

        All pieces have at most ``width`` bytes.  The steps are those of :meth:`merge`, taken for
        every row whose root still holds a pair.
        """
        n = len(pieces)
        sizes = np.fromiter(map(len, pieces), "i8", n)
        inside = np.arange(width) < sizes[:, None]
        row = np.full((n, width + 1), -1, "i8")
        row[:, :width][inside] = self.byte_ids[np.frombuffer(b"".join(pieces), "u1")]
        places = np.arange(width)
        tree = np.full((n, 2 * width), NO_PAIR, "i8")
        tree[:, width:2 * width - 1] = self.pair_values(
            row[:, :width - 1], row[:, 1:width], places[:-1], width)
        for node in range(width - 1, 0, -1):
            tree[:, node] = np.minimum(tree[:, 2 * node], tree[:, 2 * node + 1])
        after = np.where(places + 1 < sizes[:, None], places + 1, width)
        before = np.tile(places - 1, (n, 1))
        todo = np.flatnonzero(tree[:, 1] != NO_PAIR)
        while len(todo):
            rank, at = np.divmod(tree[todo, 1], width)
            gone = after[todo, at]
            right = after[todo, gone]
            row[todo, at] = joined = self.merged_ids[rank]
            row[todo, gone] = -1
            after[todo, at] = right
            follows = right < width
            before[todo[follows], right[follows]] = at[follows]
            left = before[todo, at]
            led = left >= 0
            tree[todo, width + gone] = NO_PAIR
            tree[todo, width + at] = self.pair_values(joined, row[todo, right], at, width)
            rows, lefts = todo[led], left[led]
            tree[rows, width + lefts] = self.pair_values(
                row[rows, lefts], joined[led], lefts, width)
            for changed, leaf in ((todo, gone), (todo, at), (rows, lefts)):
                node = (width + leaf) >> 1
                for _ in range(width.bit_length() - 1):
                    tree[changed, node] = np.minimum(
                        tree[changed, 2 * node], tree[changed, 2 * node + 1])
                    node >>= 1
            todo = todo[tree[todo, 1] != NO_PAIR]
        left_over = row >= 0
        raw = row[left_over].astype("<u4").tobytes()
        ends = (4 * np.cumsum(left_over.sum(axis=1))).tolist()
        return [raw[a:b] for a, b in zip([0, *ends], ends)]

    def pair_values(self, left, right, place, width: int) -> np.ndarray:
        """Tree values of pairs: rank and place, or none."""
        keys = (left << 20) | right
        found = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        known = (self.pair_keys[found] == keys) & (left >= 0) & (right >= 0)
        return np.where(known, self.pair_ranks[found] * width + place, NO_PAIR)

    def learn(self, pieces: set[str]) -> dict[str, bytes]:
        """Encode pre-tokens that are not kept, and keep the short ones."""
        out, by_width = {}, {w: [] for w in WIDTHS}
        for piece in pieces:
            size = len(piece.encode())
            for width in WIDTHS:
                if size <= width:
                    by_width[width].append(piece)
                    break
            else:
                out[piece] = np.array(self.merge(piece.encode()), "<u4").tobytes()
        for width, group in by_width.items():
            for i in range(0, len(group), 20_000):
                part = group[i:i + 20_000]
                ids = self.merge_side_by_side([p.encode() for p in part], width)
                self.kept.update(zip(part, ids))
        return out

    def ids_of(self, piece: str) -> bytes:
        """Ids of one pre-token, kept if it is short."""
        ids = self.kept.get(piece)
        if ids is None:
            raw = piece.encode()
            ids = np.array(self.merge(raw), "<u4").tobytes()
            if len(raw) <= WIDTHS[-1]:
                self.kept[piece] = ids
        return ids

    def make_room(self) -> None:
        """Forget kept pre-tokens if there are too many."""
        if len(self.kept) >= KEPT_PIECES:
            self.kept.clear()
            self.kept.update(self.added)

    def encode_many(self, texts: list[str | None]) -> list[bytes]:
        """Ids of whole texts as little-endian unsigned 32-bit integers."""
        self.make_room()
        known, new, rows = self.kept.get, set(), []
        for text in texts:
            pieces = self.cut(text or "")
            ids = list(map(known, pieces))
            gaps = [i for i, x in enumerate(ids) if x is None] if None in ids else []
            missing = [pieces[i] for i in gaps]
            new.update(missing)
            rows.append((ids, gaps, missing))
        long = self.learn(new)
        for ids, gaps, missing in rows:
            for i, piece in zip(gaps, missing):
                ids[i] = known(piece) or long[piece]
        return [b"".join(ids) for ids, _, _ in rows]

    def cut(self, text: str) -> list[str]:
        """Added tokens and pre-tokens of a text."""
        parts = self.at_added.split(text) if self.at_added else [text]
        if len(parts) == 1:
            return self.pieces(text)
        return [p for i, part in enumerate(parts) for p in ([part] if i % 2 else self.pieces(part))]

    def encode_all(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """As :meth:`encode_many`, in groups of a few million characters."""
        group, size = [], 0
        for text in texts:
            group.append(text)
            size += len(text or "")
            if size >= GROUP_CHARS:
                yield from self.encode_many(group)
                group, size = [], 0
        yield from self.encode_many(group)

    def encode(self, text: str | None) -> np.ndarray:
        return np.frombuffer(self.encode_many([text])[0], "<u4")

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; bytes that are not UTF-8 become replacement characters."""
        words = self.words
        return b"".join([words[i] for i in ids.tolist()]).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def encoder(vocabulary: str) -> Encoder:
    """One encoder per Python worker, so that its kept pre-tokens serve all its tasks."""
    return Encoder(vocabulary)


def read_vocabulary(path: str) -> str:
    """The text of a vocabulary file on the driver; it travels to the tasks by value (1.5 MB)."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def encode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """Per row: its id and ``ids``, the array of token ids of its whole text."""
    shipped = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def rows(texts: list[str | None]) -> Answer:
        own = encoder(shipped.value)
        return None, {"ids": [np.frombuffer(raw, "<i4") for raw in own.encode_all(texts)]}

    return map_rows(docs, id_col, [F.col(text_col)], "ids array<int>", rows)


def decode(encoded: DataFrame, vocabulary: str, id_col: str = "doc_id",
           ids_col: str = "ids") -> DataFrame:
    """Per row: its id and ``text`` of its token ids; null ids give the empty text."""
    shipped = encoded.sparkSession.sparkContext.broadcast(vocabulary)

    def rows(lists: list[list[int] | None]) -> Answer:
        own = encoder(shipped.value)
        return None, {"text": ["" if x is None else own.decode(np.asarray(x, "i8")) for x in lists]}

    return map_rows(encoded, id_col, [F.col(ids_col)], "text string", rows)
