"""Runs: maximal stretches of words with a period, found through string synchronising sets.

A run has smallest period q and at least three periods.  At scale t (1, 2, 4, ...) a synchronising set
holds the places i where, of the hashes of the t-word fragments that start at i, ..., i + t, the least
is at either end; fragments with a period of t / 3 or less are left out.  Whether i belongs to it
follows from the 2t words there alone, its *context*.

* Inside a run with 2t - 1 <= q <= 4t - 2, some place i of the first q words belongs to the set, else
  all of them would have a period of t / 3 or less and so would the run; as words repeat, i + q then
  belongs to it too, with an equal context.  So pairs of equal contexts at such distances propose every
  period.  Equal contexts are more than t / 3 apart, so a place is in a dozen pairs at most.
* The highly periodic regions that the set leaves out are runs of smaller periods with at least three
  of them, so smaller scales have found them; they are marked before a scale is searched.

A proposal is extended in both directions by comparing hashes of doubling lengths; what results is
compared word by word, and where a hash misled, the period is searched for in all words.  Texts are
searched many at a time, joined by words that occur nowhere else.

Every text is searched where it lies: there is no shuffle.  Memory follows ``BLOCK`` words or the
longest text.  Defined results: null text, and text without a word, has no runs and an empty
collapsed text; repeated rows get equal answers; a null id stays null; an empty table gives an empty
table; other columns are not looked at.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import compress, count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

PERIODS = 3       # of a run, at least
SHORTEST = 24     # words of a run that is reported
BLOCK = 400_000   # words searched together
LEFT_OUT = np.uint64(0xFFFFFFFFFFFFFFFF)
BASE = np.uint64(0xB5297A4D3F84D5B5)      # any odd number
UNBASE = np.uint64(pow(0xB5297A4D3F84D5B5, -1, 1 << 64))


def mixed(x: np.ndarray) -> np.ndarray:
    """64 bits spread over 64 bits, one to one."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xC2B2AE3D27D4EB4F)
    return x ^ (x >> np.uint64(32))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, "u8")
    out[:1] = 1
    return np.cumprod(out, dtype="u8")


class Hashes:
    """Hashes of any stretch of a row of numbers, modulo 2 ** 64."""

    def __init__(self, row: np.ndarray):
        n = len(row)
        self.n, self.up, self.down = n, powers(BASE, n + 1), powers(UNBASE, n + 1)
        self.sums = np.zeros(n + 1, "u8")
        np.cumsum(mixed(row.view("u8")) * self.up[:n], out=self.sums[1:])

    def at(self, places: np.ndarray, width: int) -> np.ndarray:
        return (self.sums[places + width] - self.sums[places]) * self.down[places]

    def all_of(self, end: int, width: int) -> np.ndarray:
        """Of every stretch of ``width`` before ``end``."""
        return (self.sums[width:end + 1] - self.sums[:end + 1 - width]) * self.down[:end + 1 - width]

    def reach(self, left: np.ndarray, period: np.ndarray, longest: int, forward: bool) -> np.ndarray:
        """How far the numbers from ``left`` on (or before it) equal those a period later."""
        far = np.zeros(len(left), "i8")
        scale = self.up[period]
        for bit in range(max(longest, 1).bit_length() - 1, -1, -1):
            width = 1 << bit
            at = left + far if forward else left - far - width
            fits = at + period + width <= self.n if forward else at >= 0
            at = np.where(fits, at, 0)
            same = fits & ((self.sums[at + width] - self.sums[at]) * scale
                           == self.sums[np.where(fits, at + period + width, 0)]
                           - self.sums[np.where(fits, at + period, 0)])
            far[same] += width
        return far


def synchronising_set(hashes: Hashes, end: int, scale: int, regions: np.ndarray) -> np.ndarray:
    """The places before ``end``; ``regions`` are runs (start, end, period) of smaller scales."""
    fragments = mixed(hashes.all_of(end, scale))
    inner = regions[(3 * regions[:, 2] <= scale) & (regions[:, 1] - regions[:, 0] >= scale)]
    inner = inner[inner[:, 1] <= end]
    if len(inner):
        steps = np.zeros(len(fragments) + 1, "i4")
        np.add.at(steps, inner[:, 0], 1)
        np.add.at(steps, inner[:, 1] - scale + 1, -1)
        fragments[np.cumsum(steps[:-1]) > 0] = LEFT_OUT
    least, width = fragments, 1
    while width < scale:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    least = np.minimum(least[:-1], least[1:])
    n = len(least)
    ends = (fragments[:n] == least) | (fragments[scale:scale + n] == least)
    return np.flatnonzero(ends & (least != LEFT_OUT))


def proposals(hashes: Hashes, places: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Places with the same context at a distance that fits the scale: the first, and the distance."""
    contexts = hashes.at(places, 2 * scale)
    order = np.argsort(contexts, kind="stable")
    contexts, places = contexts[order], places[order]
    firsts, periods = [places[:0]], [places[:0]]
    for step in range(1, len(places)):
        apart = places[step:] - places[:-step]
        near = (contexts[step:] == contexts[:-step]) & (apart <= 4 * scale - 2)
        if not near.any():
            break
        near &= apart >= 2 * scale - 1
        firsts.append(places[:-step][near])
        periods.append(apart[near])
    return np.concatenate(firsts), np.concatenate(periods)


def is_run(row: np.ndarray, start: int, end: int, period: int) -> bool:
    """Does the stretch have the period, and no neighbour extend it?"""
    return (np.array_equal(row[start:end - period], row[start + period:end])
            and (start == 0 or row[start - 1] != row[start - 1 + period])
            and (end == len(row) or row[end] != row[end - period]))


def stretches_of(row: np.ndarray, period: int) -> np.ndarray:
    """All (start, end, period) with at least three periods, by comparing all numbers."""
    same = np.r_[0, (row[:-period] == row[period:]).view("i1"), 0]
    turns = np.flatnonzero(np.diff(same))
    starts, ends = turns[::2], turns[1::2] + period
    found = np.stack((starts, ends, np.full(len(starts), period)), axis=1)
    return found[ends - starts >= PERIODS * period]


def runs_of(row: np.ndarray, widths: list[int]) -> np.ndarray:
    """All runs (start, end, smallest period) of at least three periods, whatever their length.

    ``row`` holds texts of the given numbers of words, longest first, each followed by a number that
    occurs nowhere else.
    """
    found: dict[tuple[int, int], int] = {}
    if not widths:
        return np.zeros((0, 3), "i8")
    hashes, ends = Hashes(row), np.cumsum(np.array(widths) + 1)
    scale = 1
    while PERIODS * (2 * scale - 1) <= widths[0]:
        # Only texts that hold three periods of this scale.
        texts = int(np.searchsorted(-np.array(widths), -PERIODS * (2 * scale - 1), "right"))
        regions = np.array([(s, e, p) for (s, e), p in found.items()], "i8").reshape(-1, 3)
        places = synchronising_set(hashes, int(ends[texts - 1]), scale, regions)
        firsts, periods = proposals(hashes, places, scale)
        if len(firsts):
            right = firsts + periods + hashes.reach(firsts, periods, widths[0], True)
            left = firsts - hashes.reach(firsts, periods, widths[0], False)
            long = right - left >= PERIODS * periods
            rows = np.unique(np.stack((left, right, periods), axis=1)[long], axis=0)
            misled = set()
            for start, end, period in rows.tolist():
                if is_run(row, start, end, period):
                    found.setdefault((start, end), period)
                else:
                    misled.add(period)
            for period in sorted(misled):
                for start, end, _ in stretches_of(row, period).tolist():
                    found.setdefault((start, end), period)
        scale *= 2
    return np.array([(s, e, p) for (s, e), p in found.items()], "i8").reshape(-1, 3)


def block_runs(texts: list[list[bytes]], shortest: int) -> list[list[tuple[int, int, int]]]:
    """The runs (start, length, period) of each text, given as words, by start, then period."""
    order = sorted(range(len(texts)), key=lambda t: -len(texts[t]))
    order = [t for t in order if texts[t]]
    number = defaultdict(count().__next__)
    row: list[int] = []
    for place, t in enumerate(order):
        row.extend(map(number.__getitem__, texts[t]))
        row.append(-1 - place)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    widths = [len(texts[t]) for t in order]
    starts = np.cumsum([0, *(w + 1 for w in widths)])
    for start, end, period in runs_of(np.array(row, "i8"), widths).tolist():
        if end - start >= shortest:
            place = int(np.searchsorted(starts, start, "right")) - 1
            out[order[place]].append((start - int(starts[place]), end - start, period))
    for runs in out:
        runs.sort(key=lambda r: (r[0], r[2]))
    return out


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words, joined by blanks, without those that a run holds after its first period."""
    if runs:
        gone = np.zeros(len(words) + 1, "i4")
        for start, length, period in runs:
            gone[start + period] += 1
            gone[start + length] -= 1
        words = compress(words, (np.cumsum(gone)[:-1] == 0).tolist())
    return b" ".join(words)


RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  shortest: int = SHORTEST) -> DataFrame:
    """Per row: ``doc_id, n_words, runs, collapsed``.

    ``runs`` lists ``start, length, period`` by start, then period, of all runs of at least
    ``shortest`` words; ``collapsed`` is the text with one period of each, its words joined by blanks.
    """
    kind = docs.schema[id_col].dataType
    schema = pa.schema([("doc_id", to_arrow_type(kind)), ("n_words", pa.int64()), ("runs", RUNS),
                        ("collapsed", pa.large_string())])

    def answer(ids: list[pa.Scalar], texts: list[list[bytes]]) -> pa.RecordBatch:
        runs = block_runs(texts, shortest)
        offsets = np.cumsum([0, *map(len, runs)])
        flat = np.array([r for own in runs for r in own], "i8").reshape(-1, 3)
        structs = pa.StructArray.from_arrays(
            [pa.array(flat[:, i]) for i in range(3)], names=["start", "length", "period"])
        return pa.RecordBatch.from_arrays([
            pa.array(ids, schema.field("doc_id").type),
            pa.array([len(words) for words in texts], pa.int64()),
            pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), structs).cast(RUNS),
            pa.array([collapsed(w, r).decode() for w, r in zip(texts, runs)], pa.large_string()),
        ], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, size = [], [], 0
            for number, text in zip(batch.column(0), batch.column(1)):
                words = (text.as_py() or "").encode().split()
                ids.append(number)
                texts.append(words)
                size += len(words)
                if size >= BLOCK:
                    yield answer(ids, texts)
                    ids, texts, size = [], [], 0
            if ids:
                yield answer(ids, texts)

    return docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).mapInArrow(
        run, f"doc_id {kind.simpleString()}, n_words long, "
             "runs array<struct<start:long,length:long,period:long>>, collapsed string")
