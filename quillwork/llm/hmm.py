"""A hidden Markov model of words, trained by Baum-Welch, and exact likelihoods of texts.

A text's tokens are its words, A-Z in lower case, and one end.  A latent state emits the class of a
token, and the class the token itself: ``P(token | state) = e(class | state) * p(token | class)``.
A token that makes up 1/``OWN`` of all training tokens or more is a class of its own (so there are at
most ``OWN`` of these), and so is the end; other words share ``SHAPES`` classes by their last three
bytes.  Within a class, ``p(token | class) = (c + 1) / (N_class + V_class + 1)``, the last 1 being for
words not seen, so a state's probabilities add up to one.  Parameters are thus bounded, however many
words there are, while ``c`` is counted for every word of the corpus:

1. *Chunks.*  Each task numbers the words of its documents, ``CHUNK`` tokens at a time, and counts them.
   A chunk is a row: its documents, their tokens as small numbers, its words as 64-bit hashes.
2. *Counts.*  A row per word and chunk is shuffled by word, given the sum over the chunks, and goes back
   by chunk.  A word found in every document is one row a chunk.  (Two words of equal hash would share
   their counts: of 10^9 words the chance of any such pair is 3 %.)
3. *Baum-Welch.*  ``ROUNDS`` rounds, each over all training tokens.  Stretches of up to ``STRETCH``
   tokens are laid side by side as blocks once, in the order the recursions take them; in a round a
   task sums the expected starts, transitions and emissions of its blocks by scaled forward and
   backward recursion; the sums are added up per class over all tasks, as whole numbers (so their order
   does not matter), and smoothed with all words' shares.
4. *Scores.*  The scaled forward recursion runs over whole texts, however long.

Defined results: null text is empty and has the end only; a row whose ``learns`` is null is not learned
from; with nothing to learn from, all words are unknown; repeated rows count each; an empty table
gives an empty table; a null id stays null; other columns are not looked at.
"""

from __future__ import annotations

import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from quillwork.llm.packed import packed, unpacked
from quillwork.session import Scratch

STATES = 8
OWN, SHAPES = 8192, 4096
CHUNK = 1_500_000
STRETCH, GROUP = 256, 200_000   # tokens of a training sequence, and of those worked on side by side
ROUNDS = 23
PRIOR = 50.0                    # tokens by which a state's emissions are drawn towards all words' shares
UNIT = float(1 << 20)           # expected counts are summed in these parts
END = b"\n"                     # no word holds white space


# 1. Chunks

class Chunk:
    """Documents of a task, their words numbered in order of appearance."""

    def __init__(self):
        self.number = defaultdict(count().__next__)
        self.number[END]
        self.ids, self.held, self.learns, self.lengths = [], [], [], []
        self.tokens = array("I")

    def add(self, number: pa.Scalar, text: str | None, learns: bool, held: bool) -> None:
        words = (text or "").encode().lower().split()
        self.tokens.extend(map(self.number.__getitem__, words))
        self.tokens.append(0)
        self.ids.append(number)
        self.learns.append(learns)
        self.held.append(held)
        self.lengths.append(len(words) + 1)

    def row(self, name: int, schema: pa.Schema) -> pa.RecordBatch:
        tokens = np.frombuffer(self.tokens, "u4")
        learned = tokens[np.repeat(self.learns, self.lengths)]
        counts = np.bincount(learned, minlength=len(self.number))
        keys = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in self.number), "u8", len(self.number))
        shapes = np.fromiter((zlib.crc32(w[-3:]) % SHAPES for w in self.number), "i4",
                             len(self.number))
        values = {
            "chunk": name, "ids": self.ids, "held": self.held, "learns": self.learns,
            "lengths": self.lengths, "tokens": packed(tokens), "trained": len(learned),
            "keys": keys.view("i8").tobytes(), "counts": packed(counts),
            "shapes": packed(shapes)}
        columns = [pa.array([values[f.name]], f.type) if f.name != "ids" else pa.ListArray.from_arrays(
            pa.array([0, len(self.ids)], pa.int32()), pa.array(self.ids, f.type.value_type)).cast(f.type)
            for f in schema]
        return pa.RecordBatch.from_arrays(columns, schema=schema)


def chunks(docs: DataFrame, id_col: str, text_col: str, learns: Column, held: Column) -> DataFrame:
    """A row per ``CHUNK`` tokens of a task's documents, documents whole."""
    kind = docs.schema[id_col].dataType
    schema = pa.schema([
        ("chunk", pa.int64()), ("ids", pa.list_(to_arrow_type(kind))), ("held", pa.list_(pa.bool_())),
        ("learns", pa.list_(pa.bool_())), ("lengths", pa.list_(pa.int32())), ("tokens", pa.binary()),
        ("trained", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary()),
        ("shapes", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, made, now = TaskContext.get().partitionId() << 32, 0, Chunk()
        for batch in batches:
            for number, text, learn, hold in zip(*batch.columns):
                now.add(number, text.as_py(), learn.as_py(), hold.as_py())
                if len(now.tokens) >= CHUNK:
                    yield now.row(first + made, schema)
                    made, now = made + 1, Chunk()
        if now.ids:
            yield now.row(first + made, schema)

    off = F.lit(False)
    return docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"), F.coalesce(learns, off),
                       F.coalesce(held, off)).mapInArrow(
        run, f"chunk long, ids array<{kind.simpleString()}>, held array<boolean>, "
             "learns array<boolean>, lengths array<int>, tokens binary, trained long, keys binary, "
             "counts binary, shapes binary")


# 2. Counts

def words_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per word of each chunk."""
    for batch in batches:
        for chunk, keys, counts, shapes in zip(*batch.columns):
            found = np.frombuffer(keys.as_py(), "i8")
            yield pa.RecordBatch.from_arrays([
                pa.array(found), pa.array(np.full(len(found), chunk.as_py())),
                pa.array(np.arange(len(found), dtype="i4")),
                pa.array(unpacked(counts.as_py()).astype("i4")),
                pa.array(unpacked(shapes.as_py()).astype("i4"))],
                names=["key", "chunk", "place", "n", "shape"])


def counted(cut: DataFrame, trained: int) -> DataFrame:
    """Per word of a chunk: ``c``, its count in all training tokens, and ``key`` if that is a class.

    ``first`` marks one of the rows of a word.
    """
    rows = cut.select("chunk", "keys", "counts", "shapes").mapInArrow(
        words_of, "key long, chunk long, place int, n int, shape int")
    word = Window.partitionBy("key")
    end = int(np.uint64(xxhash.xxh3_64_intdigest(END)).astype("i8"))
    own = (F.col("c") * OWN >= trained) | (F.col("key") == end)
    return rows.withColumns({"c": F.sum("n").over(word), "first": F.min("chunk").over(word)}).select(
        "chunk", "place", "shape", "c", (F.col("first") == F.col("chunk")).alias("first"),
        F.when(own & (F.col("c") > 0), F.col("key")).alias("key"))


@dataclass
class Classes:
    """Training tokens, distinct ones, and the same per class: own words first, then shapes."""

    tokens: int
    words: int
    own: np.ndarray         # sorted keys
    sizes: np.ndarray       # training tokens per class
    kinds: np.ndarray       # distinct ones

    def shares(self) -> np.ndarray:
        return (self.sizes + 1) / (self.sizes.sum() + len(self.sizes))


def classes_of(looked: DataFrame, trained: int) -> Classes:
    """Gathered on the driver: at most ``OWN + 1`` keys and ``SHAPES`` rows."""
    once = looked.filter("first and c > 0")
    own = sorted((r.key, r.c) for r in once.filter("key is not null").select("key", "c").collect())
    shapes = once.filter("key is null").groupBy("shape").agg(
        F.sum("c").alias("tokens"), F.count("*").alias("words")).collect()
    sizes, kinds = np.zeros(len(own) + SHAPES, "i8"), np.zeros(len(own) + SHAPES, "i8")
    sizes[:len(own)], kinds[:len(own)] = [c for _, c in own], 1
    for row in shapes:
        sizes[len(own) + row.shape], kinds[len(own) + row.shape] = row.tokens, row.words
    return Classes(trained, int(kinds.sum()), np.array([k for k, _ in own], "i8"), sizes, kinds)


def numbered(cut: DataFrame, looked: DataFrame, classes: Classes) -> DataFrame:
    """Per document: its counts, base score, what its classes leave open, and its classes."""
    kind = cut.schema["ids"].dataType.elementType
    shipped = cut.sparkSession.sparkContext.broadcast(classes)
    schema = pa.schema([
        ("doc_id", to_arrow_type(kind)), ("held_out", pa.bool_()), ("learns", pa.bool_()),
        ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()),
        ("inner", pa.float64()), ("classes", pa.binary())])

    def join(chunk: pa.Table, words: pa.Table) -> pa.Table:
        known = shipped.value
        row = {name: chunk.column(name)[0].as_py() for name in ("held", "learns", "lengths")}
        tokens = unpacked(chunk.column("tokens")[0].as_py())
        n = words.num_rows
        place = words.column("place").to_numpy()
        c, keys = np.zeros(n, "i8"), np.zeros(n, "i8")
        c[place] = words.column("c").to_numpy()
        named = np.zeros(n, bool)
        named[place] = words.column("key").is_valid().to_numpy()
        keys[place] = words.column("key").fill_null(0).to_numpy()
        shapes = unpacked(chunk.column("shapes")[0].as_py()).astype("i8") + len(known.own)
        number = np.where(named, np.searchsorted(known.own, keys), shapes)
        base = np.log10((c + 1) / (known.tokens + known.words + 1))
        inner = np.where(named, 0.0, np.log10(
            (c + 1) / (known.sizes[shapes] + known.kinds[shapes] + 1)))
        starts = np.cumsum([0, *row["lengths"]])[:-1]
        numbers = number.astype("<u2")[tokens]
        raw = memoryview(numbers.tobytes())
        return pa.Table.from_arrays([
            chunk.column("ids").combine_chunks().flatten().cast(schema.field("doc_id").type),
            pa.array(row["held"]), pa.array(row["learns"]), pa.array(row["lengths"], pa.int64()),
            pa.array(np.add.reduceat((c > 0)[tokens].astype("i8"), starts)),
            pa.array(np.add.reduceat(base[tokens], starts)),
            pa.array(np.add.reduceat(inner[tokens], starts)),
            pa.array([bytes(raw[2 * s:2 * (s + w)]) for s, w in zip(starts.tolist(), row["lengths"])],
                     pa.binary())], schema=schema)

    left = cut.select("chunk", "ids", "held", "learns", "lengths", "tokens", "shapes")
    right = looked.select("chunk", "place", "c", "key")
    return left.groupBy("chunk").cogroup(right.groupBy("chunk")).applyInArrow(
        join, f"doc_id {kind.simpleString()}, held_out boolean, learns boolean, n_tokens long, "
              "n_known long, base_score double, inner double, classes binary")


# 3. Baum-Welch

@dataclass
class Chain:
    """Start, share and transition probabilities of the states, and what they emit, a row a class."""

    start: np.ndarray
    share: np.ndarray
    moves: np.ndarray
    emits: np.ndarray

    def single(self) -> Chain:
        """In single precision, as the recursions of a round take it; their sums are in double."""
        return Chain(*[x.astype("f4") for x in (self.start, self.share, self.moves, self.emits)])


@dataclass
class Expected:
    """Expected counts: starts, moves and emissions."""

    start: np.ndarray
    moves: np.ndarray
    emits: np.ndarray

    def chain(self, shares: np.ndarray) -> Chain:
        start, moves = self.start + 1, self.moves + 1
        emitted = self.emits.sum(axis=0)
        return Chain(start / start.sum(), (emitted + 1) / (emitted + 1).sum(),
                     moves / moves.sum(axis=1, keepdims=True),
                     (self.emits + PRIOR * shares[:, None]) / (emitted + PRIOR))


def first_chain(shares: np.ndarray, states: int) -> Chain:
    """States that keep to themselves and emit all words, each with leanings of its own."""
    even = np.full(states, 1 / states)
    moves = np.full((states, states), 0.1 / max(states - 1, 1))
    np.fill_diagonal(moves, 0.9)
    emits = shares[:, None] * np.random.default_rng(7).uniform(0.5, 1.5, (len(shares), states))
    return Chain(even, even, moves / moves.sum(axis=1, keepdims=True), emits / emits.sum(axis=0))


def stretches(texts: list[np.ndarray]) -> list[tuple[np.ndarray, bool]]:
    """Training sequences: texts cut after every ``STRETCH`` tokens, and whether a text starts there."""
    return [(text[i:i + STRETCH], i == 0) for text in texts for i in range(0, len(text), STRETCH)]


@dataclass
class Block:
    """Sequences side by side, longest first: the tokens of all first steps, then of all second ones, ..."""

    tokens: np.ndarray
    on: np.ndarray          # step t has the first ``on[t]`` sequences
    begins: np.ndarray      # whether a text starts with the sequence


def blocks(texts: list[np.ndarray]) -> Iterator[Block]:
    """The stretches of the texts, ``GROUP`` tokens at a time."""
    pieces = sorted(stretches(texts), key=lambda p: -len(p[0]))
    at = 0
    while at < len(pieces):
        steps = len(pieces[at][0])
        some = pieces[at:at + max(1, GROUP // steps)]
        at += len(some)
        table = np.zeros((len(some), steps), "<u2")
        for i, (piece, _) in enumerate(some):
            table[i, :len(piece)] = piece
        on = np.searchsorted([-len(p) for p, _ in some], -np.arange(steps), "left")
        yield Block(np.concatenate([table[:n, t] for t, n in enumerate(on)]), on,
                    np.array([b for _, b in some]))


def expect(chain: Chain, texts: list[np.ndarray], total: Expected) -> None:
    """Add the expected counts of the texts to ``total``."""
    for block in blocks(texts):
        forward_backward(chain, block, total)


def forward_backward(chain: Chain, block: Block, total: Expected) -> None:
    """Scaled recursions over the sequences of a block, whose step t lies from ``at[t]`` to ``at[t + 1]``."""
    on, begins, flat = block.on, block.begins, block.tokens.astype("i8")
    at = np.concatenate(([0], np.cumsum(on)))
    steps, states = len(on), len(chain.start)
    seen, kind = chain.emits.take(flat, axis=0), chain.emits.dtype
    ahead, ones = np.empty_like(seen), np.ones(states, kind)
    now = np.where(begins[:, None], chain.start, chain.share)
    for t, n in enumerate(on):
        here = slice(at[t], at[t + 1])
        now = np.multiply(now if t == 0 else now[:n] @ chain.moves, seen[here], out=ahead[here])
        scale = (1 / (now @ ones)).repeat(states).reshape(n, states)
        now *= scale
        seen[here] *= scale
    back, after = np.ones((len(begins), states), kind), chain.moves.T.copy()
    moves = np.zeros((states, states))
    for t in range(steps - 1, 0, -1):
        here, n = slice(at[t], at[t + 1]), on[t]
        weighed = seen[here]
        weighed *= back[:n]
        ahead[here] *= back[:n]
        moves += ahead[at[t - 1]:at[t - 1] + n].T @ weighed
        np.matmul(weighed, after, out=back[:n])
    ahead[:len(begins)] *= back
    for z in range(states):
        total.emits[:, z] += np.bincount(flat, ahead[:, z], len(total.emits))
    total.moves += moves * chain.moves
    total.start += ahead[:len(begins)][begins].sum(axis=0, dtype="f8")


def nothing(n_classes: int, states: int) -> Expected:
    return Expected(np.zeros(states), np.zeros((states, states)), np.zeros((n_classes, states)))


def laid_out(texts: DataFrame) -> DataFrame:
    """The texts of ``classes`` as blocks, a row each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks([np.frombuffer(x.as_py(), "<u2") for x in batch.column(0)]):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x.tobytes()]) for x in (block.tokens, block.on.astype("<i4"), block.begins)],
                    names=["tokens", "on", "begins"])

    return texts.select("classes").mapInArrow(run, "tokens binary, on binary, begins binary")


def expected_counts(rows: DataFrame, chain: Chain) -> Expected:
    """One round's expected counts of all blocks, summed per class over all tasks."""
    shipped = rows.sparkSession.sparkContext.broadcast(chain.single())
    n_classes, states = chain.emits.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = nothing(n_classes, states), False
        for batch in batches:
            seen = seen or batch.num_rows > 0
            for row in zip(*batch.columns):
                block = Block(*[np.frombuffer(x.as_py(), kind) for x, kind in zip(row, ("<u2", "<i4", "?"))])
                forward_backward(shipped.value, block, total)
        if seen:
            table = np.rint(np.vstack((total.start, total.moves, total.emits)) * UNIT).astype("i8")
            used = np.flatnonzero(table.any(axis=1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(used)] + [pa.array(table[used, z]) for z in range(states)],
                names=["row", *(f"z{z}" for z in range(states))])

    names = [f"z{z}" for z in range(states)]
    sums = rows.mapInArrow(
        run, "row long, " + ", ".join(f"{n} long" for n in names)).groupBy("row").agg(
        *[F.sum(n).alias(n) for n in names]).toArrow()
    table = np.zeros((1 + states + n_classes, states))
    for z, n in enumerate(names):
        table[sums.column("row").to_numpy(), z] = sums.column(n).to_numpy() / UNIT
    return Expected(table[0], table[1:1 + states], table[1 + states:])


def train(texts: DataFrame, shares: np.ndarray, states: int = STATES) -> Chain:
    """Baum-Welch over ``texts`` (``classes`` as bytes), every round over all tokens.

    The texts are laid out as blocks once; the rounds read these.
    """
    chain = first_chain(shares, states)
    with Scratch(texts.sparkSession) as own:
        rows = own.settle(laid_out(texts), "blocks")
        if not rows.isEmpty():
            for _ in range(ROUNDS):
                chain = expected_counts(rows, chain).chain(shares)
    return chain


# 4. Scores

def log_likelihoods(chain: Chain, texts: list[np.ndarray]) -> np.ndarray:
    """log10 probability of each text's classes, by the scaled forward recursion over whole texts."""
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    lengths = np.array([len(texts[i]) for i in order])
    flat = np.concatenate([texts[i] for i in order] or [np.zeros(0, "u2")])
    starts = np.cumsum(lengths) - lengths
    on = np.searchsorted(-lengths, -np.arange(lengths.max(initial=0)), "left")
    found, now = np.zeros(len(order)), np.tile(chain.start, (len(order), 1))
    for t, n in enumerate(on):
        now = (now if t == 0 else now[:n] @ chain.moves) * chain.emits.take(flat[starts[:n] + t], axis=0)
        scale = now.sum(axis=1)
        now /= scale[:, None]
        found[:n] += np.log10(scale)
    out = np.zeros(len(order))
    out[order] = found
    return out


def score_texts(docs: DataFrame, learns: Column, held_out: Column, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    ``base_score`` is the add-one unigram log10 probability, ``score`` the hidden Markov model's.
    Trains when called; intermediate tables are written to the shared folder.
    """
    own = Scratch(docs.sparkSession)
    cut = own.settle(chunks(docs, id_col, text_col, learns, held_out), "chunks")
    trained = cut.agg(F.sum("trained")).first()[0] or 0
    looked = own.settle(counted(cut, trained), "counts")
    classes = classes_of(looked, trained)
    texts = own.settle(numbered(cut, looked, classes), "texts")
    own.drop("chunks", "counts")
    shipped = docs.sparkSession.sparkContext.broadcast(
        train(texts.filter("learns"), classes.shares()))
    kind = docs.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = log_likelihoods(
                shipped.value, [np.frombuffer(x.as_py(), "<u2") for x in batch.column("classes")])
            score = pa.array(found + batch.column("inner").to_numpy())
            yield pa.RecordBatch.from_arrays(
                [*batch.select(["doc_id", "held_out", "n_tokens", "n_known", "base_score"]).columns,
                 score], names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])

    return texts.select("doc_id", "held_out", "n_tokens", "n_known", "base_score", "inner",
                        "classes").mapInArrow(
        run, f"doc_id {kind.simpleString()}, held_out boolean, n_tokens long, n_known long, "
             "base_score double, score double").withColumn("train_tokens", F.lit(trained).cast("long"))
