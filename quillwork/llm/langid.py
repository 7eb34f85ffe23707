"""Language of words and documents by a linear-chain conditional random field.

The chain's states are the languages.  A word's features are its affixes, inner n-grams and the
lexicons that hold it, hashed into a fixed space; transitions between the languages of neighbouring
words are learned with them, by gradient steps on forward-backward marginals.  Training sequences
are windows of labelled texts, some of them joined from two languages, so that the chain learns to
switch.  Forward-backward then gives each word of a text its marginals, step by step for many texts
at once; a document's language has the largest mean marginal, weighted by letters.

Only the model is fitted on a sample, but of every language: up to ``SAMPLE_ROWS`` texts each, or an
equal share of ``SAMPLE_ROWS * LANGUAGES`` where there are more than ``LANGUAGES`` of them, one at
least, chosen by a hash of the id.  Of a text above ``SAMPLE_LENGTH`` characters, stretches over its
whole length are taken.  The driver needs half a megabyte a language while it learns.  Every text is
labelled from end to end, where it lies; there is no shuffle.

Defined results: null text, and text without a letter, is ``und`` with score 0, as is all text when
nothing could be learned from; a null id or null language is never learned from; repeated rows get
equal answers; of languages with equal marginals the first by name is taken; an empty table gives an
empty table; other columns, whatever their names, are not looked at.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillwork.llm.arrow import Answer, map_rows
from quillwork.llm.excerpts import stretches
from quillwork.operators.sizing import join_measured, settle_measured

LANGUAGES = 32         # for which the budgets of rows and words hold in full; more languages share them
SAMPLE_ROWS = 400
SAMPLE_LENGTH = 20_000
WINDOW = 60            # words of a training window
WINDOWS = 4            # training windows of a text, at most
SPACE = 1 << 15        # hashed features
LEXICON = 4000         # words of a language's lexicon, at most
EPOCHS = 4
KEPT_WORDS = 400_000
GROUP_WORDS = 400_000  # words that are labelled at once
UNKNOWN = "und"

words_in = regex.compile(r"\p{L}[\p{L}\p{M}]*").findall


def feature_ids(word: str) -> list[int]:
    """Hashed affixes and n-grams of a whole word; of a long one each hashed feature once."""
    p = f"<{word}>"
    parts = {f"w{word}" if len(word) <= 12 else "long"}
    parts.update(f"p{p[:k]}" for k in (2, 3, 4))
    parts.update(f"s{p[-k:]}" for k in (2, 3, 4))
    inner = chain((p[i:i + 3] for i in range(len(p) - 2)), (c for c in word if c > "\x7f"))
    if len(word) > 40:
        return sorted({zlib.crc32(x.encode()) % SPACE for x in chain(parts, inner)})
    parts.update(inner)
    return [zlib.crc32(x.encode()) % SPACE for x in parts]


def shared_out(words: int, languages: int) -> int:
    """A number of words that are held at once, less where each needs more columns."""
    return max(1, words * LANGUAGES // max(LANGUAGES, languages))


def marginals(emissions: np.ndarray, sizes: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """Forward-backward over many sequences laid end to end.

    ``emissions`` has a row of log scores per word.  Sequences are taken longest first, so that the
    ones still running at a step are the first few.
    """
    order = np.argsort(-sizes, kind="stable")
    starts = (np.cumsum(sizes) - sizes)[order]
    lengths = sizes[order]
    steps = int(lengths[0]) if len(lengths) else 0
    running = np.searchsorted(-lengths, -np.arange(steps), side="left")
    score = np.exp(emissions - emissions.max(axis=1, keepdims=True))
    move = np.exp(transitions - transitions.max())
    forward, backward = np.empty_like(score), np.ones_like(score)
    if steps:
        at = starts
        forward[at] = score[at] / score[at].sum(axis=1, keepdims=True)
    for t in range(1, steps):
        at = starts[:running[t]] + t
        now = (forward[at - 1] @ move) * score[at]
        forward[at] = now / now.sum(axis=1, keepdims=True)
    for t in range(steps - 1, 0, -1):
        at = starts[:running[t]] + t
        now = (backward[at] * score[at]) @ move.T
        backward[at - 1] = now / now.sum(axis=1, keepdims=True)
    both = forward * backward
    return both / both.sum(axis=1, keepdims=True)


@dataclass
class Chain:
    """A trained chain; without languages it knows nothing."""

    languages: list[str] = field(default_factory=list)
    weights: np.ndarray = field(default_factory=lambda: np.zeros((SPACE, 0), "f4"))
    lexicons: dict[str, np.ndarray] = field(default_factory=dict)
    lexicon_weights: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    transitions: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))

    def __post_init__(self):
        self.kept: dict[str, int] = {}
        self.table = np.zeros((1024, len(self.languages)))

    def __reduce__(self):
        return Chain, (self.languages, self.weights, self.lexicons, self.lexicon_weights,
                       self.transitions)

    def score_words(self, words: list[str]) -> np.ndarray:
        """Log scores of words by their features and lexicons."""
        lists = [feature_ids(w) for w in words]
        ends = np.cumsum([len(x) for x in lists])
        flat = self.weights[np.fromiter((i for x in lists for i in x), "i8", ends[-1])]
        out = np.add.reduceat(flat.astype("f8"), np.r_[0, ends[:-1]])
        for row, word in enumerate(words):
            if (held := self.lexicons.get(word)) is not None:
                out[row] += held @ self.lexicon_weights
        return out

    def emissions(self, words: list[str]) -> np.ndarray:
        """Log scores of words; those of words seen before are kept."""
        new = list(set(words).difference(self.kept))
        if new:
            first = len(self.kept)
            while len(self.table) < first + len(new):
                self.table = np.concatenate((self.table, np.zeros_like(self.table)))
            for i in range(0, len(new), 50_000):
                part = new[i:i + 50_000]
                self.table[first + i:first + i + len(part)] = self.score_words(part)
            self.kept.update(zip(new, range(first, first + len(new))))
        return self.table[list(map(self.kept.__getitem__, words))]

    def label(self, groups: list[list[str]]) -> list[np.ndarray]:
        """Marginals per word (rows) and language (columns) of each list of words."""
        if len(self.kept) > shared_out(KEPT_WORDS, len(self.languages)):
            self.kept.clear()
        sizes = np.array([len(g) for g in groups], "i8")
        if not sizes.sum():
            return [np.zeros((0, len(self.languages)))] * len(groups)
        flat = self.emissions([w for g in groups for w in g])
        return np.split(marginals(flat, sizes, self.transitions), np.cumsum(sizes)[:-1])

    def documents(self, texts) -> list[tuple[str, float]]:
        """Language and score of whole texts."""
        out, group, size = [], [], 0
        for text in texts:
            group.append(words_in((text or "").lower()))
            size += len(group[-1])
            if size >= shared_out(GROUP_WORDS, len(self.languages)):
                out += self.verdicts(group)
                group, size = [], 0
        return out + self.verdicts(group)

    def verdicts(self, groups: list[list[str]]) -> list[tuple[str, float]]:
        if not self.languages:
            return [(UNKNOWN, 0.0)] * len(groups)
        out = []
        for words, shares in zip(groups, self.label(groups)):
            if not words:
                out.append((UNKNOWN, 0.0))
                continue
            letters = np.fromiter(map(len, words), "f8", len(words))
            mean = letters @ shares / letters.sum()
            best = int(mean.argmax())
            out.append((self.languages[best], float(min(1.0, mean[best]))))
        return out


def training_windows(texts: list[str], labels: list[int], rng) -> list[tuple[list[str], list[int]]]:
    """Windows of labelled texts; every third continues in another text's words."""
    windows = []
    for text, label in zip(texts, labels):
        words = words_in(text.lower())
        starts = rng.permutation(max(1, len(words) - WINDOW + 1))[:WINDOWS]
        windows += [(words[s:s + WINDOW], [label] * len(words[s:s + WINDOW])) for s in starts if words]
    out = []
    for i, (words, states) in enumerate(windows):
        if i % 3 == 0:
            other, theirs = windows[rng.integers(len(windows))]
            cut, half = len(words) // 2, len(other) // 2
            words, states = words[:cut] + other[half:], states[:cut] + theirs[half:]
        if words:
            out.append((words, states))
    return out


def lexicon_of(texts: list[str], labels: list[int], k: int) -> dict[str, np.ndarray]:
    """For frequent words of a language, the languages that have them as a usual word."""
    counts, total = defaultdict(Counter), np.zeros(k)
    for text, label in zip(texts, labels):
        words = words_in(text.lower())
        counts[label].update(words)
        total[label] += len(words)
    held: dict[str, np.ndarray] = {}
    for label, words in counts.items():
        for word, n in words.most_common(LEXICON):
            if n >= 5:
                held.setdefault(word, np.zeros(k, "f4"))[label] = 1
    return held


def fit(sample: pd.DataFrame, seed: int = 0) -> Chain:
    """A chain from rows ``text, lang``."""
    sample = sample[sample["text"].map(lambda t: bool(words_in(t or ""))).astype(bool)]
    languages = sorted(sample["lang"].unique())
    k = len(languages)
    if not k:
        return Chain()
    rng = np.random.default_rng(seed)
    texts, labels = sample["text"].tolist(), [languages.index(x) for x in sample["lang"]]
    lexicons = lexicon_of(texts, labels, k)
    model = Chain(languages, np.zeros((SPACE, k)), lexicons, np.zeros((k, k)), np.zeros((k, k)))
    windows = training_windows(texts, labels, rng)
    ids: dict[str, list[int]] = {}
    none = np.zeros(k, "f4")
    steps = {name: np.full_like(getattr(model, name), 1e-3)
             for name in ("weights", "lexicon_weights", "transitions")}

    def climb(name: str, gradient: np.ndarray, rate: float, rows=slice(None)) -> None:
        """An adaptive gradient step; rows that are left out have no gradient."""
        steps[name][rows] += gradient ** 2
        getattr(model, name)[rows] += rate * gradient / np.sqrt(steps[name][rows])

    for _ in range(EPOCHS):
        order = rng.permutation(len(windows))
        for i in range(0, len(order), 64):
            batch = [windows[j] for j in order[i:i + 64]]
            words = [w for ws, _ in batch for w in ws]
            states = np.array([s for _, ss in batch for s in ss])
            sizes = np.array([len(ws) for ws, _ in batch])
            for w in words:
                if w not in ids:
                    ids[w] = feature_ids(w)
            lists = [ids[w] for w in words]
            flat = np.array([x for ls in lists for x in ls])
            owner = np.repeat(np.arange(len(words)), [len(ls) for ls in lists])
            held = np.array([lexicons.get(w, none) for w in words])
            emissions = np.add.reduceat(model.weights[flat], np.r_[0, np.flatnonzero(np.diff(owner)) + 1])
            emissions = emissions + held @ model.lexicon_weights
            shares = marginals(emissions, sizes, model.transitions)
            wrong = np.eye(k)[states] - shares
            touched, places = np.unique(flat, return_inverse=True)
            gradient = np.zeros((len(touched), k))
            np.add.at(gradient, places, wrong[owner])
            inside = np.ones(len(words), bool)
            inside[np.cumsum(sizes) - 1] = False
            here = np.flatnonzero(inside)
            # Expected transitions, from neighbouring marginals and the current transitions.
            move = np.exp(model.transitions - model.transitions.max())
            reached = shares[here] @ move
            scaled = shares[here + 1] / (reached * shares[here + 1]).sum(axis=1, keepdims=True)
            joint = move * (shares[here].T @ scaled)
            seen = np.zeros((k, k))
            np.add.at(seen, (states[here], states[here + 1]), 1)
            climb("weights", gradient / len(batch), 0.1, touched)
            climb("lexicon_weights", held.T @ wrong / len(batch), 0.1)
            climb("transitions", (seen - joint) / len(batch), 0.05)
    model.weights = model.weights.astype("f4")
    return model


def fold(id_column: Column) -> Column:
    """The remainder that decides whether a document is held out (0) or may be learned from."""
    return F.crc32(id_column.cast("string")) % 5


def training_sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> pd.DataFrame:
    """Labelled texts outside the held-out fold, up to an equal share of the rows per language."""
    known = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                        F.col(lang_col).alias("lang")).filter(
        "id is not null and lang is not null and text is not null").filter(fold(F.col("id")) != 0)
    counts, size = settle_measured(known.groupBy("lang").agg(F.count("*").alias("n")))
    each = max(1, min(SAMPLE_ROWS, SAMPLE_ROWS * LANGUAGES // max(1, size[0])))
    # Some more rows than needed by chance, then exactly the first ones of each language by hash.
    place = F.pmod(F.xxhash64("id"), F.lit(1_000_000))
    chance = place * F.col("n") < 1_000_000 * (2 * each + 20)
    drawn = join_measured(known, counts, size, ["lang"]).filter(chance).select(
        "id", "lang", stretches(F.col("text"), F.lit(SAMPLE_LENGTH)).alias("text"), place.alias("place"))
    first = Window.partitionBy("lang").orderBy("place", "id", "text")
    found = drawn.withColumn("number", F.row_number().over(first)).filter(F.col("number") <= each)
    return found.select("place", "id", "lang", "text").toPandas().sort_values(
        ["place", "id", "text"]).drop(columns="place")


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang") -> Chain:
    return fit(training_sample(docs, id_col, text_col, lang_col))


def languages_of(docs: DataFrame, chain: Chain, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Per row: its id, ``lang_pred`` and ``score``."""
    shipped = docs.sparkSession.sparkContext.broadcast(chain)

    def verdicts(texts: list[str | None]) -> Answer:
        found = shipped.value.documents(texts)
        return None, {"lang_pred": [x for x, _ in found], "score": [s for _, s in found]}

    return map_rows(docs, id_col, [F.col(text_col)], "lang_pred string, score double", verdicts)


def word_languages(docs: DataFrame, chain: Chain, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """Per word of every text: its document, place, ``lang`` and marginal probability."""
    shipped = docs.sparkSession.sparkContext.broadcast(chain)

    def labels(texts: list[str | None]) -> Answer:
        own, rows = shipped.value, []
        out: dict[str, list] = {"place": [], "word": [], "lang": [], "probability": []}
        for row, text in enumerate(texts if own.languages else []):
            words = words_in((text or "").lower())
            shares = own.label([words])[0]
            rows += [row] * len(words)
            out["place"] += range(len(words))
            out["word"] += words
            out["lang"] += [own.languages[b] for b in shares.argmax(axis=1)] if words else []
            out["probability"] += shares.max(axis=1).tolist() if words else []
        return rows, out

    return map_rows(docs, id_col, [F.col(text_col)],
                    "place long, word string, lang string, probability double", labels)
