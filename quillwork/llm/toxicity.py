"""Toxicity by compression distance.

Two zstandard dictionaries are trained: one on segments that toxic texts have and ordinary ones
lack, one on ordinary text.  A text is cut into windows of one word with its boundaries; a window is
compressed with either dictionary, and the gain is how many bytes shorter the toxic one makes it.
A word of more than ``WORD_BYTES``, as in scripts without spaces, is cut into windows that overlap
by ``OVERLAP``: zstandard reaches the dictionary from a bounded distance only, and longer windows
match inside themselves, which drowns the difference.  A passage inside an overlap counts in both
windows, in calibration as in scoring.  The threshold of
the gain, and the probability that belongs to a number of windows beyond it, are calibrated on
labelled rows that the dictionaries have not seen.

Only the model is fitted on a sample: labelled rows in the order of a hash of their id, bounded by
``SAMPLE_ROWS`` per label and ``SAMPLE_CHARS`` in all.  No row is dropped for its length: where a
label's texts exceed its half of the characters, the longest are reduced to equal shares, in
stretches over their whole length.  Calibration weighs the labels by their counts among all usable
rows.  Scoring reads every text from end to end, where it lies; there is no shuffle.

Defined results: null and empty texts have no window beyond the threshold and get the probability of
that; without labels of both kinds all texts get the share of toxic labels (0 without any); a null
id is never learned from; repeated rows get equal scores; an empty table gives an empty table.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillwork.llm.arrow import free_name
from quillwork.llm.excerpts import stretches
from quillwork.session import settle

SAMPLE_ROWS = 3000
SAMPLE_CHARS = 32_000_000
GRAM = 7                   # bytes of a contrasted gram, and of the shortest match
MIN_DOCS = 4               # toxic texts that must have a gram
MIN_CONTRAST = 4.5         # signed root of the likelihood ratio
MIN_RATIO = 4.0            # of its shares among toxic and ordinary texts
DICTIONARY = 6144
WORD_BYTES = 96            # of a padded word that is one window
OVERLAP = 48               # bytes that windows of a longer word share; passages up to that stay whole
COUNTED = 4                # numbers of windows from here on are one class
CUT = 0.3
KEPT_WORDS = 600_000
# Present in both dictionaries and before every window: a first match, so that zstandard does not
# store short windows uncompressed.
PRIMER = bytes(range(1, 9)) + bytes(range(14, 32))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").lower().encode().split()


def padded(word: bytes) -> bytes:
    return b"  " + word + b"  "


def windows(word: bytes) -> list[bytes]:
    """A padded word, or the overlapping windows of a long one from end to end."""
    p, step = padded(word), WORD_BYTES - OVERLAP
    return [p[i:i + WORD_BYTES] for i in range(0, max(1, len(p) - OVERLAP), step)]


def grams(word: bytes) -> list[bytes]:
    p = padded(word)
    return [p[i:i + GRAM] for i in range(max(1, len(p) - GRAM + 1))]


def document_counts(texts: list[str]) -> Counter:
    """In how many texts each gram stands in a context (word before, word after) seen first there.

    Copies share their contexts, so a copied text counts once.
    """
    counts, seen = Counter(), set()
    for text in texts:
        words = [b"", *words_of(text), b""]
        mine = set()
        for context in zip(words, words[1:], words[2:]):
            key = zlib.crc32(b" ".join(context)) << 32 | zlib.adler32(context[1])
            if key not in seen:
                seen.add(key)
                mine.update(grams(context[1]))
        counts.update(mine)
    return counts


def contrasting(toxic: list[str], ordinary: list[str]) -> set[bytes]:
    """Grams that toxic texts have far more often than chance."""
    ours, theirs = document_counts(toxic), document_counts(ordinary)
    n, m = max(1, len(toxic)), max(1, len(ordinary))
    out = set()
    for gram, a in ours.items():
        b = theirs.get(gram, 0)
        if a < MIN_DOCS or a / n < MIN_RATIO * (b + 0.5) / m:
            continue
        due = (a + b) * n / (n + m)
        ratio = a * math.log(a / due) + (b * math.log(b / (a + b - due)) if b else 0)
        if 2 * ratio >= MIN_CONTRAST ** 2:
            out.add(gram)
    return out


def segments(word: bytes, chosen: set[bytes]) -> list[bytes]:
    """The stretches of a padded word that chosen grams cover."""
    p, out, end = padded(word), [], -1
    for i, gram in enumerate(grams(word)):
        if gram in chosen:
            if i <= end:
                out[-1] = p[start:i + GRAM]
            else:
                start = i
                out.append(p[i:i + GRAM])
            end = i + 1
    return out


def train(samples: list[bytes]) -> bytes:
    """A trained dictionary; of samples too few to train on, the samples themselves."""
    try:
        return zstandard.train_dictionary(DICTIONARY, samples, level=3).as_bytes()
    except zstandard.ZstdError:
        return b"".join(dict.fromkeys(samples))[-DICTIONARY:]


@dataclass
class Model:
    toxic: bytes = b""
    ordinary: bytes = b""
    threshold: int = 1
    chances: list[float] = field(default_factory=lambda: [0.0] * (COUNTED + 1))

    def __post_init__(self):
        self.kept: dict[bytes, int] = {}
        # Fast matching from GRAM bytes on, at every place, with literals as they are.
        settings = zstandard.ZstdCompressionParameters(
            format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=False,
            write_checksum=False, write_dict_id=False, window_log=14, hash_log=14, chain_log=12,
            min_match=GRAM, target_length=1, strategy=zstandard.STRATEGY_FAST)
        self.compressors = []
        for content in (self.ordinary, self.toxic):
            shared = zstandard.ZstdCompressionDict(
                content + PRIMER, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            shared.precompute_compress(compression_params=settings)
            self.compressors.append(zstandard.ZstdCompressor(
                dict_data=shared, compression_params=settings))

    def __reduce__(self):
        return Model, (self.toxic, self.ordinary, self.threshold, self.chances)

    def gain(self, window: bytes) -> int:
        """Bytes by which the toxic dictionary makes a window shorter than the ordinary one."""
        ordinary, toxic = (len(c.compress(PRIMER + window)) for c in self.compressors)
        return ordinary - toxic

    def gains(self, text: str | None) -> list[int]:
        words, kept = words_of(text), self.kept
        if len(kept) >= KEPT_WORDS:
            kept.clear()
        out = list(map(kept.get, words))
        if None in out:
            for i, known in enumerate(out[:]):
                if known is None:
                    out[i], *more = map(self.gain, windows(words[i]))
                    out += more
                    if len(words[i]) <= 40:
                        kept[words[i]] = out[i]
        return out

    def beyond(self, text: str | None) -> int:
        """The number of windows that reach the threshold, up to ``COUNTED``."""
        return min(COUNTED, sum(g >= self.threshold for g in self.gains(text)))

    def score(self, text: str | None) -> float:
        return self.chances[self.beyond(text)]


def fit(sample: pd.DataFrame, totals: dict[int, int] | None = None) -> Model:
    """A model of rows ``text, toxic, part``; part 0 trains the dictionaries, part 1 calibrates.

    ``totals`` has the rows of each label that the sample stands for, if those are more.
    """
    def texts(label: int, part: int) -> list[str]:
        return sample["text"][(sample["toxic"] == label) & (sample["part"] == part)].tolist()

    sampled = [int((sample["toxic"] == label).sum()) for label in (1, 0)]
    stood_for = [max(n, (totals or {}).get(label, 0)) for n, label in zip(sampled, (1, 0))]
    share = stood_for[0] / sum(stood_for) if sum(stood_for) else 0.0
    toxic, ordinary = texts(1, 0), texts(0, 0)
    chosen = contrasting(toxic, ordinary) if toxic and ordinary else set()
    if not chosen:
        return Model(chances=[share] * (COUNTED + 1))
    found = Counter(s for t in toxic for w in words_of(t) for s in segments(w, chosen))
    pieces = [s for s, n in sorted(found.items()) for _ in range(min(n, 50))]
    order = np.random.default_rng(0).permutation(len(pieces))
    bundles = [b"".join(pieces[j] for j in order[i:i + 8]) for i in range(0, len(order), 8)]
    plain = [padded(b"  ".join(ws[i:i + 8])) for t in ordinary for ws in [words_of(t)]
             for i in range(0, len(ws), 40)]
    model = Model(train(bundles), train(plain))
    bad, good = (texts(label, 1) or texts(label, 0) for label in (1, 0))
    gains = [[np.sort(model.gains(t))[::-1][:COUNTED] for t in group] for group in (bad, good)]

    def wrong(threshold: int) -> float:
        low, high = (np.mean([not (g[:1] >= threshold).any() for g in group]) for group in gains)
        return low + (1 - high)

    model.threshold = min(range(1, 9), key=lambda t: (wrong(t), t))
    counts = [np.bincount([int((g >= model.threshold).sum()) for g in group], minlength=COUNTED + 1)
              for group in gains]
    # Each label weighs as in all usable rows; the weights leave the sum as it is.
    weights = np.divide(stood_for, sampled) * (sum(sampled) / sum(stood_for))
    # A number of windows that hardly any row has takes the chances of the numbers above it.
    above, chances = np.zeros(2), []
    for pair in np.column_stack(counts)[::-1]:
        above = pair * weights + above if pair.sum() < 3 else pair * weights
        chances.insert(0, (above[0] + share) / (above.sum() + 1))
    model.chances = np.maximum.accumulate(chances).tolist()
    return model


def equal_share(lengths: list[int], budget: int) -> int:
    """The most characters that each text may bring so that all of them fit the budget."""
    left = budget
    for i, n in enumerate(sorted(lengths)):
        if n * (len(lengths) - i) > left:
            return max(1, left // (len(lengths) - i))
        left -= n
    return max(lengths, default=1)


def known_labels(labels: DataFrame, usable, id_col: str, label_col: str) -> DataFrame:
    return labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1)).groupBy(
        F.col(id_col).alias("id")).agg(F.max(label_col).alias("toxic")).filter(usable(F.col("id")))


def label_totals(docs: DataFrame, labels: DataFrame, usable, id_col: str, text_col: str,
                 label_col: str) -> dict[int, int]:
    """The number of usable labelled documents of either label."""
    there = docs.filter(F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"))
    rows = known_labels(labels, usable, id_col, label_col).join(there, "id", "left_semi")
    return {int(r["toxic"]): r["count"] for r in rows.groupBy("toxic").count().collect()}


def training_sample(docs: DataFrame, labels: DataFrame, usable, part, id_col: str, text_col: str,
                    label_col: str) -> pd.DataFrame:
    """Labelled rows for :func:`fit`, bounded in rows and characters; gathered on the driver."""
    known = known_labels(labels, usable, id_col, label_col)
    chosen = [known.filter(F.col("toxic") == label).orderBy(F.xxhash64("id"), "id").limit(SAMPLE_ROWS)
              for label in (0, 1)]
    # At most 2 * SAMPLE_ROWS ids; of rows repeated under an id the least text is taken.
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter(
        F.col("text").isNotNull()).join(F.broadcast(settle(chosen[0].union(chosen[1]))), "id")
    one_each = texts.groupBy("id", "toxic").agg(F.min("text").alias("text"))
    lengths: dict[int, list[int]] = {0: [], 1: []}
    for toxic, n in one_each.select("toxic", F.length("text")).collect():
        lengths[int(toxic)].append(n)
    share = [F.lit(equal_share(lengths[label], SAMPLE_CHARS // 2)) for label in (0, 1)]
    return one_each.select(
        "id", stretches(F.col("text"), F.when(F.col("toxic") == 1, share[1]).otherwise(share[0]))
        .alias("text"), F.col("toxic").cast("int").alias("toxic"),
        part(F.col("id")).cast("int").alias("part")).toPandas().sort_values("id")


def crc_of(id_column):
    return F.crc32(id_column.cast("string"))


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", held_out_remainder: int = 2) -> Model:
    """A model of the labelled rows outside the held-out fold (crc32 of the id, modulo 4)."""
    def usable(i):
        return crc_of(i) % 4 != held_out_remainder

    def part(i):
        return crc_of(i) % 4 == (held_out_remainder + 1) % 4

    return fit(training_sample(docs, labels, usable, part, id_col, text_col, label_col),
               label_totals(docs, labels, usable, id_col, text_col, label_col))


def with_scores(docs: DataFrame, model: Model, text_col: str = "text",
                into: str = "_toxicity") -> DataFrame:
    """``docs`` with the score of each whole text as a column ``into``, with underscores before its name
    while ``docs`` has one of that name."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def scores(batches):
        own = shipped.value
        for texts in batches:
            yield pd.Series([own.score(t) for t in texts], dtype="f8")

    scores.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return docs.withColumn(free_name(docs, into), F.pandas_udf(scores, "double")(F.col(text_col)))
