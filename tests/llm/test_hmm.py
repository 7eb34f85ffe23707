"""The hidden Markov model against enumerated state paths, and its counts against plain ones."""

import math
import zlib
from collections import Counter
from itertools import product
from pathlib import Path

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from quillwork.llm import hmm
from quillwork.llm.queries import op12_language_model

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, learn boolean, classes string, inner int"


def a_chain(states=3, classes=4, seed=1):
    rng = np.random.default_rng(seed)
    rows = [rng.dirichlet(np.ones(states)) for _ in range(states + 2)]
    return hmm.Chain(rows[0], rows[1], np.array(rows[2:]),
                     rng.dirichlet(np.ones(classes), states).T.copy())


def paths(chain, text, start):
    """Probability of each state path with the text."""
    for path in product(range(len(start)), repeat=len(text)):
        p = start[path[0]] * chain.emits[text[0], path[0]]
        for a, b, x in zip(path, path[1:], text[1:]):
            p *= chain.moves[a, b] * chain.emits[x, b]
        yield path, p


TEXTS = [np.array(t, "u2") for t in ([0], [1, 2, 3, 0], [3, 3, 1, 2, 0], [2, 0], [1, 1, 1, 0])]


def test_likelihood_is_the_sum_over_all_paths():
    chain = a_chain()
    expected = [math.log10(sum(p for _, p in paths(chain, t, chain.start))) for t in TEXTS]
    assert np.allclose(hmm.log_likelihoods(chain, TEXTS), expected, rtol=1e-12)
    assert hmm.log_likelihoods(chain, []).tolist() == []


@pytest.mark.parametrize("stretch", [256, 3])
def test_expected_counts_are_those_of_all_paths(monkeypatch, stretch):
    monkeypatch.setattr(hmm, "STRETCH", stretch)
    monkeypatch.setattr(hmm, "GROUP", 9)
    chain, total, want = a_chain(), hmm.nothing(4, 3), hmm.nothing(4, 3)
    hmm.expect(chain, TEXTS, total)
    for text, begins in hmm.stretches(TEXTS):
        weighed = list(paths(chain, text, chain.start if begins else chain.share))
        whole = sum(p for _, p in weighed)
        for path, p in weighed:
            want.start[path[0]] += p / whole * begins
            for a, b in zip(path, path[1:]):
                want.moves[a, b] += p / whole
            for z, x in zip(path, text):
                want.emits[x, z] += p / whole
    for name in ("start", "moves", "emits"):
        assert np.allclose(getattr(total, name), getattr(want, name), rtol=1e-10)


def test_a_round_never_lowers_the_likelihood():
    rng = np.random.default_rng(3)
    texts = [rng.integers(0, 4, 30).astype("u2") for _ in range(20)]
    chain, before = a_chain(), -np.inf
    for _ in range(8):
        now = hmm.log_likelihoods(chain, texts).sum()
        assert now >= before - 1e-9
        before, total = now, hmm.nothing(4, 3)
        hmm.expect(chain, texts, total)
        chain = hmm.Chain(total.start / total.start.sum(), chain.share,
                          total.moves / total.moves.sum(axis=1, keepdims=True),
                          total.emits / total.emits.sum(axis=0))


def test_every_round_takes_all_tokens(spark):
    """Copies and what lies beyond a stretch count in each round."""
    rng = np.random.default_rng(4)
    texts = [rng.integers(0, 5, n).astype("<u2") for n in (600, 3, 3, 19)]
    texts += [texts[0]] * 5
    shares = np.full(5, 0.2)
    want = hmm.first_chain(shares, 3)
    for _ in range(hmm.ROUNDS):
        total = hmm.nothing(5, 3)
        hmm.expect(want, texts, total)
        want = total.chain(shares)
    rows = [(i, bytearray(t.tobytes())) for i, t in enumerate(texts)]
    got = hmm.train(spark.createDataFrame(rows, "doc_id long, classes binary").repartition(3), shares, 3)
    for name in ("start", "share", "moves", "emits"):
        assert np.allclose(getattr(got, name), getattr(want, name), atol=1e-4)


def test_rounds_read_texts_laid_out_once(spark):
    """Cutting and sorting the texts is no part of a round, nor is reading them one by one."""
    rng = np.random.default_rng(5)
    rows = [(i, bytearray(rng.integers(0, 5, n).astype("<u2").tobytes())) for i, n in enumerate((300, 7, 1))]
    read = spark.sparkContext.accumulator(0)

    def noted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    texts = spark.createDataFrame(rows, "doc_id long, classes binary").mapInArrow(
        noted, "doc_id long, classes binary")
    hmm.train(texts, np.full(5, 0.2), 3)
    assert len(rows) <= read.value <= 2 * len(rows)


def test_blocks_hold_each_stretch_once(monkeypatch):
    monkeypatch.setattr(hmm, "STRETCH", 4)
    monkeypatch.setattr(hmm, "GROUP", 9)
    found = []
    for block in hmm.blocks(TEXTS):
        at = np.cumsum([0, *block.on])
        found += [([int(block.tokens[at[t] + i]) for t, n in enumerate(block.on) if i < n], bool(begins))
                  for i, begins in enumerate(block.begins)]
    assert sorted(found) == sorted((p.tolist(), b) for p, b in hmm.stretches(TEXTS))


def base(texts, learned):
    """(n_tokens, n_known, base score) of each text."""
    cut = lambda t: [*(t or "").encode().lower().split(), "end"]
    counts = Counter(w for t in learned for w in cut(t))
    n, v = sum(counts.values()), len(counts)
    return n, [(len(cut(t)), sum(counts[w] > 0 for w in cut(t)),
                sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in cut(t))) for t in texts]


ROWS = [(2 ** 53 + 1, "The the THE cat", True), (None, "a dog", True), (3, None, True), (4, "", False),
        (5, "unseen words here", False), (6, "the cat", None), (7, "É é", True),
        (8, "again", True), (8, "again", True), (9, "z" * 100_000 + " " + "w " * 30_000, True)]


def scored(spark, rows):
    docs = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA)
    return hmm.score_texts(docs, F.col("learn"), ~F.col("learn")).collect()


def test_odd_rows(spark):
    n, expected = base([r[1] for r in ROWS], [r[1] for r in ROWS if r[2]])
    got = sorted(scored(spark, ROWS), key=lambda r: str((r.doc_id, r.n_tokens)))
    want = sorted(zip(ROWS, expected), key=lambda r: str((r[0][0], r[1][0])))
    for row, ((number, _, learn), (tokens, known, score)) in zip(got, want, strict=True):
        assert (row.doc_id, row.n_tokens, row.n_known, row.train_tokens) == (number, tokens, known, n)
        assert row.held_out == (learn is False)
        assert row.base_score == pytest.approx(score, rel=1e-9)
        assert row.score < 0 and math.isfinite(row.score)


@pytest.mark.parametrize("rows", [[], [(1, "never learned", False)]], ids=["empty", "nothing learned"])
def test_little_to_learn(spark, rows):
    got = scored(spark, rows)
    assert [(r.doc_id, r.n_known, r.train_tokens, r.base_score) for r in got] == [
        (r[0], 0, 0, 0.0) for r in rows]


def test_many_chunks_give_the_same(spark, monkeypatch):
    one = {r.doc_id: r.base_score for r in scored(spark, ROWS)}
    monkeypatch.setattr(hmm, "CHUNK", 3)
    assert {r.doc_id: r.base_score for r in scored(spark, ROWS)} == pytest.approx(one)


def test_a_states_probabilities_add_up(spark):
    """Over the words of the corpus and one unseen word of each class."""
    classes = hmm.Classes(10, 4, np.array([5]), np.array([4, 3, 0, 3]), np.array([1, 2, 0, 1]))
    total = hmm.nothing(4, 3)
    total.emits += np.random.default_rng(0).random((4, 3))
    chain = total.chain(classes.shares())
    assert chain.emits.sum(axis=0) == pytest.approx(1)
    assert classes.shares().sum() == pytest.approx(1)


@pytest.mark.skipif(not Path(SF).exists(), reason="test tables are not here")
def test_query(spark):
    rows = duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet'").fetchall()
    held = [zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows]
    n, expected = base([t for _, t in rows], [t for (_, t), h in zip(rows, held) if not h])
    got = {r.doc_id: r for r in op12_language_model(spark, SF).collect()}
    assert len(got) == len(rows)
    gains = []
    for (number, _), out, (tokens, known, score) in zip(rows, held, expected):
        row = got[number]
        assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens) == (out, tokens, known, n)
        assert row.base_score == pytest.approx(score, rel=1e-9)
        if out:
            gains.append(row.score - row.base_score)
    assert sum(gains) > 0  # unseen documents are likelier than under single word shares
