"""Periodic runs against a search for every period at every place."""

import hashlib
import random
import zlib
from pathlib import Path

import duckdb
import numpy as np
import pytest

from quillwork.llm import runs
from quillwork.llm.queries import op11_runs

SF = "/root/testdata/sf0.001"


def every_run(words, shortest):
    """(start, length, smallest period) of all maximal stretches of three periods, by start, period."""
    n, out, seen = len(words), [], set()
    for period in range(1, n // 3 + 1):
        i = 0
        while i < n - period:
            j = i
            while j < n - period and words[j] == words[j + period]:
                j += 1
            if j + period - i >= 3 * period and (i, j + period) not in seen:
                seen.add((i, j + period))
                if j + period - i >= shortest:
                    out.append((i, j + period - i, period))
            i = max(j, i) + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def some_texts(seed):
    rng = random.Random(seed)
    for _ in range(8):
        n, letters = rng.choice([0, 1, 5, 30, 100, 400]), rng.choice([1, 2, 3, 10])
        words = [b"%d" % rng.randrange(letters) for _ in range(n)]
        for _ in range(rng.randrange(4) if n else 0):
            a = rng.randrange(n)
            p = rng.randrange(1, max(2, (n - a) // 3))
            for i in range(a, min(n, a + rng.randrange(5 * p))):
                words[i] = words[a + (i - a) % p]
        yield words


@pytest.mark.parametrize("seed", range(60))
def test_any_texts(seed):
    texts = list(some_texts(seed))
    for shortest in (3, 24):
        assert runs.block_runs(texts, shortest) == [every_run(t, shortest) for t in texts]


def test_fibonacci_and_thue_morse_words():
    fib, thue = [b"a", b"ab"], b"a"
    while len(fib[-1]) < 1500:
        fib.append(fib[-1] + fib[-2])
    while len(thue) < 2048:
        thue += thue.translate(bytes.maketrans(b"ab", b"ba"))
    texts = [[b"%c" % c for c in text] for text in (fib[-1], thue)]
    assert runs.block_runs(texts, 3) == [every_run(t, 3) for t in texts]


def test_hashes_that_mislead(monkeypatch):
    # With all hashes equal every proposal is wrong, and the words themselves are searched.
    monkeypatch.setattr(runs, "mixed", lambda x: np.zeros(len(x), "u8"))
    words = [b"x", b"y"] * 20 + [b"z"] + [b"p", b"q", b"r"] * 10
    assert set(runs.block_runs([words], 24)[0]) <= set(every_run(words, 24))


def test_odd_rows(spark):
    text = " ".join(["a b c"] * 9)
    rows = [(2 ** 53 + 1, text, 1, "x"), (None, text, 2, None), (3, None, 3, "x"), (4, "", 4, "x"),
            (5, " \t\n ", 5, "x"), (5, "a\u00a0b " * 30, 6, "x"), (5, "a\u00a0b " * 30, 6, "x"),
            (6, "w " * 5000 + "v", 7, "x")]
    schema = "doc_id long, text string, i int, runs string"
    found = runs.periodic_runs(spark.createDataFrame(rows, schema)).collect()
    got = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in found]
    assert sorted(got, key=str) == sorted([
        (2 ** 53 + 1, 27, [(0, 27, 3)], "a b c"), (None, 27, [(0, 27, 3)], "a b c"),
        (3, 0, [], ""), (4, 0, [], ""), (5, 0, [], ""), (5, 30, [(0, 30, 1)], "a\u00a0b"),
        (5, 30, [(0, 30, 1)], "a\u00a0b"), (6, 5001, [(0, 5000, 1)], "w v")], key=str)
    assert runs.periodic_runs(spark.createDataFrame([], schema)).collect() == []


@pytest.mark.skipif(not Path(SF).exists(), reason="test tables are not here")
def test_query(spark):
    def sha(text):
        return hashlib.sha256(text).hexdigest()

    expected = []
    for number, text in duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet'").fetchall():
        words = (text or "").encode().split()
        n, h = len(words), zlib.crc32(str(number).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        numbered = {w: b"%d" % i for i, w in enumerate(dict.fromkeys(words))}
        found = every_run([numbered[w] for w in words], 24) if n < 1500 else None
        if found is None:  # too long for a plain search: from the operator itself, tested above
            found = runs.block_runs([words], 24)[0]
        best = None
        for r in found:
            if best is None or r[1] * best[2] > best[1] * r[2]:
                best = r
        gone = {i for s, length, p in found for i in range(s + p, s + length)}
        kept = [w for i, w in enumerate(words) if i not in gone]
        expected.append((number, len(found), *(best or (None,) * 3),
                         1000 * best[1] // best[2] if best else None,
                         sha(b"".join(b"%d,%d,%d\n" % r for r in found)), sha(b" ".join(kept))))
    got = op11_runs(spark, SF)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli",
                           "runs_sha256", "collapsed_sha256"]
    assert sorted(tuple(r) for r in got.collect()) == sorted(expected)
    assert any(row[1] for row in expected)
