"""Compression distance: the model on planted words, its bounds, and odd rows."""

import random
from pathlib import Path

import numpy as np
import pandas as pd
import pytest

from quillwork.llm import toxicity as X

RNG = random.Random(1)
SYLLABLES = ["the", "an", "er", "on", "ti", "sh", "re", "ha", "in", "ed", "or", "st", "ly"]


def text(bad=()):
    words = ["".join(RNG.choices(SYLLABLES, k=RNG.randint(1, 4))) for _ in range(80)]
    for word in bad:
        words.insert(RNG.randrange(80), word)
    return " ".join(words)


def labelled(n):
    rows = [(text(), 0) for _ in range(n)]
    rows += [(text(RNG.choices(["grubling", "Vexwort", "smirch"], k=3)), 1) for _ in range(n // 3)]
    return pd.DataFrame([(t, y, i % 3 == 0) for i, (t, y) in enumerate(rows)],
                        columns=["text", "toxic", "part"]).astype({"part": int})


MODEL = X.fit(labelled(300))


def test_new_texts_are_told_apart():
    bad = [MODEL.score(text(["vexwort", "smirch"])) for _ in range(50)]
    good = [MODEL.score(text()) for _ in range(200)]
    assert sum(s >= X.CUT for s in bad) >= 49 and sum(s >= X.CUT for s in good) <= 2
    assert all(0 <= s <= 1 for s in bad + good)


def test_words_beyond_the_cache_score_alike(monkeypatch):
    texts = [text(["smirch"]) for _ in range(20)]
    before = [MODEL.gains(t) for t in texts]
    monkeypatch.setattr(X, "KEPT_WORDS", 5)
    assert [MODEL.gains(t) for t in texts] == before


def test_toxic_words_at_the_end_of_a_very_long_text():
    long = " ".join(text() for _ in range(300)) + " grubling vexwort smirch grubling"
    assert MODEL.score(long) >= X.CUT


def test_toxic_passages_in_texts_without_spaces():
    """Wherever they stand in a long unbroken text, and as many as there are."""
    letters = "".join(chr(c) for c in range(0x4E00, 0x4E00 + 3000))

    def unbroken(n, bad=()):
        signs = RNG.choices(letters, k=n)
        for word in bad:
            signs.insert(RNG.randrange(n), word)
        return "".join(signs)

    model = X.fit(pd.DataFrame(
        [(unbroken(60, RNG.choices(["grubling", "vexwort", "smirch"], k=3) if y else ()), y, i % 3 == 0)
         for i in range(300) for y in (0, 1)], columns=["text", "toxic", "part"]).astype({"part": int}))
    for n in (2_000, 20_000):
        found = [model.beyond(unbroken(n, ["grubling"])) for _ in range(20)]
        assert sum(x >= 1 for x in found) >= 19
        assert model.beyond(unbroken(n, ["grubling", "vexwort", "smirch"] * 3)) == X.COUNTED
        assert sum(model.beyond(unbroken(n)) for _ in range(20)) <= 2


def test_windows_cover_long_words():
    word = bytes(RNG.choices(b"abcdefghij", k=1001))
    cut = X.windows(word)
    assert max(map(len, cut)) == X.WORD_BYTES and X.windows(b"short") == [X.padded(b"short")]
    assert all(any(X.padded(word)[i:i + X.OVERLAP] in w for w in cut)
               for i in range(len(word) + 4 - X.OVERLAP))


def test_without_both_labels():
    for rows, score in (([], 0.0), ([("a b", 0, 0)], 0.0), ([("a b", 1, 0)], 1.0)):
        model = X.fit(pd.DataFrame(rows, columns=["text", "toxic", "part"]))
        assert model.score("anything") == model.score(None) == score


def test_segments_cover_chosen_grams():
    chosen = set(X.grams(b"badword")[1:3])
    assert X.segments(b"badword", chosen) == [b" badword"]
    assert X.segments(b"other", chosen) == []


def test_tables_with_odd_rows(spark):
    rows = labelled(200)
    docs = [(i, t, "clash") for i, t in enumerate(rows["text"])] + [
        (9001, None, ""), (9002, "", ""), (None, "grubling vexwort smirch", ""), (9003, "a", None)]
    table = spark.createDataFrame(docs + docs[:2], "doc_id long, text string, toxic string")
    labels = spark.createDataFrame(
        [(i, int(y)) for i, y in enumerate(rows["toxic"])] + [(None, 1), (9001, 1), (3, None), (5, 7)],
        "doc_id long, toxic int")
    model = X.learn(table, labels)
    found = X.with_scores(table, model).collect()
    assert len(found) == len(docs) + 2
    scores = {r.doc_id: r._toxicity for r in found}
    assert scores[9001] == scores[9002] == model.chances[0] and scores[None] >= X.CUT
    assert X.with_scores(table.limit(0), model).count() == 0


def test_held_out_rows_are_never_learned_from(spark):
    table = spark.createDataFrame([(i, "word") for i in range(200)], "doc_id long, text string")
    labels = table.selectExpr("doc_id", "1 as toxic")

    def usable(i):
        return X.crc_of(i) % 4 != 2

    sample = X.training_sample(table, labels, usable, usable, "doc_id", "text", "toxic")
    held = {r.doc_id for r in table.filter(X.crc_of(X.F.col("doc_id")) % 4 == 2).collect()}
    assert len(sample) and not held & set(sample["id"]) and len(held) + len(sample) == 200


def learned(spark, rows):
    table = spark.createDataFrame([(i, t) for i, t in enumerate(rows["text"])],
                                  "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(y)) for i, y in enumerate(rows["toxic"])],
                                   "doc_id long, toxic int")
    return X.learn(table, labels)


@pytest.mark.parametrize("label", [0, 1])
def test_one_huge_labelled_text(spark, monkeypatch, label):
    """It neither drops itself nor the other rows of its label."""
    monkeypatch.setattr(X, "SAMPLE_CHARS", 400_000)
    rows = labelled(300)
    first = [r.id for r in spark.range(len(rows)).orderBy(X.F.xxhash64("id")).collect()]
    at = next(i for i in first if rows["toxic"][i] == label and X.zlib.crc32(str(i).encode()) % 4 != 2)
    rows.loc[at, "text"] = " ".join([rows["text"][at]] * 1000)
    assert len(rows["text"][at]) > X.SAMPLE_CHARS // 2
    model = learned(spark, rows)
    assert model.score(text(["vexwort", "smirch"])) >= X.CUT > model.score(text())


def test_capped_labels_weigh_as_in_all_rows(spark, monkeypatch):
    rows = labelled(600)
    whole = learned(spark, rows)
    monkeypatch.setattr(X, "SAMPLE_ROWS", 100)
    capped = learned(spark, rows)
    assert abs(whole.chances[0] - capped.chances[0]) < 0.02
    few = pd.DataFrame([("same words here", y, p) for y in (0, 1) for p in (0, 1)] * 5,
                       columns=["text", "toxic", "part"])
    assert X.fit(few).score("x") == 0.5 and X.fit(few, {0: 90, 1: 10}).score("x") == 0.1


def test_equal_shares():
    assert X.equal_share([5, 1, 100], 1000) == 100
    assert X.equal_share([5, 1, 100, 200], 46) == 20


@pytest.mark.skipif(not Path("/root/testdata/sf0.1").exists(), reason="test tables are not here")
def test_held_out_accuracy(spark):
    """Of labelled texts never learned from, toxic ones score higher and good ones are left alone."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    held = docs.join(labels.filter(X.crc_of(X.F.col("doc_id")) % 4 == 2), "doc_id")
    scored = X.with_scores(held.select("toxic", "text"), X.learn(docs, labels)).collect()
    bad = np.array([r["_toxicity"] for r in scored if r.toxic == 1])
    good = np.array([r["_toxicity"] for r in scored if r.toxic == 0])
    assert len(bad) > 100 and len(good) > 800
    auc = np.mean([(good < b).mean() + (good == b).mean() / 2 for b in bad])
    assert auc > 0.85
    assert (good >= X.CUT).mean() < 0.04
    assert (bad >= X.CUT).mean() > 0.7
