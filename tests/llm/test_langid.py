"""Forward-backward against enumeration; held-out accuracy; code-switched words; odd rows."""

import itertools

import numpy as np
import pandas as pd

from quillwork.llm import langid as G

SF = "/root/testdata/sf0.01"


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(3)
    sizes, k = np.array([3, 1, 0, 5, 2]), 3
    emissions, moves = rng.normal(size=(sizes.sum(), k)) * 3, rng.normal(size=(k, k))
    got, start = G.marginals(emissions, sizes, moves), 0
    for n in sizes:
        if n:
            total = np.zeros((n, k))
            for path in itertools.product(range(k), repeat=int(n)):
                score = sum(emissions[start + i, s] for i, s in enumerate(path))
                score += sum(moves[a, b] for a, b in zip(path, path[1:]))
                for i, s in enumerate(path):
                    total[i, s] += np.exp(score)
            assert np.allclose(got[start:start + n], total / total.sum(axis=1, keepdims=True))
        start += n


def test_held_out_accuracy_and_switching(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    chain = G.learn(docs)
    assert chain.languages == ["de", "en", "es", "fr"]
    found = {r.doc_id: r for r in G.languages_of(docs, chain).collect()}
    truth = docs.filter(G.fold(G.F.col("doc_id")) == 0).select("doc_id", "lang").collect()
    assert len(found) == docs.count() and len(truth) > 100
    assert np.mean([found[r.doc_id].lang_pred == r.lang for r in truth]) >= 0.97
    assert all(0 <= r.score <= 1 for r in found.values())
    english = [w for w in "the and thing that there with for this are from".split()] * 3
    french = [w for w in "le des élle dans pour réeux sur une pas les".split()] * 3
    mixed = spark.createDataFrame([(1, " ".join(english + french))], "doc_id long, text string")
    words = sorted(G.word_languages(mixed, chain).collect(), key=lambda r: r.place)
    langs = [r.lang for r in words]
    assert langs[:28].count("en") >= 26 and langs[32:].count("fr") >= 26


def test_odd_rows(spark):
    chain = G.fit(pd.DataFrame({"text": ["the cat", "le chat"] * 5, "lang": ["en", "fr"] * 5}))
    rows = [(1, None), (2, ""), (3, " 12 !! \n_"), (None, "the cat"), (4, "le chat"), (4, "le chat"),
            (5, "x" * 10_000), (6, "the cat " * 20_000)]
    docs = spark.createDataFrame([(i, t, 1, "c") for i, t in rows],
                                 "doc_id long, text string, score int, lang_pred string")
    found = sorted(map(tuple, G.languages_of(docs, chain).collect()), key=str)
    assert [r[1] for r in found if r[0] in (1, 2, 3)] == ["und"] * 3
    assert [r[2] for r in found if r[0] in (1, 2, 3)] == [0.0] * 3
    assert [r[1] for r in found if r[0] == 4] == ["fr", "fr"]
    assert {r[1] for r in found if r[0] in (None, 6)} == {"en"}
    assert G.languages_of(docs.limit(0), chain).count() == 0
    assert {r.lang_pred for r in G.languages_of(docs, G.Chain()).collect()} == {"und"}


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "text", None), (None, "text", "en"), (2, None, "en")],
                                 "doc_id long, text string, lang string")
    assert G.learn(docs).languages in ([], ["en"]) and G.fit(pd.DataFrame(
        {"text": ["", None], "lang": ["a", "b"]})).languages == []


def test_groups_of_texts_do_not_matter(monkeypatch):
    chain = G.fit(pd.DataFrame({"text": ["the cat sat", "le chat noir"] * 5, "lang": ["en", "fr"] * 5}))
    texts = ["the cat", "", "le chat noir est sat", None, "noir " * 50] * 4
    whole = chain.documents(texts)
    monkeypatch.setattr(G, "GROUP_WORDS", 3)
    monkeypatch.setattr(G, "KEPT_WORDS", 2)
    split = chain.documents(texts)
    assert [a[0] for a in whole] == [b[0] for b in split]
    assert np.allclose([a[1] for a in whole], [b[1] for b in split])


def made_up(spark, languages, rows, length):
    """Texts of languages with letters of their own."""
    rng = np.random.default_rng(4)

    def words(k, n):
        own = [chr(0x4E00 + 20 * k + j) for j in range(20)]
        return " ".join("".join(rng.choice(own, 4)) for _ in range(n))

    return spark.createDataFrame(
        [(k * 1000 + i, words(k, length), f"l{k:02}") for k in range(languages) for i in range(rows)],
        "doc_id long, text string, lang string")


def test_more_languages_than_a_full_budget_holds(spark):
    docs = made_up(spark, 40, 12, 30)
    chain = G.learn(docs)
    assert len(chain.languages) == 40
    found = {r.doc_id: r.lang_pred for r in G.languages_of(docs, chain).collect()}
    held = docs.filter(G.fold(G.F.col("doc_id")) == 0).collect()
    assert len(held) > 40 and np.mean([found[r.doc_id] == r.lang for r in held]) >= 0.97


def test_rows_are_shared_among_languages(spark, monkeypatch):
    monkeypatch.setattr(G, "LANGUAGES", 2)
    monkeypatch.setattr(G, "SAMPLE_ROWS", 10)
    sample = G.training_sample(made_up(spark, 5, 60, 5), "doc_id", "text", "lang")
    assert sample.groupby("lang").size().tolist() == [4] * 5


def test_a_language_of_long_texts_only(spark, monkeypatch):
    monkeypatch.setattr(G, "SAMPLE_LENGTH", 1000)
    docs = made_up(spark, 2, 10, 50).union(made_up(spark, 3, 10, 2000).filter("lang = 'l02'"))
    sample = G.training_sample(docs, "doc_id", "text", "lang")
    assert sample["text"].str.len().max() <= 1000
    assert G.fit(sample).languages == ["l00", "l01", "l02"]


def test_features_of_the_middle_of_long_words():
    a, b = ("".join(["\u4e00" * 20, middle * 30, "\u4e01" * 20]) for middle in "\u5000\u5001")
    assert set(G.feature_ids(a)) != set(G.feature_ids(b))
    assert len(G.feature_ids(a * 1000)) <= G.SPACE
