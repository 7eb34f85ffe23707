"""Ids above 2 ** 53 beside null come back as they were, whatever else a row holds."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from quillwork.llm import bpe, editcount, langid, ngramjoin, packing, vectorjoin

VOCABULARY = bpe.read_vocabulary(public_tokenizers.path("byte_bpe_50k.json"))
IDS = [2 ** 53 + 1, None, 5, -2 ** 63, 2 ** 63 - 1]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, f"some words of text number {n} follow here", "en", n, "clash")
            for n, i in enumerate(IDS)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, c0 int, i string").coalesce(1)


def ids(df):
    return sorted({r.doc_id for r in df.select("doc_id").collect()}, key=str)


@pytest.mark.parametrize("name", ["pack", "encode", "decode", "counts", "language", "words", "join"])
def test_documents(spark, docs, name):
    chain = langid.fit(docs.select("text", "lang").toPandas())
    edits = docs.select("doc_id", F.lit(0).alias("step"), F.lit(1).alias("start"),
                        F.lit(1).alias("remove"), F.lit("x").alias("insert"))
    result = {
        "pack": lambda: packing.pack(docs, VOCABULARY),
        "encode": lambda: bpe.encode(docs, VOCABULARY),
        "decode": lambda: bpe.decode(bpe.encode(docs, VOCABULARY), VOCABULARY),
        "counts": lambda: editcount.edited_counts(docs, edits, VOCABULARY),
        "language": lambda: langid.languages_of(docs, chain),
        "words": lambda: langid.word_languages(docs, chain),
        "join": lambda: ngramjoin.ngram_groups(docs),
    }[name]()
    assert ids(result) == sorted(IDS, key=str)
    if name == "join":
        assert {r.component_id for r in result.collect()} <= set(IDS)


def test_vectors(spark):
    rows = [(i, [1.0, float(n), 0.0]) for n, i in enumerate(IDS)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").coalesce(1)
    got = vectorjoin.near_vectors(df).collect()
    assert sorted((r.vec_id for r in got), key=str) == sorted(IDS, key=str)
    assert {r.component_id for r in got} <= set(IDS)


@pytest.mark.parametrize("text", ["½ ²", "Ⅷ", "12 34", "…", "", None, "\u0301"])
def test_text_without_a_letter_has_no_language(spark, text):
    chain = langid.fit(spark.createDataFrame([("some words", "en"), ("ein wort", "de")],
                                             "text string, lang string").toPandas())
    assert chain.documents([text]) == [("und", 0.0)]


def test_vowel_signs_stay_in_their_word():
    assert langid.words_in("नमस्ते दुनिया") == ["नमस्ते", "दुनिया"]
