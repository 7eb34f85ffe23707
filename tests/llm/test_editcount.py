"""Edited token counts against encoding the edited text anew."""

import random

import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from quillwork.llm import bpe, editcount as E
from quillwork.llm.packed import unpacked
from quillwork.plans.inspect import plan_text
from quillwork.session import Scratch, settle

PATH = public_tokenizers.path("byte_bpe_50k.json")
VOCABULARY = bpe.read_vocabulary(PATH)
OWN = bpe.encoder(VOCABULARY)


def apply(text, start, remove, insert):
    start = min(max(start, 0), len(text))
    end = min(start + max(remove, 0), len(text))
    return text[:start] + insert + text[end:]


def size(text):
    return len(OWN.encode(text))


PARTS = st.sampled_from(["a", "word", " ", "  ", "\n", "\n\n ", "'", "'re", "it's", "12", "<|", "|>",
                         "endoftext", "<|endoftext|>", "é", "!!", "\t", "日本", " the"])
TEXT = st.lists(PARTS, max_size=60).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(PARTS, max_size=250).map("".join),
       st.lists(st.tuples(st.integers(-3, 700), st.integers(-3, 60), TEXT), max_size=6))
def test_counts_follow_any_edits(text, edits):
    tree = E.CountTree(OWN, text)
    assert tree.tokens[1] == size(text)
    for start, remove, insert in edits:
        tree.edit(start, remove, insert)
        text = apply(text, start, remove, insert)
        assert tree.text() == text and tree.chars[1] == len(text)
        assert tree.tokens[1] == size(text)


def test_a_long_text_is_encoded_only_near_the_edit():
    rng = random.Random(2)
    text = " ".join(rng.choice("alpha beta gamma delta".split()) + str(i) for i in range(20_000))
    tree = E.CountTree(OWN, text)
    before = tree.encoded
    tree.edit(len(text) // 2, 7, "some new words")
    assert tree.encoded - before < 40
    assert tree.tokens[1] == size(apply(text, len(text) // 2, 7, "some new words"))


def test_table(spark):
    texts = ["one two three " * 40, "", None, "short", "x" * 3000]
    docs = [(i, t, "clash", 1) for i, t in enumerate(texts)] + [(None, "null id", "", 2)]
    edits = [(0, 1, 5, 3, "NEW"), (0, 0, 0, 4, None), (0, 2, 10**9, 5, " end"), (1, 0, 0, 0, "text"),
             (2, None, None, None, "abc"), (4, 0, 1500, 10, " "), (99, 0, 0, 0, "nobody")]
    table = spark.createDataFrame(docs, "doc_id long, text string, step string, start int")
    steps = spark.createDataFrame(
        edits, "doc_id long, step int, start long, remove long, insert string")
    found = {r.doc_id: r for r in E.edited_counts(table, steps, VOCABULARY).collect()}
    assert len(found) == 6 and found[None].n_edits == 0
    for number, text, *_ in docs:
        text = text or ""
        assert found[number].tokens_before == size(text)
        for e in sorted((e for e in edits if e[0] == number), key=lambda e: e[1] or 0):
            text = apply(text, e[2] or 0, e[3] or 0, e[4] or "")
        assert found[number].tokens_after == size(text)
    assert E.edited_counts(table.limit(0), steps, VOCABULARY).count() == 0


def test_derived_edits_of_the_test_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60)
    texts = {r.doc_id: r.text for r in docs.collect()}
    trees = E.build(docs, VOCABULARY).withColumn("edits", E.derived_edits())
    for r in trees.collect():
        for e in r.edits:
            texts[r.doc_id] = apply(texts[r.doc_id], e.start, e.remove, e.insert)
    found = {r.doc_id: r for r in E.edited(trees, VOCABULARY).collect()}
    assert {i: r.tokens_after for i, r in found.items()} == {i: size(t) for i, t in texts.items()}
    assert {i: r.text for i, r in found.items()} == texts
    assert all(r.n_edits == 3 and r.n_encoded_again < 60 for r in found.values())


def steps_of(spark, *edits):
    return spark.createDataFrame(edits, "doc_id long, step int, start long, remove long, insert string")


def test_a_second_batch_reads_and_encodes_edited_documents_only(spark, monkeypatch):
    texts = {i: " ".join(f"w{i}x{j}" for j in range(300)) for i in range(20)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    trees = settle(E.build(docs, VOCABULARY))
    for batch in ([(3, 0, 700, 9, "first batch"), (5, 0, 0, 0, "head ")],
                  [(3, 0, 1400, 2, " second"), (3, 1, 705, 3, "edited twice"), (7, 0, 10 ** 9, 0, " tail")]):
        changed = settle(E.edited(E.with_edits(trees, steps_of(spark, *batch)), VOCABULARY))
        rows = {r.doc_id: r for r in changed.collect()}
        assert set(rows) == {e[0] for e in batch}
        assert all(r.n_encoded_again < 30 for r in rows.values())
        trees = settle(E.updated(trees, changed))
        for number, _, start, remove, insert in batch:
            texts[number] = apply(texts[number], start, remove, insert)
    got = {r.doc_id: r for r in trees.collect()}
    assert len(got) == 20
    for number, text in texts.items():
        row = got[number]
        assert (row.text, row.n_tokens) == (text, size(text))
        tree = E.CountTree(OWN, row.text, unpacked(row.chars).astype("i8"), unpacked(row.tokens).astype("i8"))
        assert (tree.tokens[1], tree.chars[1], tree.encoded) == (size(text), len(text), 0)


def test_trees_bucketed_by_id_stay_where_they_are(spark):
    docs = spark.createDataFrame([(i, "a b c") for i in range(40)], "doc_id long, text string")
    with Scratch(spark) as scratch:
        trees = scratch.bucketed(E.build(docs, VOCABULARY), "trees", "doc_id")
        lists = E.with_edits(trees, steps_of(spark, *[(i, 0, 0, 0, "x") for i in range(30)]).hint("merge"))
        assert lists.count() == 30
        big = trees.join(lists.select("doc_id", F.lit(1).alias("one")).hint("merge"), "doc_id")
        assert plan_text(big, "simple").split("SortMergeJoin")[1].count("Exchange") <= 2


def test_rows_repeated_under_an_id_get_each_edit_once(spark):
    docs = spark.createDataFrame([(1, "one two"), (1, "three"), (1, "one two"), (2, "x")],
                                 "doc_id long, text string")
    edits = steps_of(spark, *[(1, 0, 0, 0, "new ")] * 3, (1, 1, 0, 1, ""))
    got = sorted((r.doc_id, r.n_edits, r.tokens_after) for r in
                 E.edited_counts(docs, edits, VOCABULARY).collect())
    assert got == sorted([(1, 2, size("ew one two"))] * 2 + [(1, 2, size("ew three")), (2, 0, size("x"))])
