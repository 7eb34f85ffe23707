"""Encoding, decoding and packing against the tokenizers library."""

import binascii

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from quillwork.llm import bpe, packing

PATH = public_tokenizers.path("byte_bpe_50k.json")
THEIRS = Tokenizer.from_file(PATH)
OURS = bpe.Encoder(bpe.read_vocabulary(PATH))
TEXTS = ["", " ", "a", "  two  blanks\n\n\nand lines ", "it's we'll I'D x's", "<|endoftext|>",
         "x<|endoftext|>y <|endoftext|><|endoftext|>", "\x1c\x1d\x85\xa0 odd blanks", "é" * 700,
         "½²Ⅷ٣ 日本語 😀👨‍👩‍👧 ﬁ", "x" * 4000, " " * 5000 + "x", "ab " * 3000]
SCHEMA = "doc_id long, text string, start string, length string"


def theirs(text):
    return THEIRS.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("text", TEXTS)
def test_known_texts(text):
    ids = OURS.encode(text)
    assert ids.tolist() == theirs(text)
    assert OURS.decode(ids) == THEIRS.decode(ids.tolist(), skip_special_tokens=False) == text


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=60))
def test_any_text(text):
    ids = OURS.encode(text).tolist()
    assert ids == theirs(text)
    assert OURS.decode(np.array(ids, "i8")) == THEIRS.decode(ids, skip_special_tokens=False)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.binary(min_size=2, max_size=8) | st.text("ethaino ", min_size=2, max_size=8)
                .map(str.encode), min_size=1, max_size=20))
def test_rows_of_trees_agree_with_one_tree(pieces):
    side_by_side = OURS.merge_side_by_side(pieces, 8)
    assert [np.frombuffer(x, "<u4").tolist() for x in side_by_side] == list(map(OURS.merge, pieces))


@given(st.lists(st.integers(0, 50), min_size=1, max_size=40), st.data())
def test_tree_root_is_the_minimum(leaves, data):
    tree = bpe.PairTree(list(leaves), 99)
    for _ in range(5):
        i = data.draw(st.integers(0, len(leaves) - 1))
        leaves[i] = data.draw(st.integers(0, 99))
        tree.put(i, leaves[i])
        assert tree.best() == min(leaves)


def test_bytes_that_are_no_text_are_replaced():
    ids = np.array([OURS.of_byte[0xC3], OURS.of_byte[0x28]])
    assert OURS.decode(ids) == THEIRS.decode(ids.tolist(), skip_special_tokens=False)


def test_full_cache_changes_nothing(monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_PIECES", 3)
    own = bpe.Encoder(bpe.read_vocabulary(PATH))
    got = list(own.encode_all([*TEXTS, None] * 2))
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == list(map(theirs, [*TEXTS, None] * 2))


def documents(spark):
    rows = [(i, t, "clash", None) for i, t in enumerate([*TEXTS, None])] + [(None, "a b", None, "c")]
    return spark.createDataFrame(rows + rows[:3], SCHEMA), rows + rows[:3]


def test_encode_and_decode_tables(spark):
    docs, rows = documents(spark)
    vocabulary = bpe.read_vocabulary(PATH)
    encoded = bpe.encode(docs, vocabulary)
    assert sorted((r.doc_id is None, r.doc_id, r.ids) for r in encoded.collect()) == sorted(
        (r[0] is None, r[0], theirs(r[1])) for r in rows)
    back = sorted(map(str, bpe.decode(encoded, vocabulary).collect()))
    assert back == sorted(f"Row(doc_id={r[0]}, text={(r[1] or '')!r})" for r in rows)
    assert bpe.encode(docs.limit(0), vocabulary).count() == 0


def test_pieces_are_binary_and_cover_each_document(spark):
    docs, rows = documents(spark)
    found = packing.pack(docs, bpe.read_vocabulary(PATH), longest=64).collect()
    assert len({r.sequence_id for r in found}) == len(found) and {r.offset for r in found} == {0}
    assert all(r.length == len(r.ids) <= 64 and r.length & (r.length - 1) == 0 for r in found)
    assert all(binascii.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in found)
    for number, text in enumerate([*TEXTS, None]):
        copies = 2 if number < 3 else 1
        own = sorted((r for r in found if r.doc_id == number), key=lambda r: r.start)
        whole = [*theirs(text), packing.END_ID]
        assert {r.doc_tokens for r in own} == {len(whole)}
        for piece in own:
            assert piece.ids == whole[piece.start:piece.start + piece.length]
        assert sum(r.length for r in own) == copies * len(whole)
        one = sorted({(r.start, r.length) for r in own})
        assert all(a + n == b for (a, n), (b, _) in zip(one, one[1:]))
    assert packing.pack(docs.limit(0), bpe.read_vocabulary(PATH)).count() == 0


@given(st.integers(1, 100_000))
def test_lengths_are_the_binary_digits(n):
    lengths = packing.piece_lengths(n)
    assert sum(lengths) == n and lengths == sorted(lengths, reverse=True)
    short = [x for x in lengths if x < packing.MAX_LENGTH]
    assert len(set(short)) == len(short)


def test_very_long_white_space(spark):
    text = "\n" * 300_000 + "end"
    fast = packing.fast_encoder(bpe.read_vocabulary(PATH))
    assert packing.token_ids(fast, OURS, text).tolist() == OURS.encode(text).tolist() == theirs(text)


def test_buckets_are_read_by_length(spark, tmp_path):
    docs, _ = documents(spark)
    pieces = packing.pack(docs, bpe.read_vocabulary(PATH))
    packing.write_buckets(pieces, str(tmp_path / "b"))
    read = spark.read.parquet(str(tmp_path / "b"))
    assert read.count() == pieces.count()
    assert all(r.length == len(r.ids) for r in read.filter("length = 64").collect())


def test_longest_must_be_a_power_of_two(spark):
    with pytest.raises(ValueError):
        packing.pack(spark.range(1).selectExpr("id doc_id", "'' text"), "", longest=1000)
