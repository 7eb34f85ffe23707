"""The pipeline's stages against plain versions, one by one."""

import binascii

import numpy as np
import pytest

import corpus_pipeline as C
from quillwork.llm import bpe, ngramjoin, quality, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLEAN = [" ".join(f"{chr(97 + (i * 7 + j) % 26)}{i}w{j}" for j in range(40)) for i in range(60)]


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], SCHEMA)


@pytest.fixture
def sf_dir(spark, tmp_path):
    rows = [(i, t + "\nshared line") for i, t in enumerate(CLEAN)]
    rows += [(100 + i, CLEAN[i] + "\nshared line\nextra words here") for i in range(5)]
    rows += [(200, "too short"), (201, None), (202, "x " * 100), (None, CLEAN[0] + " nullid end of it")]
    rows += [(300 + i, " ".join(CLEAN[20 + i].split()[:30]) + " grubling vexwort smirch " * 3
              + f"own tail {i} z{i} y{i}") for i in range(20)]
    table(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(i, 0) for i in range(60)] + [(300 + i, 1) for i in range(20)]
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(
        str(tmp_path / "labels.parquet"))
    return str(tmp_path)


def test_stages_and_columns(spark, sf_dir):
    assert [n for n, _ in C.STAGES] == [
        "quality rules", "toxicity", "line dedup", "n-gram Jaccard join", "packing"]
    docs = C.table(spark, sf_dir, "documents")
    for _, stage in C.STAGES[:-1]:
        after = stage(spark, docs, sf_dir)
        assert after.columns == docs.columns
        assert [t for _, t in after.dtypes] == [t for _, t in docs.dtypes]
        docs = C.settle(after)
    assert docs.count() == 60


def test_quality_stage_keeps_what_the_rules_keep(spark, sf_dir):
    docs = C.table(spark, sf_dir, "documents")
    kept = {r.doc_id for r in C.quality_rules(spark, docs, sf_dir).collect()}
    assert kept == {r.doc_id for r in quality.judge(docs).filter("kept").collect()}
    assert not kept & {200, 201, 202} and set(range(60)) <= kept


def test_toxic_stage_drops_by_score(spark, sf_dir):
    docs = C.quality_rules(spark, C.table(spark, sf_dir, "documents"), sf_dir)
    kept = {r.doc_id for r in C.drop_toxic(spark, docs, sf_dir).collect()}
    model = toxicity.learn(docs, C.table(spark, sf_dir, "labels"))
    assert kept == {r.doc_id for r in docs.collect() if model.score(r.text) < toxicity.CUT}
    assert set(range(60)) <= kept and not kept & set(range(300, 320))


def test_near_copies_leave_one_of_each_group(spark):
    near = " ".join(f"a{i}" for i in range(60))
    rows = [(5, near), (3, near + " b"), (9, near), (7, "another text that stands alone here"),
            (None, near + " c"), (8, None), (6, " "), (None, "null id but no copy of anything at all"),
            (-4, "once again"), (-4, "once again"), (6, " ")]
    kept = C.drop_near_copies(spark, table(spark, rows), "").collect()
    assert sorted((r.doc_id for r in kept), key=str) == sorted([3, 6, 6, 7, 8, None, -4], key=str)


def test_packed_rows_hold_each_text(spark, sf_dir):
    found = C.run(spark, sf_dir).collect()
    own = bpe.encoder(bpe.read_vocabulary(C.VOCABULARY))
    pieces = {}
    for r in found:
        pieces.setdefault(r.doc_id, []).append((r.start, r.length, r.ids_crc32))
    assert set(pieces) == set(range(60))
    for number, parts in pieces.items():
        ids = np.append(own.encode(CLEAN[number]), 1).astype("<u4")
        at = 0
        for start, length, crc in sorted(parts):
            assert start == at and crc == binascii.crc32(ids[at:at + length].tobytes())
            at += length
        assert at == len(ids)


def test_no_two_texts_left_are_near(spark, sf_dir):
    docs = C.table(spark, sf_dir, "documents")
    for _, stage in C.STAGES[:-1]:
        docs = C.settle(stage(spark, docs, sf_dir))
    sets = [set(ngramjoin.shingles(r.text).tolist()) for r in docs.collect()]
    assert all(100 * len(a & b) < 80 * len(a | b)
               for i, a in enumerate(sets) for b in sets[:i] if a and b)
