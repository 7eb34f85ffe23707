"""Every registered query of the numbered operators: its SQL twin, or its columns and rows."""

from pathlib import Path

import pytest

import __spark_entry__ as entry
from compare import connect, duck_rows, spark_rows
from quillwork.llm.queries import ORACLE, QUERIES, VOCABULARY
from quillwork.plans.inspect import plan_text
from test_ngram_join import expected as brute_groups
from tokenizers import Tokenizer

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="test tables are not here")

# Columns with their types, of the queries that SQL cannot express.
COLUMNS = {
    "op1_packing": {"doc_id": "bigint", "start": "bigint", "length": "bigint", "ids_crc32": "bigint",
                    "doc_tokens": "bigint", "sequence_id": "bigint", "offset": "bigint"},
    "op2_language": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op4_ngram_join": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint"},
    "op5_toxicity": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op8_token_counts": {"doc_id": "bigint", "tokens_before": "bigint", "tokens_after": "bigint",
                         "n_edits": "bigint", "n_encoded_again": "bigint"},
    "op10_bpe": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string",
                 "decoded_sha256": "string"},
    "op11_runs": {"doc_id": "bigint", "n_runs": "bigint", "start": "bigint", "length": "bigint",
                  "period": "bigint", "exponent_milli": "bigint", "runs_sha256": "string",
                  "collapsed_sha256": "string"},
    "op12_language_model": {"doc_id": "bigint", "held_out": "boolean", "n_tokens": "bigint",
                            "n_known": "bigint", "train_tokens": "bigint", "base_score": "double",
                            "score": "double"},
}


@pytest.fixture(scope="module")
def duck():
    con = connect(SF)
    yield con
    con.close()


def test_all_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(ORACLE) <= set(entry.oracle_sql())
    assert set(QUERIES) == set(ORACLE) | set(COLUMNS)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_against_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    plan = plan_text(df)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if name in ("op7_url_filter", "op9_quality_rules"):
        assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
    assert spark_rows(df) == duck_rows(duck, ORACLE[name])


@pytest.fixture(scope="module")
def documents(duck):
    return duck.execute("select doc_id, text from documents").fetchall()


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns_and_rows(spark, documents, name):
    df = QUERIES[name](spark, SF)
    assert dict(df.dtypes) == COLUMNS[name]
    rows = df.collect()
    ids = sorted(i for i, _ in documents)
    assert sorted({r.doc_id for r in rows}) == ids
    if name == "op1_packing":
        for number in ids:
            own = sorted((r.start, r.length, r.doc_tokens) for r in rows if r.doc_id == number)
            assert [s for s, _, _ in own] == [sum(n for _, n, _ in own[:i]) for i in range(len(own))]
            assert all(total == sum(n for _, n, _ in own) for _, _, total in own)
    else:
        assert len(rows) == len(ids)
    if name in ("op8_token_counts", "op10_bpe"):
        theirs = Tokenizer.from_file(VOCABULARY)
        sizes = {i: len(theirs.encode(t or "", add_special_tokens=False).ids) for i, t in documents}
        assert {r.doc_id: r.n_tokens if name == "op10_bpe" else r.tokens_before for r in rows} == sizes
    if name == "op4_ngram_join":
        assert sorted(map(tuple, rows)) == sorted(brute_groups(documents))
