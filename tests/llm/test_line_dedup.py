"""Line de-duplication against a dictionary of lines."""

from collections import defaultdict

import pandas as pd
import pytest
from hypothesis import given
from hypothesis import strategies as st

from quillwork.llm import linededup as L

SCHEMA = "doc_id long, text string, place string, _a int"
TEXTS = ["Menu \nfirst\n\nmenu", "\tmenu\nsecond\n", None, "", "menu", "MENU\r\n\x1cmenu\nünd\nÜND",
         "third\nfirst", "one line", "\n\n", "x\n" * 500 + "menu"]


def key(line):
    return line.encode().strip(L.BLANKS).lower()


def expected(rows, min_docs):
    docs = defaultdict(set)
    for row in rows:
        for line in (row[1] or "").split("\n"):
            docs[key(line)].add(row[:2])
    gone = {k for k, d in docs.items() if k and len(d) >= min_docs}
    out = []
    for number, text, *_ in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if key(x) not in gone]
        out.append((number, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


def result(df):
    return sorted(((r.doc_id, r.text, r._lines.n_lines, r._lines.n_dropped) for r in df.collect()),
                  key=str)


@pytest.mark.parametrize("min_docs", [1, 2, 3, 5, 50])
def test_against_brute_force(spark, min_docs):
    rows = [(i, t, "p", 1) for i, t in enumerate(TEXTS)]
    rows += [(None, "menu\nonly", None, None), (None, None, None, None), rows[0], rows[0]]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = L.dedup_lines(docs, min_docs)
    assert found.columns == [*docs.columns, "_lines"]
    assert result(found) == expected(rows, min_docs)


def test_a_line_in_most_documents_and_many_batches(spark):
    rows = [(i, f"common\nown {i}\ncommon" if i % 3 else f"own {i}\npair {i // 6}", "", 0)
            for i in range(2000)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        found = result(L.dedup_lines(spark.createDataFrame(rows, SCHEMA).repartition(8), 2))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert found == expected(rows, 2)


def test_first_occurrence_can_stay(spark):
    rows = [(i, "same\nsame\nown%d" % i, "", 0) for i in range(20)]
    found = L.dedup_lines(spark.createDataFrame(rows, SCHEMA), 10, keep_first=True).collect()
    assert sum(r.text.count("same") for r in found) == 1
    assert sum(r._lines.n_dropped for r in found) == 39


def test_empty_table(spark):
    assert L.dedup_lines(spark.createDataFrame([], SCHEMA)).count() == 0


def test_hot_line_is_split_between_partitions(spark):
    rows = [(i, "common", "", 0) for i in range(4000)]
    lines = L.line_rows(spark.createDataFrame(rows, SCHEMA))
    spread = lines.repartitionByRange(4, *L.LINE, *L.DOC).groupBy(
        L.F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in spread) < 2000


@given(st.lists(st.tuples(st.integers(0, 4), st.integers(0, 6)), max_size=60),
       st.integers(1, 7), st.integers(1, 4))
def test_streamed_runs_add_up(rows, batch, min_docs):
    """Cut sorted rows into partitions and batches anywhere: the sums over runs stay right."""
    rows = sorted(rows)
    table = pd.DataFrame([(k, k, d, d, 0) for k, d in rows],
                         columns=[*L.LINE, *L.DOC, "place"], dtype="i8")
    cut = len(rows) // 2
    while 0 < cut < len(rows) and rows[cut] == rows[cut - 1]:
        cut += 1
    docs = defaultdict(set)
    for k, d in rows:
        docs[k].add(d)
    sums = defaultdict(int)
    for part in (table[:cut], table[cut:]):
        batches = [part[i:i + batch] for i in range(0, len(part), batch)]
        for runs in L.run_counts(min_docs)(iter(batches)):
            for r in runs.itertuples():
                sums[r.line_a] += r.docs
    assert {k for k, n in sums.items() if n >= min_docs} == {
        k for k, d in docs.items() if len(d) >= min_docs}


@given(st.integers(1, 300), st.data())
def test_bitmaps_come_back(n, data):
    gone = data.draw(st.sets(st.integers(0, n - 1)))
    import numpy as np
    keep = L.kept_lines(L.keep_bitmap(n, np.array(sorted(gone), "i8")), n)
    assert set(np.flatnonzero(~keep).tolist()) == gone and len(keep) == n


def test_columns_named_like_the_results_stay(spark):
    rows = [(i, "common\nown %d" % i, "mine", i) for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _lines string, bitmap int")
    got = L.dedup_lines(docs)
    assert got.columns == ["doc_id", "text", "_lines", "bitmap", "__lines"]
    assert all(r["_lines"] == "mine" and r["__lines"].n_dropped == 1 and r.text == f"own {r.doc_id}"
               for r in got.collect())


def test_rows_of_one_id_with_other_texts_are_documents_of_their_own(spark):
    rows = [(1, f"common\nown {i}") for i in range(10)] + [(2, "rare")] * 12
    got = L.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r.text for r in got) == sorted([f"own {i}" for i in range(10)] + ["rare"] * 12)
