"""Readers that keep what they reject."""

import gzip

import pytest
from pyspark.sql import types as T

from quillwork.sources import readers, tolerant

EVENT = T.StructType([T.StructField("value", T.LongType(), False), T.StructField("raw_name", T.StringType())])


def outcomes(rows):
    return sorted(((r.reject, r.raw) for r in tolerant.rejected(rows).collect()), key=str)


def test_json(spark, tmp_path):
    lines = ['{"value": 1, "raw_name": "x"}', '{"value": 2}', "", "   ", '{"value": 3', '["a"]', '"s"',
             '{"value": "many"}', '{"raw_name": "y"}', '{"value": null}', ' {"value": 4, "more": 1} ', "null"]
    with gzip.open(tmp_path / "a.json.gz", "wt") as f:
        f.write("\n".join(lines))
    rows = tolerant.json_lines(spark, str(tmp_path), EVENT)
    assert sorted(tuple(r) for r in tolerant.kept(rows).collect()) == [(1, "x"), (2, None), (4, None)]
    assert outcomes(rows) == sorted([
        ("blank line", ""), ("blank line", "   "), ("not JSON", '{"value": 3'), ("not an object", '["a"]'),
        ("not an object", '"s"'), ("wrong type", '{"value": "many"}'), ("no value", '{"raw_name": "y"}'),
        ("no value", '{"value": null}'), ("not an object", "null")], key=str)
    counts = {r.outcome: r.rows for r in tolerant.ledger(rows).collect()}
    assert counts == {"kept": 3, "blank line": 2, "not JSON": 1, "not an object": 3, "wrong type": 1,
                      "no value": 2}


def test_csv(spark, tmp_path):
    lines = ["1,x", '2,"a,b"', "", "3", "4,x,y", "many,x", ",x", '"5,open']
    (tmp_path / "a.csv").write_text("\n".join(lines))
    rows = tolerant.csv_rows(spark, str(tmp_path), EVENT)
    assert sorted(tuple(r) for r in tolerant.kept(rows).collect()) == [(1, "x"), (2, "a,b")]
    assert outcomes(rows) == sorted([
        ("blank line", ""), ("number of fields", "3"), ("number of fields", "4,x,y"),
        ("wrong type", "many,x"), ("no value", ",x"), ("number of fields", '"5,open')], key=str)


def test_page_views(spark, tmp_path):
    (tmp_path / "a").write_text('2020 en "Quoted 5 90\n2020 en T 7\n2020 en T\n\n2020 en T x 9\n2020 en T 1 z\n')
    rows = readers.page_views_with_rejects(spark, str(tmp_path))
    assert {tuple(r) for r in readers.page_views(spark, str(tmp_path)).collect()} == {
        ("2020", "en", '"Quoted', 5, 90), ("2020", "en", "T", 7, None), ("2020", "en", "T", 1, None)}
    assert outcomes(rows) == [("blank line", ""), ("number of fields", "2020 en T"),
                              ("wrong type", "2020 en T x 9")]


@pytest.mark.parametrize("lines", [["1,x", "many,x"], ["1,x"], ["bad"], []])
def test_one_scan_divides(spark, tmp_path, lines):
    (tmp_path / "a.csv").write_text("\n".join(lines))
    rows = tolerant.csv_rows(spark, str(tmp_path), EVENT)
    kept, rejected = tolerant.divided(rows)
    assert kept.columns == ["value", "raw_name"] and rejected.columns == ["raw", "reject"]
    assert kept.count() + rejected.count() == len(lines)
    assert kept.count() == sum(line == "1,x" for line in lines)
