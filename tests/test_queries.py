"""Every registered query against its SQL twin, and the shape of its plan."""

from pathlib import Path

import pytest

import __spark_entry__ as entry
from compare import connect, duck_rows, spark_rows
from quillwork.plans.inspect import plan_text
from quillwork.plans.oracle import ORACLE
from quillwork.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="test tables are not here")

MODELS = ["regression_model", "feature_importance", "classifier_model", "prediction_grid"]


@pytest.fixture(scope="module")
def duck():
    con = connect(SF)
    yield con
    con.close()


def test_every_query_but_the_models_has_a_twin():
    assert set(QUERIES) - set(ORACLE) == set(MODELS)
    assert set(ORACLE) <= set(QUERIES)


def test_all_are_registered():
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_result_and_plan(spark, duck, name):
    df = QUERIES[name](spark, SF)
    plan = plan_text(df)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "EvalPython" not in plan and "InPandas" not in plan
    assert spark_rows(df) == duck_rows(duck, ORACLE[name])


@pytest.mark.parametrize("name", ["feature_importance", "classifier_model"])
def test_models_return_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 1


def test_entry(spark):
    assert entry.entry(spark).columns == ["word", "count"]


def scan_of(plan, column):
    return next(b for b in plan.split("\n\n") if "Scan parquet" in b and column in b)


def test_scans_read_only_what_they_need(spark):
    plan = plan_text(QUERIES["star_avg_by_method"](spark, SF))
    scan = scan_of(plan, "l_orderkey")
    assert "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double>" in scan
    assert "IsNotNull(l_orderkey)" in scan


def test_filters_reach_the_scan(spark):
    plan = plan_text(QUERIES["filter_split"](spark, SF))
    assert "StringContains(c_mktsegment,E)" in plan


def test_window_form_prunes_before_the_shuffle(spark):
    plan = plan_text(QUERIES["argmax_ties_window"](spark, SF), "simple")
    below_exchange = plan.split("Exchange hashpartitioning")[1]
    assert "WindowGroupLimit" in below_exchange and "Partial" in below_exchange


def test_counts_are_combined_before_the_shuffle(spark):
    plan = plan_text(QUERIES["word_count"](spark, SF), "simple")
    assert "partial_count" in plan.split("Exchange hashpartitioning(word")[1]
