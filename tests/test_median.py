"""The exact median against sorted lists."""

import math
import random
import statistics
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from quillwork.operators.median import summary_with_median

INF, NAN = math.inf, math.nan


def middle(values):
    """The mean of the two middle values, NaN being the largest."""
    ordered = sorted(values, key=lambda v: (isinstance(v, float) and math.isnan(v), v))
    n = len(ordered)
    return (float(ordered[(n - 1) // 2]) + float(ordered[n // 2])) / 2


def same(got, want):
    return got == want or (got is not None and math.isnan(got) and math.isnan(want))


def medians(spark, rows, kind):
    df = spark.createDataFrame(rows, f"k string, v {kind}")
    return {r.k: r for r in summary_with_median(df, ["k"], "v").collect()}


def check(spark, rows, kind):
    wanted = {}
    for k, v in rows:
        wanted.setdefault(k, [])
        if v is not None:
            wanted[k].append(v)
    got = medians(spark, rows, kind)
    assert set(got) == set(wanted)
    for k, values in wanted.items():
        assert got[k]["count"] == len(values)
        assert got[k].n_rows == sum(key == k for key, _ in rows)
        assert got[k].median is None if not values else same(got[k].median, middle(values)), k


def test_decimals(spark):
    rng = random.Random(11)
    rows = [(rng.choice("ab"), Decimal(rng.randrange(-900, 3000)) / 100) for _ in range(801)]
    rows += [("one", Decimal("4.25")), ("two", Decimal("1.00")), ("two", Decimal("2.00")), ("a", None)]
    rows += [("same", Decimal("7.00"))] * 50 + [("none", None)] * 3
    check(spark, rows, "decimal(7,2)")
    got = medians(spark, rows, "decimal(7,2)")["a"]
    assert got.total == sum(v for k, v in rows if k == "a" and v is not None)


def test_wide_decimals(spark):
    rng = random.Random(4)
    for kind, digits, scale in (("decimal(38,10)", 37, 10), ("decimal(38,0)", 38, 0), ("decimal(38,37)", 37, 37)):
        rows = [(rng.choice("ab"), Decimal(rng.randrange(-10 ** rng.randrange(1, digits), 10 ** rng.randrange(1, digits)))
                 .scaleb(-scale)) for _ in range(200)]
        check(spark, rows, kind)


@pytest.mark.parametrize("kind,values", [
    ("long", [-2 ** 63, 2 ** 63 - 1, 0, -1, 1, 2 ** 53 + 1, 2 ** 53, 5, 5]),
    ("int", list(range(-70000, 70000, 37))),
    ("short", [-3, 7, 7, 7]),
    ("double", [INF, -INF, 1.0, NAN, NAN, 2.5]),
    ("double", [-0.0, 0.0, 5e-324, -5e-324, 1e308]),
    ("double", [NAN, 1.0]), ("double", [INF, INF, 3.0]), ("double", [NAN] * 3),
    ("float", [0.1, -0.25, 7.5, INF]),
])
def test_odd_values(spark, kind, values):
    if kind == "float":
        import numpy as np
        values = [float(np.float32(v)) for v in values]
    rng = random.Random(1)
    for n in (len(values), len(values) - 1, 1):
        rows = [("a", v) for v in values[:n]] + [("b", v) for v in reversed(values)] + [("a", None)]
        rng.shuffle(rows)
        check(spark, rows, kind)


def test_skewed_doubles(spark):
    rng = random.Random(2)
    values = [rng.lognormvariate(0, 40) * rng.choice([-1, 1]) for _ in range(2001)]
    got = medians(spark, [("x", v) for v in values], "double")["x"]
    assert got.median == statistics.median(values)


def test_a_million_distinct_values_and_an_infinity_in_one_group(spark):
    df = spark.range(1_000_000).select(
        F.lit("a").alias("k"), F.when(F.col("id") == 7, F.lit(INF)).otherwise(
            F.sqrt(F.col("id").cast("double"))).alias("v"))
    few = spark.createDataFrame([("b", 1.0), (None, 4.0)], "k string, v double")
    got = {r.k: r.median for r in summary_with_median(df.union(few), ["k"], "v").collect()}
    assert got == {"a": (math.sqrt(500_000) + math.sqrt(500_001)) / 2, "b": 1.0}


def test_two_keys_and_no_rows(spark):
    df = spark.createDataFrame([(True, 1, 4), (True, 1, 8), (False, 1, 3), (True, None, 9)],
                               "p boolean, q int, v int")
    got = {(r.p, r.q): r.median for r in summary_with_median(df, ["p", "q"], "v").collect()}
    assert got == {(True, 1): 6.0, (False, 1): 3.0}
    assert summary_with_median(df.limit(0), ["p", "q"], "v").collect() == []


def test_rows_without_amount_count_but_do_not_lower_the_mean(spark):
    df = spark.createDataFrame([("a", 4), ("a", None), ("a", 8), ("b", None)], "k string, v int")
    got = {r.k: (r.n_rows, r["count"], r.total, r.median)
           for r in summary_with_median(df, ["k"], "v").collect()}
    assert got == {"a": (3, 2, 12, 6.0), "b": (1, 0, None, None)}
