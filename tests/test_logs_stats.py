import datetime as dt

import pytest

from quillwork.operators import logs, stats

LOG = [
    'mill.example.org - - [14/Mar/2011:09:30:41 +0100] "GET /maps/river.png HTTP/1.0" 200 5210',
    'quay.example.net - - [14/Mar/2011:09:30:47 +0100] "GET / HTTP/1.0" 304 0',
    'quay.example.net - - [14/Mar/2011:09:30:48 +0100] "GET /b HTTP/1.0" 200 734',
    'quay.example.net - - [14/Mar/2011:09:30:48 +0100] "GET /b HTTP/1.0" 404 -',
    'host - - [14/Mar/2011:09:30:48 +0100] "GET /two words HTTP/1.0" 200 1',
    'h - - [30/Feb/2011:09:30:48 +0100] "GET /bad-day HTTP/1.0" 200 5',
    "",
]


def test_parse(lines):
    out = sorted(map(tuple, logs.parse_access_log(lines(*LOG)).drop("id").collect()), key=lambda r: (r[0], r[1]))
    assert out == [
        ("h", 5, None, "/bad-day"),
        ("mill.example.org", 5210, dt.datetime(2011, 3, 14, 9, 30, 41), "/maps/river.png"),
        ("quay.example.net", 0, dt.datetime(2011, 3, 14, 9, 30, 47), "/"),
        ("quay.example.net", 734, dt.datetime(2011, 3, 14, 9, 30, 48), "/b"),
    ]


def test_ids(lines):
    twice = lines(LOG[0], LOG[0])
    assert logs.parse_access_log(twice).select("id").distinct().count() == 2
    assert logs.parse_access_log(twice, ids="hash").select("id").distinct().count() == 1


def test_quality(lines):
    assert tuple(logs.log_quality(lines(*LOG, None)).first()) == (4, 4)


def test_host_moments(lines):
    rows = logs.parse_access_log(lines(*LOG))
    got = logs.host_moments(rows).first().asDict()
    hosts = {"mill": (1, 5210), "quay": (2, 734), "h": (1, 5)}
    xs, ys = [v[0] for v in hosts.values()], [v[1] for v in hosts.values()]
    assert got["n"] == 3 and got["sum_x"] == sum(xs) and got["sum_y"] == sum(ys)
    assert got["sum_yy"] == sum(y * y for y in ys)
    assert got["sum_xy"] == sum(x * y for x, y in zip(xs, ys))
    assert got["r"] == pytest.approx(logs.host_correlation(rows).first()["r"])


@pytest.mark.parametrize("pairs, wanted", [
    ([(1.0, 5.0), (1.0, 6.0)], None),
    ([(0.1, float(i)) for i in range(50)], None),
    ([(1e9 + i, 2.0 * i) for i in range(50)], 1.0),
    ([(float(i), -3.0 * i) for i in range(50)] + [(None, 1.0)], -1.0),
    ([], None),
])
def test_correlation_of_constants_and_offsets(spark, pairs, wanted):
    df = spark.createDataFrame(pairs, "x double, y double")
    for form in (stats.correlation, stats.moments_with_correlation):
        got = form(df, "x", "y").first()
        assert got["r"] == (None if wanted is None else pytest.approx(wanted))
        assert got["r2"] == (None if wanted is None else pytest.approx(1.0))


def test_linear_fit(spark):
    df = spark.createDataFrame([(float(i), 3.0 * i - 2.0) for i in range(20)], "x double, y double")
    got = stats.linear_fit(df, "x", "y").first()
    assert got["slope_beta"] == pytest.approx(3.0) and got["intercept_alpha"] == pytest.approx(-2.0)


def test_metrics_match_spark_ml(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator

    df = spark.createDataFrame([(1.0, 1.5), (2.0, 1.0), (4.0, 4.5), (7.0, 6.0)], "label double, prediction double")
    got = stats.regression_metrics(df, "label", "prediction").first()
    for name in ("rmse", "r2"):
        assert got[name] == pytest.approx(RegressionEvaluator(labelCol="label", metricName=name).evaluate(df))
    words = spark.createDataFrame([(1.0, 1.0), (2.0, 1.0), (0.0, 0.0)], "label double, prediction double")
    wanted = MulticlassClassificationEvaluator(metricName="accuracy").evaluate(words)
    assert stats.accuracy(words, "label", "prediction").first()["accuracy"] == pytest.approx(wanted)
