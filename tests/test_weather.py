import datetime as dt
import random
from collections import Counter
from itertools import product

from quillwork.operators import weather
from quillwork.plans.queries import QUERIES

SCHEMA = "station string, date string, observation string, value int, qflag string"


def test_maxima_extract(spark):
    rows = [
        ("CA1", "20200101", "TMAX", 123, None), ("CA1", "20200101", "TMIN", 1, None),
        ("CA2", "20200101", "TMAX", 50, "X"), ("US1", "20200101", "TMAX", 70, None),
    ]
    out = weather.maxima_extract(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [tuple(r) for r in out] == [("CA1", "20200101", 12.3)]


def brute_champions(rows):
    good = [r for r in rows if r[4] is None]
    ranges = [
        (a[1], a[0], (b[3] - a[3]) / 10)
        for a, b in product(good, good)
        if a[2] == "TMIN" and b[2] == "TMAX" and a[:2] == b[:2]
    ]
    best = {}
    for date, _, value in ranges:
        best[date] = max(value, best.get(date, value))
    return sorted(r for r in ranges if r[2] == best[r[0]])


def test_champions_match_the_pairwise_join(spark):
    rng = random.Random(5)
    rows = [
        (f"S{rng.randrange(4)}", f"2020010{rng.randrange(1, 4)}", rng.choice(["TMAX", "TMIN", "PRCP"]),
         rng.randrange(6), rng.choice([None, None, None, "X"]))
        for _ in range(300)
    ]
    rows += [("solo", "20200109", "TMAX", 9, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    wanted = brute_champions(rows)
    for form in (weather.daily_range_champions, weather.daily_range_champions_sql):
        out = form(df).select("date", "station", "range", "pairs")
        assert sorted(map(tuple, out.collect())) == sorted(
            (*row, wanted.count(row)) for row in set(wanted))
    assert len(wanted) > len(set(wanted)), "the fixture must hold repeated pairs"


def test_pairs_become_rows(spark):
    champions = spark.createDataFrame(
        [("20200101", "S1", 1.5, 25), ("20200101", "S2", 1.5, 10), ("20200102", "S1", 0.5, 1)],
        "date string, station string, range double, pairs long")
    out = weather.repeat_pairs(champions, piece=10)
    assert out.columns == ["date", "station", "range"]
    assert Counter(map(tuple, out.collect())) == {
        ("20200101", "S1", 1.5): 25, ("20200101", "S2", 1.5): 10, ("20200102", "S1", 0.5): 1}


def test_the_daily_range_queries_give_a_row_per_pair(spark, tmp_path):
    events = [
        (i, dt.datetime(2024, 1, 1, 0, i), 2, kind, value, '{"k": 1}')
        for i, (kind, value) in enumerate([("view", 1.0), ("view", 1.0), ("view", 3.0)]
                                          + [("click", 9.0)] * 3 + [("click", 8.0)])
    ]
    spark.createDataFrame(
        events, "event_id long, ts timestamp, user_id long, event_type string, value double, props string"
    ).write.parquet(str(tmp_path / "events.parquet"))
    for name in ("daily_range", "daily_range_sql"):
        rows = QUERIES[name](spark, str(tmp_path)).select("date", "station", "range").collect()
        assert list(map(tuple, rows)) == [("20240101", "CA2", 8.0)] * 6


def test_the_sql_form_leaves_views_alone(spark):
    spark.range(3).createOrReplaceTempView("observations")
    rows = [("S'1", "20200101", "it's", 1, None), ("S'1", "20200101", "TMAX", 4, None)]
    out = weather.daily_range_champions_sql(spark.createDataFrame(rows, SCHEMA), low="it's")
    assert [(r.station, r.range, r.pairs) for r in out.collect()] == [("S'1", 0.3, 1)]
    assert spark.table("observations").count() == 3
    spark.catalog.dropTempView("observations")


def test_previous_day_skips_gaps(spark):
    day = lambda d: dt.date(2021, 3, d)
    rows = [("a", day(1), 1.0), ("a", day(2), 2.0), ("a", day(4), 4.0), ("b", day(2), 9.0)]
    series = spark.createDataFrame(rows, "station string, date date, tmax double")
    for step in (weather.previous_day, weather.previous_day_window):
        out = step(series, ["station"], "date", "tmax", "before").select("station", "date", "tmax", "before")
        assert [tuple(r) for r in out.collect()] == [("a", day(2), 2.0, 1.0)]
