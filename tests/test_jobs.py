"""Command-line jobs end to end on tiny files."""

import json
import random
from datetime import date, timedelta

import pytest

from quillwork import jobs


def read_all(path):
    return [
        line for file in sorted(path.rglob("part-*"))
        if not file.name.endswith(".crc") for line in file.read_text().splitlines()
    ]


@pytest.fixture
def run(spark, monkeypatch):
    monkeypatch.setattr(jobs, "get_spark", lambda app: spark)
    return lambda *a: jobs.main([str(x) for x in a])


def test_usage(run):
    with pytest.raises(SystemExit, match="word-count"):
        run("no-such-job")


def test_word_count(run, tmp_path):
    (tmp_path / "in.txt").write_text("b, a\nB!\n")
    run("word-count", tmp_path / "in.txt", tmp_path / "out")
    assert read_all(tmp_path / "out") == ["a 1", "b 2"]


def test_pages(run, tmp_path):
    (tmp_path / "in.txt").write_text("20160801-12 en Popular_Page 10 2\n20160801-12 en Other 3 2\n")
    run("popular-pages", tmp_path / "in.txt", tmp_path / "out")
    assert read_all(tmp_path / "out") == ["20160801-12\t(10, 'Popular_Page')"]
    run("most-views", tmp_path / "in.txt", tmp_path / "max")
    assert read_all(tmp_path / "max") == ["20160801-12\t10"]
    (tmp_path / "pagecounts-20160801-120000").write_text("en Popular_Page 10 2\n")
    run("popular-pages-by-file", tmp_path / "pagecounts-20160801-120000", tmp_path / "byfile")
    assert [json.loads(x) for x in read_all(tmp_path / "byfile")] == [
        {"hour": "20160801-12", "title": "Popular_Page", "views": 10}
    ]


def test_comments(run, tmp_path):
    rows = [("e1", 4, "ann"), ("e1", 0, "bob"), ("x", 5, "cid")]
    text = "\n".join(json.dumps({"subreddit": s, "score": n, "author": a}) for s, n, a in rows)
    (tmp_path / "in.json").write_text(text)
    run("comment-averages", tmp_path / "in.json", tmp_path / "csv")
    assert sorted(read_all(tmp_path / "csv")) == ["e1,2.0", "x,5.0"]
    run("comment-averages", tmp_path / "in.json", tmp_path / "json", "json")
    assert sorted(read_all(tmp_path / "json")) == ['["e1",2.0]', '["x",5.0]']
    run("comment-split", tmp_path / "in.json", tmp_path / "split")
    assert len(read_all(tmp_path / "split" / "sign=positive")) == 1
    assert len(read_all(tmp_path / "split" / "sign=negative")) == 1
    run("relative-score", tmp_path / "in.json", tmp_path / "rel")
    assert read_all(tmp_path / "rel") == ["(2.0, 'ann')", "(1.0, 'cid')", "(0.0, 'bob')"]


def test_observations(run, tmp_path):
    (tmp_path / "in.csv").write_text(
        "CA1,20200101,TMAX,120,,,S,\nCA1,20200101,TMIN,20,,,S,\nUS1,20200101,TMAX,300,,,S,\n")
    run("maxima", tmp_path / "in.csv", tmp_path / "max")
    assert list((tmp_path / "max").glob("*.json.gz"))
    for form in ("frame", "sql"):
        run("temperature-range", tmp_path / "in.csv", tmp_path / form, form)
        assert read_all(tmp_path / form) == ["20200101,CA1,10.0,1"]


def test_logs(run, spark, tmp_path, capsys):
    line = '{} - - [01/Aug/1995:00:00:0{} -0400] "GET /a HTTP/1.0" 200 {}'
    text = [line.format(h, i, b) for i, (h, b) in enumerate([("a", 1), ("a", 2), ("b", 9), ("c", 4)])]
    (tmp_path / "in.log").write_text("\n".join(text))
    run("correlate-logs", tmp_path / "in.log")
    direct = capsys.readouterr().out
    run("load-logs", tmp_path / "in.log", "parquet", f"path={tmp_path / 'table'}")
    run("correlate-table", "parquet", f"path={tmp_path / 'table'}")
    assert capsys.readouterr().out == direct != ""


def test_graph(run, tmp_path):
    (tmp_path / "links.txt").write_text("ash: elm fir\nelm: oak\noak: yew\nyew: ash\n")
    run("shortest-path", tmp_path / "links.txt", tmp_path / "out", "ash", "yew")
    assert read_all(tmp_path / "out" / "path") == ["ash", "elm", "oak", "yew"]
    assert len(list((tmp_path / "out" / "rounds").glob("iter=*"))) == 3


@pytest.fixture
def star(tmp_path):
    files = {
        "customers": "c1,Ann,s,Vancouver,BC,V5K1A1\nc2,Bob,s,Prince George,BC,V2L1A1\nc3,Cid,s,Ottawa,ON,K1A0A1\n",
        "paymentmethods": "p1,c1,n,01/30,visa\np2,c2,n,01/30,debit\np3,c3,n,01/30,visa\n",
        "purchases": "x1,c1,p1,a1,2021-08-01,10.00\nx2,c2,p2,a2,2021-08-01,30.00\n"
                     "x3,c3,p3,a1,2021-08-02,50.00\nx4,c3,p3,a2,2021-08-09,70.00\n",
        "greater_vancouver_prefixes": "Vancouver,V5K\nVancouver,V5K\n",
        "amenities": '{"amenid": "a1", "amenity": "restaurant", "tags": {"cuisine": "Sushi;ramen"}}\n'
                     '{"amenid": "a2", "amenity": "cafe", "tags": {}}\n',
    }
    for name, text in files.items():
        (tmp_path / "star" / name).mkdir(parents=True)
        (tmp_path / "star" / name / "part.txt").write_text(text)
    return tmp_path / "star"


def test_warehouse_jobs(run, spark, star, tmp_path, capsys):
    run("average-by-method", star, tmp_path / "method")
    assert read_all(tmp_path / "method") == ["visa,60.0"]
    run("visitor-segments", star, tmp_path / "segments")
    assert read_all(tmp_path / "segments") == [
        "false,true,1,10.0,10.0", "true,false,1,30.0,30.0", "false,false,2,60.0,60.0"]
    run("average-at-tagged", star, tmp_path / "sushi")
    assert read_all(tmp_path / "sushi") == ["0,50.0", "1,10.0"]
    run("key-checks", star)
    assert "unique custid" in capsys.readouterr().out
    run("warehouse-load", star, "shop_job", tmp_path / "shop")
    assert {t: spark.table(f"shop_job.{t}").count() for t in ("customers", "purchases", "amenities")} == {
        "customers": 3, "purchases": 4, "amenities": 2}
    spark.sql("DROP SCHEMA shop_job CASCADE")


def test_retail_jobs(run, tmp_path):
    (tmp_path / "days" / "pdate=2021-08-01").mkdir(parents=True)
    (tmp_path / "days" / "pdate=2021-08-01" / "a.csv").write_text("x,c,p,a,2.00\ny,c,p,a,4.00\n")
    run("average-by-day", tmp_path / "days", tmp_path / "five")
    assert read_all(tmp_path / "five") == ["2021-08-01,3.0"]
    (tmp_path / "sales.csv").write_text("2021-12-25,Burnaby,5,2\n2021-12-25,Vancouver,7,0\n")
    (tmp_path / "holidays.csv").write_text("2021-12-25,Christmas\n")
    run("store-comparison", tmp_path / "sales.csv", tmp_path / "stores")
    assert read_all(tmp_path / "stores") == ["2021-12-25,5.0,7.0"]
    run("calendar-features", tmp_path / "sales.csv", tmp_path / "holidays.csv", tmp_path / "calendar")
    assert read_all(tmp_path / "calendar") == [
        "2021-12-25,Burnaby,5.0,2.5,true,true", "2021-12-25,Vancouver,7.0,,true,true"]


def test_rejects_job(run, tmp_path, capsys):
    (tmp_path / "in.txt").write_text("2016 en T 1 2\n2016 en T\n\n2016 en T x 1\n")
    run("page-view-rejects", tmp_path / "in.txt", tmp_path / "out")
    assert {json.loads(x)["raw"] for x in read_all(tmp_path / "out")} == {"2016 en T", "", "2016 en T x 1"}
    assert "number of fields" in capsys.readouterr().out


def test_a_long_report_is_written_whole(spark, tmp_path, monkeypatch, capsys):
    jobs._report(spark.range(3))
    assert "|2" in capsys.readouterr().out
    jobs._report(spark.range(1200), str(tmp_path / "long"))
    said = capsys.readouterr().out
    assert "1200 rows written to" in said
    assert len(read_all(next(tmp_path.glob("long-*")))) == 1200


def test_weather_models(run, tmp_path, capsys, monkeypatch):
    from quillwork.operators import learning

    real = learning.temperature_model
    monkeypatch.setattr(learning, "temperature_model", lambda lagged: real(lagged, max_iter=2))
    rows = [
        f"S{s},{date(2020, 1, 1) + timedelta(days=d)},{40 + s},{-120 + s},{10 * s},{(d * 7 + s) % 30}"
        for s in range(12) for d in range(12)
    ]
    (tmp_path / "in.csv").write_text("\n".join(rows))
    run("weather-train", tmp_path / "in.csv", tmp_path / "model")
    run("weather-test", tmp_path / "model", tmp_path / "in.csv")
    run("weather-tomorrow", tmp_path / "model", "S1", "2020-01-05", 41, -119, 10, 12)
    out = capsys.readouterr().out
    assert "without_yesterday" in out and "yesterday_tmax" in out and "2020-01-06" in out


def test_colours(run, tmp_path, capsys, monkeypatch):
    from quillwork.operators import colourspace, learning

    real, grid = learning.colour_model, colourspace.lab_grid
    monkeypatch.setattr(learning, "colour_model", lambda space, **more: real(space, max_iter=5, **more))
    monkeypatch.setattr(colourspace, "lab_grid", lambda s: grid(s, resolution=4))
    rng = random.Random(1)
    from quillwork.functions.fixed import PALETTE
    rows = [
        ",".join(str(max(0, min(255, c + rng.randrange(-9, 10)))) for c in rgb) + f",{word},good"
        for word, *rgb in PALETTE for _ in range(8)
    ]
    (tmp_path / "in.csv").write_text("\n".join(rows))
    run("colour-words", tmp_path / "in.csv", tmp_path / "out")
    assert len(read_all(tmp_path / "out" / "RGB")) == len(read_all(tmp_path / "out" / "LAB")) == 16
