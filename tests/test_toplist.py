import gzip

from quillwork.operators import toplist
from quillwork.sources import readers

NOON, LATER = "20190512-120000", "20190512-150000"
VIEWS = "\n".join([
    f"{NOON} en Lighthouse 4 900", f"{NOON} en Canal_lock 31 4100", f"{NOON} en Main_Page 90 7000",
    f"{NOON} en Special:Recent 64 310", f"{NOON} de Leuchtturm 50 800", f"{NOON} en stub",
    f'{LATER} en "Heron 12 3', f"{LATER} en Ferry 12 3", "",
])


def views(spark, tmp_path):
    (tmp_path / "views").mkdir()
    (tmp_path / "views" / "part").write_text(VIEWS)
    return toplist.content_pages(readers.page_views(spark, str(tmp_path / "views")))


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_all_forms(spark, tmp_path):
    df = views(spark, tmp_path)
    key = ["hour"]
    one = [(NOON, 31, "Canal_lock"), (LATER, 12, "Ferry")]
    for form in (toplist.argmax_one, toplist.argmax_one_window):
        assert rows(form(df, key, "views", "title"), "hour", "views", "title") == one
    tied = sorted(one + [(LATER, 12, '"Heron')])
    for form in (toplist.argmax_ties, toplist.argmax_ties_window):
        assert rows(form(df, key, "views"), "hour", "views", "title") == tied
    assert rows(toplist.max_per_key(df, key, "views"), "hour", "views") == [
        (NOON, 31), (LATER, 12)
    ]


def test_ties_beyond_the_broadcast_bound(spark, tmp_path, monkeypatch):
    from quillwork.operators import sizing

    df = views(spark, tmp_path)
    wanted = rows(toplist.argmax_ties(df, ["hour"], "views"), "hour", "title")
    monkeypatch.setattr(sizing, "MAX_BROADCAST_ROWS", 0)
    assert rows(toplist.argmax_ties(df, ["hour"], "views"), "hour", "title") == wanted


def test_hour_from_file_name(spark, tmp_path):
    text = "en Canal_lock 31 4100\nen Main_Page 90 7000\nen \"Odd 3 4\nde Andere 50 9\n"
    with gzip.open(tmp_path / "pagecounts-20190512-120000.gz", "wt") as f:
        f.write(text)
    df = toplist.content_pages(readers.page_views_by_file(spark, str(tmp_path)))
    assert rows(df, "hour", "title", "views") == [
        ("20190512-12", '"Odd', 3), ("20190512-12", "Canal_lock", 31)
    ]


def test_null_titles_drop_out(spark):
    df = spark.createDataFrame([("en", None, 1), ("en", "A", 2)], "language string, title string, views int")
    assert toplist.content_pages(df).count() == 1
