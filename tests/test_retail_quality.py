import datetime as dt

from pyspark.sql import functions as F

from quillwork.operators import quality, retail

SAT, MON = dt.date(2021, 12, 25), dt.date(2021, 12, 27)


def test_store_comparison(spark):
    rows = [(SAT, "Burnaby", 5.0, 1.0), (SAT, "Vancouver", 7.0, 1.0), (MON, "Burnaby", 1.0, 1.0),
            (SAT, "Surrey", 9.0, 1.0)]
    sales = spark.createDataFrame(rows, "date date, store string, sales double, staff double")
    out = retail.store_comparison(sales)
    assert [tuple(r) for r in out.collect()] == [(SAT, 5.0, 7.0)]


def test_calendar_features(spark):
    sales = spark.createDataFrame(
        [(SAT, "Burnaby", 6.0, 2.0), (MON, "Burnaby", 6.0, 0.0)],
        "date date, store string, sales double, staff double")
    holidays = spark.createDataFrame([(SAT, "Christmas")], "date date, holiday string")
    out = sorted(tuple(r) for r in retail.calendar_features(sales, holidays).collect())
    assert out == [(SAT, "Burnaby", 6.0, 3.0, True, True), (MON, "Burnaby", 6.0, None, False, False)]


def test_key_checks(spark):
    tables = {
        "amenities": spark.createDataFrame([("a1", "cafe"), ("a2", None)], "amenid string, amenity string"),
        "customers": spark.createDataFrame([("c1",), ("c1",), ("c2",)], "custid string"),
        "paymentmethods": spark.createDataFrame([("p1", "c1"), ("p2", "c9"), ("p3", "c9")],
                                                "pmid string, custid string"),
        "purchases": spark.createDataFrame(
            [("x1", "c1", "p1", "a1"), ("x2", None, "p8", "a1")],
            "purchid string, custid string, pmid string, amenid string"),
    }
    found = {(r.table, r.check): (r.offenders, r.rows) for r in quality.check_keys(tables).collect()}
    assert found[("customers", "unique custid")] == (1, 2)
    assert found[("amenities", "not null amenity")] == (1, 1)
    assert found[("paymentmethods", "custid in customers.custid")] == (1, 2)
    assert found[("purchases", "custid in customers.custid")] == (0, 0)
    assert found[("purchases", "pmid in paymentmethods.pmid")] == (1, 1)
    assert found[("purchases", "unique purchid")] == (0, 0)


def test_a_date_with_two_holidays_keeps_its_sales_once(spark):
    sales = spark.createDataFrame(
        [("2020-07-01", "S", 10.0, 2), ("2020-07-02", "S", 4.0, 0)],
        "date string, store string, sales double, staff int").withColumn("date", F.to_date("date"))
    days = spark.createDataFrame(
        [("2020-07-01", "one"), ("2020-07-01", "two"), ("2020-07-02", None)],
        "date string, holiday string").withColumn("date", F.to_date("date"))
    got = retail.calendar_features(sales, days).orderBy("date").collect()
    assert [(r.sales_per_staff, r.is_holiday) for r in got] == [(5.0, True), (None, False)]


def test_null_keys_are_reported(spark):
    visits = spark.createDataFrame([(None, 1), (None, 1), (2, 1), (2, 1), (3, None)], "a int, b int")
    rule = {"visits": {"key": ["a", "b"], "required": ["b"], "references": {}}}
    found = {r.check: (r.offenders, r.rows) for r in quality.check_keys({"visits": visits}, rule).collect()}
    assert found == {"unique a,b": (1, 2), "not null a": (1, 2), "not null b": (1, 1)}
