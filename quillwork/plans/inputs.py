"""The test tables seen as the inputs of the jobs (whole tables, every row)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillwork.functions.calendar import hour_bucket
from quillwork.functions.fixed import MONTH_NAMES
from quillwork.operators.colourspace import nearest_word
from quillwork.schemas import PURCHASES_BY_DAY, TEST_TABLES
from quillwork.session import new_path
from quillwork.streaming.regression import encode_point


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TEST_TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def cents(amount: str) -> Column:
    """An amount with two decimals as a whole number, so that sums are exact."""
    return F.round(F.col(amount) * 100).cast("bigint")


def comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as comments: the segment as group, the balance around 4,400.00 as score."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_mktsegment").alias("subreddit"),
        (cents("c_acctbal") - 440_000).alias("score"),
        F.col("c_name").alias("author"),
    )


def page_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as page views."""
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        hour_bucket("ts").alias("hour"),
        F.when(kind == "error", "fr").otherwise("en").alias("language"),
        F.when(kind == "view", "Main_Page")
        .when(kind == "signup", "Special:Signup")
        .otherwise(F.concat_ws("_", kind, F.col("user_id").cast("string"))).alias("title"),
        F.floor("value").cast("bigint").alias("views"),
    )


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as weather readings: the user as station, the value in tenths."""
    user = F.col("user_id")
    flag = F.get_json_object("props", "$.k").cast("int")
    return table(spark, sf_dir, "events").select(
        F.concat(F.when(user % 2 == 0, "CA").otherwise("US"), user.cast("string"))
        .alias("station"),
        F.translate(F.col("ts").cast("date").cast("string"), "-", "").alias("date"),
        F.upper("event_type").alias("observation"),
        F.floor(F.col("value") * 10).cast("int").alias("value"),
        F.when(flag >= 95, "X").alias("qflag"),
    )


def daily_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean event value per user and day as a station's daily maximum."""
    daily = (
        table(spark, sf_dir, "events")
        .groupBy("user_id", F.col("ts").cast("date").alias("date"))
        .agg((F.sum(cents("value")) / F.count(F.lit(1)) / 100).alias("tmax"))
    )
    user = F.col("user_id")
    return daily.select(
        user.alias("station"), "date",
        (user % 60 + 20).cast("double").alias("latitude"),
        (user % 120 - 60).cast("double").alias("longitude"),
        (user * 7 % 900).cast("double").alias("elevation"),
        "tmax",
    )


def gappy_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The series with gaps: some stations without elevation, some days without a maximum."""
    series = daily_series(spark, sf_dir)
    return series.withColumns({
        "elevation": F.when(F.col("station") % 13 != 4, F.col("elevation")),
        "tmax": F.when((F.col("station") + F.dayofmonth("date")) % 17 != 3, F.col("tmax"))})


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as sales: the priority as store, a staff count that may be zero."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderdate").cast("date").alias("date"),
        F.col("o_orderpriority").alias("store"),
        F.col("o_totalprice").alias("sales"),
        (F.col("o_custkey") % 7).alias("staff"),
    )


def holidays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixed-date holidays on which orders were placed."""
    day = F.date_format("date", "MM-dd")
    name = F.when(day == "01-01", "New Year").when(day == "12-25", "Christmas")
    return (
        table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("date"))
        .distinct().withColumn("holiday", name).filter("holiday is not null")
    )


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as access-log lines; errors have no byte count."""
    ts = F.col("ts")
    stamp = F.concat(
        F.lpad(F.dayofmonth(ts).cast("string"), 2, "0"), F.lit("/"),
        F.element_at(F.array(*[F.lit(m) for m in MONTH_NAMES]), F.month(ts)), F.lit("/"),
        F.year(ts).cast("string"), F.lit(":"), F.substring(ts.cast("string"), 12, 8),
    )
    size = F.when(F.col("event_type") == "error", "-").otherwise(cents("value").cast("string"))
    text = lambda c: F.col(c).cast("string")
    line = F.concat(
        F.lit("user"), text("user_id"), F.lit(".example.com - - ["), stamp,
        F.lit(' -0400] "GET /'), F.col("event_type"), F.lit("/"), text("event_id"),
        F.lit(' HTTP/1.0" 200 '), size,
    )
    return table(spark, sf_dir, "events").select(line.alias("value"))


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as points."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("x"), F.col("value").alias("y")
    )


def point_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events read as a stream of binary ``"x y"`` messages."""
    events = (
        spark.readStream.schema(TEST_TABLES["events"])
        .option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    )
    return events.select(encode_point(F.col("event_id"), F.col("value")).alias("value"))


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as purchases by payment method id."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("pmid"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("amount"),
    )


def payment_methods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as payment methods."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("pmid"),
        F.col("o_custkey").alias("custid"),
        F.col("o_orderpriority").alias("mtype"),
    )


def purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their customer."""
    items = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"),
        F.col("l_partkey").alias("amenid"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("amount"),
    )
    owners = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("custid"))
    return items.join(owners, "o_orderkey").drop("o_orderkey")


def daily_purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as dated purchases."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderdate").cast("date").alias("pdate"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("amount"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with a province by region and a postal code by nation and segment."""
    region = F.col("n_regionkey")
    nations = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"),
        F.when(region == 1, "BC").when(region == 2, "ON").otherwise("QC").alias("province"),
    )
    return table(spark, sf_dir, "customer").join(nations, "c_nationkey").select(
        F.col("c_custkey").alias("custid"),
        "province",
        F.concat(
            F.lpad(F.col("c_nationkey").cast("string"), 2, "0"),
            F.substring("c_mktsegment", 1, 1), F.substring("c_name", 16, 3),
        ).alias("postalcode"),
    )


def postal_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prefixes of the area, once per supplier there, so with repeats."""
    nations = table(spark, sf_dir, "nation").filter("n_regionkey = 1")
    nations = nations.select(F.col("n_nationkey").alias("s_nationkey"))
    return table(spark, sf_dir, "supplier").join(nations, "s_nationkey").select(
        F.concat(F.lpad(F.col("s_nationkey").cast("string"), 2, "0"), F.lit("M"))
        .alias("pcprefix")
    )


def amenities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as amenities with JSON tags; some have no cuisine tag."""
    tagged = F.to_json(F.struct(F.col("p_name").alias("cuisine"), F.col("p_brand").alias("brand")))
    bare = F.to_json(F.struct(F.col("p_brand").alias("brand")))
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("amenid"),
        F.col("p_type").alias("amenity"),
        F.when(F.col("p_brand") == "Brand#1", bare).otherwise(tagged).alias("tags"),
    )


def trade_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A directed graph: customer to part bought, part to supplier, supplier to nation, nation
    to customer."""
    named = lambda letter, c: F.concat(F.lit(letter), F.col(c).cast("string"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey")
    bought = items.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        named("c", "o_custkey").alias("src"), named("p", "l_partkey").alias("dst")
    )
    supplied = items.select(named("p", "l_partkey").alias("src"), named("s", "l_suppkey").alias("dst"))
    based = table(spark, sf_dir, "supplier").select(
        named("s", "s_suppkey").alias("src"), named("n", "s_nationkey").alias("dst")
    )
    home = table(spark, sf_dir, "customer").select(
        named("n", "c_nationkey").alias("src"), named("c", "c_custkey").alias("dst")
    )
    return bought.unionByName(supplied).unionByName(based).unionByName(home)


def colours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as colours spread over the RGB cube, labelled with the nearest palette word."""
    key = F.col("p_partkey")
    rgb = table(spark, sf_dir, "part").select(
        key.alias("p_partkey"),
        (key * 37 % 256).cast("int").alias("R"),
        (key * 101 % 256).cast("int").alias("G"),
        (key * 197 % 251).cast("int").alias("B"),
    )
    return nearest_word(rgb)


def lab_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as points of LAB space."""
    key = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        (key % 101).cast("double").alias("labL"),
        (key * 13 % 201 - 100).cast("double").alias("labA"),
        (key * 29 % 201 - 100).cast("double").alias("labB"),
    )


# The external table's columns, wide enough for the amounts of the test tables.
DAILY_COLUMNS = T.StructType([T.StructField(f.name, T.DecimalType(12, 2) if f.name == "amount" else f.dataType)
                              for f in PURCHASES_BY_DAY])


def purchase_days(spark: SparkSession, sf_dir: str) -> str:
    """Orders as comma-separated files in a directory per day; returns the folder."""
    path = new_path(spark, "days")
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("purchid"),
        F.col("o_custkey").cast("string").alias("custid"),
        F.lit(None).cast("string").alias("pmid"), F.lit(None).cast("string").alias("amenid"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("amount"),
        F.col("o_orderdate").cast("date").alias("pdate"))
    orders.repartition("pdate").write.partitionBy("pdate").csv(path)
    return path


def hourly_files(spark: SparkSession, sf_dir: str) -> str:
    """Events as page-view files whose path tells the hour; returns the folder."""
    path = new_path(spark, "views")
    name = F.concat(F.lit("pagecounts-"), hour_bucket("ts"), F.lit("0000"))
    rows = table(spark, sf_dir, "events").select(
        F.lit("en").alias("language"), F.col("event_type").alias("title"),
        cents("value").alias("views"), F.lit(0).alias("bytes"), name.alias("file"))
    rows.repartition("file").write.partitionBy("file").option("sep", " ").csv(path)
    return path


def event_lines(spark: SparkSession, sf_dir: str) -> str:
    """Events as JSON lines, of every twenty one cut short, one blank, one a list, one with a word for a
    number and one without id; returns the folder."""
    path, kind = new_path(spark, "json"), F.col("event_id") % 20
    whole = F.to_json(F.struct("event_id", "event_type", "value"))
    line = (F.when(kind == 0, F.expr("left(l, length(l) - 1)")).when(kind == 1, "")
            .when(kind == 2, F.concat(F.lit("["), F.col("l"), F.lit("]")))
            .when(kind == 3, F.to_json(F.struct("event_id", "event_type", F.lit("many").alias("value"))))
            .when(kind == 4, F.to_json(F.struct("event_type", "value"))).otherwise(F.col("l")))
    table(spark, sf_dir, "events").withColumn("l", whole).select(line.alias("value")).write.text(path)
    return path


def view_lines(spark: SparkSession, sf_dir: str) -> str:
    """Events as blank-separated page views, of every ten one without count and one with a word for it;
    returns the folder."""
    path, kind = new_path(spark, "views"), F.col("event_id") % 10
    views = F.when(kind == 1, "many").when(kind != 0, cents("value").cast("string"))
    line = F.concat_ws(" ", hour_bucket("ts"), F.lit("en"), F.concat(F.lit('"'), F.col("event_type")), views)
    table(spark, sf_dir, "events").select(line.alias("value")).write.text(path)
    return path


def message_files(spark: SparkSession, sf_dir: str, files: int = 8) -> DataFrame:
    """Events as a stream of messages that arrive file by file."""
    path = new_path(spark, "messages")
    points(spark, sf_dir).select(encode_point(F.col("x"), F.col("y")).alias("value")).repartition(
        files).write.parquet(path)
    return spark.readStream.schema("value binary").option("maxFilesPerTrigger", 1).parquet(path)


def visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders, some without a key and some without a customer."""
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        F.when(key % 101 != 7, key).alias("visit"),
        F.when(key % 53 != 5, F.col("o_custkey")).alias("custid"))
