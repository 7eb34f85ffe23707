"""Every job run over the test tables, under the names checked against SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillwork import schemas
from quillwork.functions.calendar import is_weekend
from quillwork.operators import (
    colourspace,
    graph,
    learning,
    logs,
    quality,
    retail,
    scores,
    scoring,
    stats,
    toplist,
    warehouse,
    weather,
    wordcount,
)
from quillwork.plans import inputs as I
from quillwork.session import new_path, settle
from quillwork.sources import catalog, readers, tolerant, writers
from quillwork.streaming import regression, restartable

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def rounded(df: DataFrame, places: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, places) for c in columns})


# --- text ---------------------------------------------------------------------------------------

def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.table(spark, sf_dir, "documents").select("doc_id", "text")


# The documents are one file of one row group, which cannot be split: their rows are dealt out.
DEALT = 20


@query
def word_count(spark, sf_dir):
    return wordcount.word_count(_documents(spark, sf_dir), "text", partitions=DEALT)


@query
def word_count_plain(spark, sf_dir):
    return wordcount.word_count(_documents(spark, sf_dir), "text", punctuation=False, partitions=DEALT)


@query
def word_count_lines(spark, sf_dir):
    counts = wordcount.word_count(I.table(spark, sf_dir, "conversations"), "text")
    return counts.select(wordcount.as_line("%s %d", "word", "count").alias("value"))


# --- page views ---------------------------------------------------------------------------------

def _content(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toplist.content_pages(I.page_views(spark, sf_dir))


@query
def max_per_key(spark, sf_dir):
    return toplist.max_per_key(_content(spark, sf_dir), ["hour"], "views")


@query
def argmax_per_key(spark, sf_dir):
    return toplist.argmax_one(_content(spark, sf_dir), ["hour"], "views", "title")


@query
def argmax_per_key_window(spark, sf_dir):
    return toplist.argmax_one_window(_content(spark, sf_dir), ["hour"], "views", "title")


@query
def argmax_ties(spark, sf_dir):
    ties = toplist.argmax_ties(_content(spark, sf_dir), ["hour"], "views")
    return ties.select("hour", "title", "views")


@query
def argmax_ties_window(spark, sf_dir):
    ties = toplist.argmax_ties_window(_content(spark, sf_dir), ["hour"], "views")
    return ties.select("hour", "title", "views")


@query
def filename_hour(spark, sf_dir):
    """The hour of each row comes from the name of the file that holds it."""
    files = readers.page_views_by_file(spark, I.hourly_files(spark, sf_dir))
    return files.groupBy("hour").agg(
        F.count(F.lit(1)).alias("rows"), (F.max("views") / 100).alias("value")
    )


# --- sources and sinks --------------------------------------------------------------------------

EVENT = T.StructType([T.StructField("event_id", T.LongType(), False),
                      T.StructField("event_type", T.StringType()), T.StructField("value", T.DoubleType())])


@query
def json_ledger(spark, sf_dir):
    """JSON lines kept and rejected, by reason."""
    rows = tolerant.json_lines(spark, I.event_lines(spark, sf_dir), EVENT)
    return tolerant.ledger(rows)


@query
def page_view_ledger(spark, sf_dir):
    """Page views kept and rejected, divided by one scan."""
    rows = readers.page_views_with_rejects(spark, I.view_lines(spark, sf_dir))
    kept, rejected = tolerant.divided(rows)
    views = F.sum("views").alias("views")
    return kept.agg(F.lit("kept").alias("outcome"), F.count(F.lit(1)).alias("rows"), views).unionByName(
        rejected.groupBy(F.col("reject").alias("outcome")).agg(F.count(F.lit(1)).alias("rows"))
        .withColumn("views", F.lit(None).cast("bigint")))


def _stored(spark, name, write):
    """The path of what ``write(path)`` has written."""
    path = new_path(spark, name)
    write(path)
    return path


@query
def text_files_word_count(spark, sf_dir):
    """Words of text files."""
    docs = _documents(spark, sf_dir)
    path = _stored(spark, "texts", lambda p: writers.text(docs, p, F.col("text")))
    return wordcount.word_count(readers.text_lines(spark, path), punctuation=False)


@query
def gzip_comment_means(spark, sf_dir):
    """Means per group of gzipped JSON lines, read by the full schema of a comment."""
    comments = I.comments(spark, sf_dir)
    path = _stored(spark, "comments", lambda p: writers.json(comments, p, compression="gzip"))
    means = scores.group_mean(readers.comments(spark, path), "subreddit", "score")
    return rounded(means, 6, "mean")


@query
def csv_maxima(spark, sf_dir):
    """The maxima of comma-separated readings, by filters pushed into their reader."""
    missing = [F.lit(None).cast("string").alias(c) for c in ("mflag", "sflag", "obstime")]
    rows = I.observations(spark, sf_dir).select("*", *missing).select(*schemas.OBSERVATIONS.names)
    path = _stored(spark, "readings", lambda p: writers.csv(rows, p))
    return weather.maxima_extract(readers.observations(spark, path), "CA", "CLICK")


@query
def tab_separated_maxima(spark, sf_dir):
    """The largest view count per hour, stored as tab-separated text and read again."""
    best = toplist.max_per_key(_content(spark, sf_dir), ["hour"], "views")
    path = _stored(spark, "tabs", lambda p: writers.tab_separated(best, p))
    return readers.csv_rows(spark, path, best.schema, sep="\t")


@query
def json_array_means(spark, sf_dir):
    """Group means stored as one JSON array per line, and the cells of those lines."""
    orders = I.table(spark, sf_dir, "orders")
    means = scores.group_mean(orders, "o_orderpriority", "o_totalprice")
    path = _stored(spark, "arrays", lambda p: writers.json_arrays(means, p, means.columns))
    cells = F.from_json("value", "array<string>")
    return rounded(readers.text_lines(spark, path).select(
        cells[0].alias("o_orderpriority"), cells[1].cast("double").alias("mean")), 4, "mean")


@query
def sign_directories(spark, sf_dir):
    """Rows of the two directories that a split by sign has written."""
    rows = scores.select_and_sign(
        I.table(spark, sf_dir, "customer"), "c_mktsegment", "c_acctbal", "c_name", contains="E")
    path = _stored(spark, "signs", lambda p: writers.split(rows, p, "sign", fmt="parquet"))
    return readers.table(spark, "parquet", path=path).groupBy("sign", "c_mktsegment").agg(
        F.count(F.lit(1)).alias("rows"))


@query
def store_comparison_files(spark, sf_dir):
    """Two stores side by side, from comma-separated sales with ISO dates."""
    sales = I.sales(spark, sf_dir).select("date", "store", "sales", F.col("staff").cast("double"))
    path = _stored(spark, "sales", lambda p: writers.csv(sales, p))
    both = retail.store_comparison(
        readers.csv_rows(spark, path, schemas.SALES), "1-URGENT", "5-LOW", names=("urgent", "low"))
    return rounded(both, 2, "urgent", "low")


@query
def adjacency_degrees(spark, sf_dir):
    """Edges into each part, from adjacency lines of the parts of each order."""
    lines = I.table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.collect_list(F.concat(F.lit("p"), "l_partkey")).alias("parts")).select(
        F.concat(F.lit("o"), "l_orderkey", F.lit(": "), F.array_join("parts", " ")).alias("value"))
    path = _stored(spark, "links", lambda p: writers.text(lines, p, F.col("value")))
    edges = graph.edges_from_adjacency(readers.text_lines(spark, path))
    return edges.groupBy("dst").agg(F.count(F.lit(1)).alias("edges"),
                                    F.count_distinct("src").alias("sources"))


@query
def warehouse_tables(spark, sf_dir):
    """Spending by province from typed tables: created, loaded, asked and dropped again."""
    name, path = f"shop_{uuid.uuid4().hex}", new_path(spark, "shop")
    catalog.create_warehouse(spark, name, path)
    key = lambda c: F.col(c).cast("string")
    catalog.load(I.customers(spark, sf_dir).select(
        key("custid").alias("custid"), *[F.lit(None).cast("string").alias(c) for c in (
            "custname", "street", "city")], "province", "postalcode"), f"{name}.customers")
    catalog.load(I.table(spark, sf_dir, "orders").select(
        key("o_orderkey").alias("purchid"), key("o_custkey").alias("custid"),
        F.lit(None).cast("string").alias("pmid"), F.lit(None).cast("string").alias("amenid"),
        F.col("o_orderdate").cast("date").alias("pdate"),
        (I.cents("o_totalprice") % 9_000_000 / 100).cast("decimal(7,2)").alias("amount")),
        f"{name}.purchases")
    spent = settle(spark.table(f"{name}.purchases").groupBy("custid").agg(
        F.sum("amount").alias("amount"), F.count(F.lit(1)).alias("purchases")).join(
        spark.table(f"{name}.customers"), "custid").groupBy("province").agg(
        F.sum("purchases").alias("purchases"), F.sum("amount").cast("double").alias("amount")))
    catalog.drop_warehouse(spark, name)
    catalog.drop_schema(spark, name)
    return rounded(spent, 2, "amount")


@query
def five_day_external(spark, sf_dir):
    """Orders as an external table of daily directories, all registered, of which five days are read."""
    location, name = I.purchase_days(spark, sf_dir), f"purchases_by_day_{uuid.uuid4().hex}"
    catalog.create_purchases_by_day(spark, name, location, I.DAILY_COLUMNS)
    catalog.register_days(spark, name, location)
    return rounded(warehouse.average_by_day(spark.table(name)), 4, "avg")


@query
def holiday_external(spark, sf_dir):
    """The same table joined to a list of holidays, whose dates prune its directories at run time."""
    location, name = I.purchase_days(spark, sf_dir), f"purchases_by_day_{uuid.uuid4().hex}"
    catalog.create_purchases_by_day(spark, name, location, I.DAILY_COLUMNS)
    catalog.register_days(spark, name, location)
    report = warehouse.average_on_days(spark.table(name), I.holidays(spark, sf_dir), "Christmas")
    return rounded(report, 4, "avg")


@query
def clustered_range(spark, sf_dir):
    """A quarter of the line items, from files clustered by the date they are asked by."""
    path = new_path(spark, "clustered")
    writers.clustered(I.table(spark, sf_dir, "lineitem").select(
        "l_shipdate", "l_returnflag", I.cents("l_extendedprice").alias("cents")), path, "l_shipdate")
    items = readers.table(spark, "parquet", path=path)
    quarter = items.filter("l_shipdate >= timestamp_ntz'1996-04-01' and l_shipdate < timestamp_ntz'1996-07-01'")
    return quarter.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("cents").alias("cents"))


@query
def published_table(spark, sf_dir):
    """Orders published, replaced by another publication, and read again."""
    path, orders = new_path(spark, "published"), I.table(spark, sf_dir, "orders")
    writers.publish(orders.select("o_orderkey", "o_orderstatus"), path)
    writers.publish(orders, path)
    return readers.table(spark, "parquet", path=path).groupBy("o_orderstatus", "o_orderpriority").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(I.cents("o_totalprice")).alias("cents"))


@query
def batched_inserts(spark, sf_dir):
    """Orders sent from the executors in batches under a ledger, and what arrived."""
    ledger, target = new_path(spark, "ledger"), new_path(spark, "arrived")
    orders = I.table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", I.cents("o_totalprice").alias("cents"))
    writers.in_batches(orders, writers.json_files(target), size=1000, ledger=ledger)
    arrived = readers.json_lines(spark, target, orders.schema)
    return arrived.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("o_orderkey").alias("keys"),
        F.sum("cents").alias("cents"))


# --- ordered reports ----------------------------------------------------------------------------

@query
def ordered_segments(spark, sf_dir):
    """Segments of each nation, largest total balance first."""
    totals = I.table(spark, sf_dir, "customer").groupBy("c_mktsegment", "c_nationkey").agg(
        F.count(F.lit(1)).alias("customers"), F.sum(I.cents("c_acctbal")).alias("cents"))
    path = new_path(spark, "ordered")
    writers.in_order(totals, path, F.desc("cents"), "c_mktsegment", "c_nationkey")
    return readers.table(spark, "parquet", path=path)


@query
def ordered_days(spark, sf_dir):
    """Days by whether they are free, then by month, then by number of orders."""
    days = I.table(spark, sf_dir, "orders").groupBy(F.col("o_orderdate").cast("date").alias("day")).agg(
        F.count(F.lit(1)).alias("orders"))
    free = F.when(is_weekend("day"), 0).when(F.date_format("day", "MM-dd") == "12-25", 0).otherwise(1)
    path = new_path(spark, "ordered")
    writers.in_order(days, path, free, F.month("day"), F.desc("orders"), "day")
    return readers.table(spark, "parquet", path=path)


# --- comments -----------------------------------------------------------------------------------

@query
def group_mean(spark, sf_dir):
    orders = I.table(spark, sf_dir, "orders")
    return rounded(scores.group_mean(orders, "o_orderpriority", "o_totalprice"), 4, "mean")


@query
def json_group_mean(spark, sf_dir):
    events = I.table(spark, sf_dir, "events").select(
        "event_type", F.from_json("props", "k int").getField("k").alias("k")
    )
    return rounded(scores.group_mean(events, "event_type", "k"), 6, "mean")


@query
def filter_split(spark, sf_dir):
    comments = I.table(spark, sf_dir, "customer")
    return scores.select_and_sign(comments, "c_mktsegment", "c_acctbal", "c_name", contains="E")


def _relative(spark, sf_dir, strategy):
    return rounded(
        scores.relative_score(I.comments(spark, sf_dir), strategy=strategy), 6, "relative_score"
    )


@query
def relative_score(spark, sf_dir):
    return _relative(spark, sf_dir, "shuffle")


@query
def relative_score_broadcast(spark, sf_dir):
    return _relative(spark, sf_dir, "broadcast")


@query
def relative_score_top(spark, sf_dir):
    return scores.preview_top(
        _relative(spark, sf_dir, "broadcast"), "relative_score", 10, then="author"
    )


# --- weather ------------------------------------------------------------------------------------

@query
def tmax_etl(spark, sf_dir):
    return weather.maxima_extract(I.observations(spark, sf_dir), "CA", "CLICK")


@query
def daily_range(spark, sf_dir):
    best = weather.daily_range_champions(I.observations(spark, sf_dir), "VIEW", "CLICK")
    return weather.repeat_pairs(best)


@query
def daily_range_sql(spark, sf_dir):
    best = weather.daily_range_champions_sql(I.observations(spark, sf_dir), "VIEW", "CLICK")
    return weather.repeat_pairs(best)


@query
def station_ranges(spark, sf_dir):
    return weather.station_ranges(I.observations(spark, sf_dir), "VIEW", "CLICK")


def _lagged(spark, sf_dir, step):
    series = step(I.daily_series(spark, sf_dir), ["station"], "date", "tmax", "yesterday_tmax")
    series = series.select(
        "station", "date", F.dayofyear("date").alias("day_of_yr"), "tmax", "yesterday_tmax"
    )
    return rounded(series, 6, "tmax", "yesterday_tmax")


@query
def lagged_feature(spark, sf_dir):
    return _lagged(spark, sf_dir, weather.previous_day)


@query
def lagged_feature_window(spark, sf_dir):
    return _lagged(spark, sf_dir, weather.previous_day_window)


# --- retail -------------------------------------------------------------------------------------

@query
def store_comparison(spark, sf_dir):
    both = retail.store_comparison(
        I.sales(spark, sf_dir), "1-URGENT", "5-LOW", names=("urgent", "low")
    )
    return rounded(both, 2, "urgent", "low")


@query
def calendar_features(spark, sf_dir):
    features = retail.calendar_features(I.sales(spark, sf_dir), I.holidays(spark, sf_dir))
    return rounded(features, 6, "sales_per_staff")


# --- logs and statistics ------------------------------------------------------------------------

@query
def parse_log(spark, sf_dir):
    return logs.parse_access_log(I.log_lines(spark, sf_dir), ids="hash")


@query
def log_ids(spark, sf_dir):
    """Every accepted line has an id of its own."""
    requests = logs.parse_access_log(I.log_lines(spark, sf_dir), ids="uuid")
    return requests.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("id").alias("ids"))


@query
def log_quality(spark, sf_dir):
    return logs.log_quality(I.log_lines(spark, sf_dir))


@query
def log_host_correlation(spark, sf_dir):
    requests = logs.parse_access_log(I.log_lines(spark, sf_dir), ids="hash")
    return rounded(logs.host_moments(requests), 6, "r", "r2")


@query
def host_correlation(spark, sf_dir):
    events = I.table(spark, sf_dir, "events")
    return rounded(logs.host_correlation(events, "user_id", "value"), 6, "r", "r2")


@query
def moments(spark, sf_dir):
    exact = I.table(spark, sf_dir, "events").select(
        F.col("event_id").cast("decimal(18,0)").alias("x"),
        I.cents("value").cast("decimal(18,0)").alias("y"),
    )
    sums = stats.moments_with_correlation(exact, "x", "y")
    sums = sums.select("n", *[F.col(c).cast("double").alias(c) for c in sums.columns if c != "n"])
    return rounded(sums, 6, "r", "r2")


@query
def linear_fit(spark, sf_dir):
    fit = stats.linear_fit(I.points(spark, sf_dir), "x", "y")
    return rounded(fit, 6, "slope_beta", "intercept_alpha")


@query
def stream_regression(spark, sf_dir):
    fit = regression.drain(regression.running_fit(I.point_stream(spark, sf_dir)))
    return rounded(fit, 6, "slope_beta", "intercept_alpha")


@query
def stream_restart(spark, sf_dir):
    """A stream stopped after half of its files, started again, and the sums of all."""
    messages = regression.decode_points(I.message_files(spark, sf_dir))
    folder, checkpoint = new_path(spark, "epochs"), new_path(spark, "checkpoint")
    run = lambda: restartable.start(messages, folder, checkpoint, restartable.partial_moments())
    restartable.stop_after(run(), 4)
    run().awaitTermination()
    return rounded(restartable.total_moments(spark, folder).drop("epochs"), 1,
                   "sum_x", "sum_y", "sum_xx", "sum_yy", "sum_xy")


@query
def stream_moments(spark, sf_dir):
    decoded = regression.decode_points(I.point_stream(spark, sf_dir))
    return rounded(
        regression.drain(stats.moments(decoded, "x", "y")), 1,
        "sum_x", "sum_y", "sum_xx", "sum_yy", "sum_xy",
    )


# --- warehouse ----------------------------------------------------------------------------------

@query
def star_avg_by_method(spark, sf_dir):
    report = warehouse.average_by_method(
        I.payments(spark, sf_dir), I.payment_methods(spark, sf_dir), I.customers(spark, sf_dir)
    )
    return rounded(report, 6, "average_amount")


def _area(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warehouse.area_view(I.customers(spark, sf_dir), I.postal_prefixes(spark, sf_dir))


@query
def area_view(spark, sf_dir):
    return _area(spark, sf_dir)


@query
def area_view_permanent(spark, sf_dir):
    """The same flags through a view in the catalogue that any later statement may use."""
    files = {name: f"parquet.`{sf_dir}/{name}.parquet`" for name in ("customer", "nation", "supplier")}
    view = catalog.create_permanent_view(spark, "quillwork_area", AREA_VIEW.format(**files))
    return view.select("custid", "in_area")


AREA_VIEW = """
WITH placed AS (
  SELECT c_custkey AS custid, substring(concat(lpad(CAST(c_nationkey AS STRING), 2, '0'),
         substring(c_mktsegment, 1, 1), substring(c_name, 16, 3)), 1, 3) AS prefix
  FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey
),
listed AS (
  SELECT DISTINCT concat(lpad(CAST(s_nationkey AS STRING), 2, '0'), 'M') AS prefix
  FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey WHERE n_regionkey = 1
)
SELECT p.custid, IF(l.prefix IS NULL, 0, 1) AS in_area
FROM placed p LEFT JOIN listed l ON p.prefix = l.prefix
"""


@query
def segment_three_way(spark, sf_dir):
    report = warehouse.visitor_segments(
        I.purchases(spark, sf_dir), _area(spark, sf_dir), I.customers(spark, sf_dir)
    )
    return rounded(report, 6, "average", "median")


@query
def ilike_semi(spark, sf_dir):
    report = warehouse.average_at_tagged(
        I.purchases(spark, sf_dir), I.amenities(spark, sf_dir), _area(spark, sf_dir),
        "cuisine", "%RING%", "ECONOMY",
    )
    return rounded(report, 6, "avg")


@query
def five_day_avg(spark, sf_dir):
    return rounded(warehouse.average_by_day(I.daily_purchases(spark, sf_dir)), 4, "avg")


DRIVER_KEYS = {
    "customer": {"key": ["c_custkey"], "required": ["c_name"],
                 "references": {"c_nationkey": ("nation", "n_nationkey")}},
    "orders": {"key": ["o_orderkey"], "required": [],
               "references": {"o_custkey": ("customer", "c_custkey")}},
    "lineitem": {"key": ["l_orderkey", "l_linenumber"], "required": ["l_shipdate"],
                 "references": {"l_orderkey": ("orders", "o_orderkey"),
                                "l_partkey": ("part", "p_partkey"),
                                "l_suppkey": ("supplier", "s_suppkey")}},
    "nation": {"key": ["n_nationkey"], "required": [],
               "references": {"n_regionkey": ("region", "r_regionkey")}},
    "documents": {"key": ["doc_id"], "required": ["text"],
                  "references": {"doc_id": ("labels", "doc_id")}},
    "visits": {"key": ["visit"], "required": [],
               "references": {"custid": ("customer", "c_custkey")}},
}


@query
def dq_checks(spark, sf_dir):
    names = [*DRIVER_KEYS, "part", "supplier", "region", "labels"]
    tables = {name: I.visits(spark, sf_dir) if name == "visits" else I.table(spark, sf_dir, name)
              for name in names}
    return quality.check_keys(tables, DRIVER_KEYS)


@query
def dq_duplicate_keys(spark, sf_dir):
    return quality.duplicate_keys(
        I.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"]
    )


# --- graph --------------------------------------------------------------------------------------

@query
def shortest_paths(spark, sf_dir):
    return graph.shortest_paths(I.trade_edges(spark, sf_dir), "c0")


@query
def shortest_path_rounds(spark, sf_dir):
    paths = graph.shortest_paths(I.trade_edges(spark, sf_dir), "c0")
    return graph.by_iteration(paths).groupBy("iter", "distance").agg(
        F.count(F.lit(1)).alias("nodes")
    )


@query
def shortest_path_route(spark, sf_dir):
    paths = graph.shortest_paths(I.trade_edges(spark, sf_dir), "c0", destination="c1")
    return graph.route(paths, "c1")


# --- colours ------------------------------------------------------------------------------------

@query
def rgb_to_lab(spark, sf_dir):
    lab = colourspace.converted(I.colours(spark, sf_dir), "lab")
    return rounded(lab, 6, "labL", "labA", "labB")


@query
def rgb_to_hsv(spark, sf_dir):
    return rounded(colourspace.converted(I.colours(spark, sf_dir), "hsv"), 6, "H", "S", "V")


def _by_statement(spark, sf_dir, space, *out):
    colours = I.colours(spark, sf_dir)
    statement = colourspace.conversion(space, ["R", "G", "B", "p_partkey", "word"])
    converted = SQLTransformer(statement=statement).transform(colours)
    return rounded(converted, 6, *out)


@query
def rgb_to_lab_sql(spark, sf_dir):
    return _by_statement(spark, sf_dir, "lab", "labL", "labA", "labB")


@query
def rgb_to_hsv_sql(spark, sf_dir):
    return _by_statement(spark, sf_dir, "hsv", "H", "S", "V")


@query
def lab_to_rgb(spark, sf_dir):
    return rounded(colourspace.lab_to_rgb(I.lab_points(spark, sf_dir)), 4, "R", "G", "B")


@query
def colour_palette(spark, sf_dir):
    counted = I.colours(spark, sf_dir).groupBy("word").agg(F.count(F.lit(1)).alias("rows"))
    return colourspace.with_palette(counted)


# --- splitting and learning ----------------------------------------------------------------------

@query
def label_index(spark, sf_dir):
    return learning.label_index(I.table(spark, sf_dir, "part"), "p_type")


@query
def hash_split(spark, sf_dir):
    part = F.when(learning.in_first_part("c_custkey"), "train").otherwise("validation")
    customers = I.table(spark, sf_dir, "customer")
    return customers.groupBy(part.alias("part"), "c_mktsegment").agg(
        F.count(F.lit(1)).alias("rows")
    )


@query
def vector_assembly(spark, sf_dir):
    """The inputs of the temperature model as vectors; rows without one of them are left out."""
    inputs = ["season_day", *learning.PLACE, "tmax"]
    rows, _ = learning.whole_rows(learning.with_season(I.gappy_series(spark, sf_dir)), inputs)
    vectors = VectorAssembler(inputCols=inputs, outputCol="features").transform(rows)
    cells = vectors.select("station", "date", vector_to_array("features").alias("v"))
    return rounded(cells.select("station", "date", *[
        F.get("v", F.lit(i)).alias(f"v{i}") for i in range(len(inputs))]), 6, "v4")


@query
def model_row_counts(spark, sf_dir):
    """Rows a model can be fitted on, and those it cannot, by what they lack."""
    rows = learning.with_season(I.gappy_series(spark, sf_dir))
    _, counts = learning.whole_rows(rows, ["season_day", *learning.PLACE, "tmax"])
    return counts


@query
def regression_metrics(spark, sf_dir):
    """How well yesterday's value predicts today's."""
    pairs = weather.previous_day_window(
        I.daily_series(spark, sf_dir), ["station"], "date", "tmax", "yesterday_tmax"
    )
    return rounded(stats.regression_metrics(pairs, "tmax", "yesterday_tmax"), 6, "rmse", "r2")


@query
def classification_accuracy(spark, sf_dir):
    """How well absence of toxicity predicts quality."""
    labels = I.table(spark, sf_dir, "labels").withColumn("guess", 1 - F.col("toxic"))
    return rounded(stats.accuracy(labels, "quality", "guess"), 6, "accuracy")


def _temperature_data(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    pairs = weather.previous_day_window(
        I.daily_series(spark, sf_dir), ["station"], "date", "tmax", "yesterday_tmax"
    )
    return learning.hash_split(settle(learning.with_season(pairs)), "station")


@query
def regression_model(spark, sf_dir):
    train, validation = _temperature_data(spark, sf_dir)
    reports = []
    for name, lagged in (("with_yesterday", True), ("without_yesterday", False)):
        model = learning.temperature_model(lagged).fit(train)
        parts = {"train": train, "validation": validation}
        reports.append(learning.score_regression(model, parts, name))
    return reports[0].unionByName(reports[1])


def _apart(rows, one, two, tolerance):
    """Rows, and those whose two columns differ by more than so much."""
    return rows.agg(F.count(F.lit(1)).alias("rows"),
                    F.count_if(F.abs(F.col(one) - F.col(two)) > tolerance).alias("differ"))


@query
def saved_model_scores(spark, sf_dir):
    """Predictions of a model before and after it was stored."""
    train, validation = _temperature_data(spark, sf_dir)
    model = learning.temperature_model(True, max_iter=5).fit(train)
    path = new_path(spark, "model")
    model.write().overwrite().save(path)
    rows = model.transform(train.unionByName(validation)).withColumnRenamed(
        "prediction", "before").drop("features")
    return _apart(PipelineModel.load(path).transform(rows), "before", "prediction", 0.0)


@query
def model_as_columns(spark, sf_dir):
    """Predictions of boosted trees by the model, and by the model written as a column expression."""
    train, validation = _temperature_data(spark, sf_dir)
    model = learning.temperature_model(True, max_iter=10).fit(train)
    column = scoring.boosted_trees(model.stages[-1], ["season_day", *learning.PLACE, "yesterday_tmax"])
    rows = model.transform(train.unionByName(validation)).withColumn("column", column)
    return _apart(rows, "prediction", "column", 1e-9)


@query
def feature_importance(spark, sf_dir):
    train, _ = _temperature_data(spark, sf_dir)
    model = learning.temperature_model(True).fit(train)
    return learning.feature_importances(model, train)


def _colour_models(spark: SparkSession, sf_dir: str):
    train, validation = learning.hash_split(settle(I.colours(spark, sf_dir)), "p_partkey")
    models = {
        "rgb": learning.fit_colour_model(train, "RGB"),
        "lab": learning.fit_colour_model(train, "LAB"),
    }
    return models, validation


@query
def classifier_model(spark, sf_dir):
    models, validation = _colour_models(spark, sf_dir)
    rgb, lab = (learning.score_words(m, validation, name) for name, m in models.items())
    return rgb.unionByName(lab)


@query
def prediction_grid(spark, sf_dir):
    models, _ = _colour_models(spark, sf_dir)
    grid = colourspace.lab_grid(spark, 70.0, 256).withColumn("word", F.lit("black"))
    scored = learning.with_predicted_word(models["rgb"], models["rgb"].transform(grid), "predicted")
    shown = colourspace.with_palette(scored.drop("word"), "predicted")
    return shown.select("labA", "labB", "R", "G", "B", "predicted", "showR", "showG", "showB")
