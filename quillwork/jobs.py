"""Jobs from files to files: ``spark-submit run.py JOB ARGUMENTS``.

Each function reads, applies operators, and writes; results are sorted on the way out where order
is part of the result.
"""

from __future__ import annotations

import inspect
import sys
import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillwork.operators import (
    colourspace,
    graph,
    learning,
    logs,
    quality,
    retail,
    scores,
    toplist,
    warehouse,
    weather,
    wordcount,
)
from quillwork import schemas
from quillwork.session import get_spark, settle
from quillwork.sources import catalog, readers, tolerant, writers
from quillwork.streaming import regression

JOBS = {}


def job(f):
    JOBS[f.__name__.replace("_", "-")] = f
    return f


REPORT_ROWS = 1000


def _report(df: DataFrame, name: str = "report") -> None:
    """Print all rows of a result, or, beyond ``REPORT_ROWS`` of them, write all to a folder and name it."""
    shown = settle(df)
    rows = shown.count()
    if rows <= REPORT_ROWS:
        shown.show(rows, truncate=False)
    else:
        target = f"{name}-{uuid.uuid4().hex}"
        writers.csv(shown, target)
        print(f"{rows} rows written to {target}")


@job
def word_count(spark: SparkSession, source: str, target: str, style: str = "punctuation",
               partitions: str = "0") -> None:
    """Lines ``word count`` in word order; style ``punctuation`` or ``plain``."""
    text = readers.text_lines(spark, source)
    counts = wordcount.word_count(text, punctuation=style != "plain", partitions=int(partitions))
    writers.text(counts.orderBy("word"), target, wordcount.as_line("%s %d", "word", "count"))


@job
def popular_pages(spark: SparkSession, source: str, target: str) -> None:
    """Most viewed page per hour from files with an hour column, one winner each."""
    pages = toplist.content_pages(readers.page_views(spark, source))
    best = toplist.argmax_one(pages, ["hour"], "views", "title").orderBy("hour")
    pair = F.format_string("(%d, '%s')", "views", "title").alias("best")
    writers.text(best.select("hour", pair), target, wordcount.as_line("%s\t%s", "hour", "best"))


@job
def page_view_rejects(spark: SparkSession, source: str, target: str) -> None:
    """Lines of page views that cannot be read, with the reason; prints how many there are of each."""
    _, rejected = tolerant.divided(readers.page_views_with_rejects(spark, source))
    writers.json(rejected, target)
    _report(rejected.groupBy("reject").count().orderBy("reject"))


@job
def most_views(spark: SparkSession, source: str, target: str) -> None:
    """Largest view count per hour."""
    pages = toplist.content_pages(readers.page_views(spark, source))
    best = toplist.max_per_key(pages, ["hour"], "views").orderBy("hour")
    writers.tab_separated(best, target)


@job
def popular_pages_by_file(spark: SparkSession, source: str, target: str) -> None:
    """Most viewed pages per hour, the hour being in the file name; all ties."""
    pages = toplist.content_pages(readers.page_views_by_file(spark, source))
    best = toplist.argmax_ties(pages.filter("hour is not null"), ["hour"], "views")
    writers.json(best.select("hour", "title", "views").orderBy("hour", "title"), target)


@job
def comment_averages(spark: SparkSession, source: str, target: str, shape: str = "csv") -> None:
    """Mean score per group, as CSV or as JSON arrays."""
    means = scores.group_mean(readers.comments(spark, source), "subreddit", "score")
    if shape == "csv":
        writers.csv(means, target)
    else:
        writers.json_arrays(means, target, ["subreddit", "mean"])


@job
def comment_split(spark: SparkSession, source: str, target: str, include_zero: str = "yes") -> None:
    """Comments of groups with an "e", split into directories by the sign of the score."""
    rows = scores.select_and_sign(
        readers.comments(spark, source), include_zero=include_zero == "yes"
    )
    writers.split(rows, target, "sign")


@job
def relative_score(spark: SparkSession, source: str, target: str, strategy: str = "broadcast") -> None:
    """``(score / group mean, 'author')``, largest first."""
    out = scores.relative_score(readers.comments(spark, source), strategy=strategy)
    line = F.format_string("(%s, '%s')", F.col("relative_score").cast("string"), "author")
    writers.text(out.orderBy(F.desc("relative_score")), target, line)


@job
def maxima(spark: SparkSession, source: str, target: str) -> None:
    """Daily maxima of one country's stations as gzipped JSON."""
    out = weather.maxima_extract(readers.observations(spark, source))
    writers.json(out, target, compression="gzip")


@job
def temperature_range(spark: SparkSession, source: str, target: str, form: str = "frame") -> None:
    """Stations with the widest range of each day, and how many pairs of readings have it; form ``frame``
    or ``sql``."""
    obs = readers.observations(spark, source)
    find = weather.daily_range_champions_sql if form == "sql" else weather.daily_range_champions
    rows = find(obs).select("date", "station", "range", "pairs")
    writers.csv(rows.orderBy("date", "station"), target)


def _report_correlation(requests: DataFrame) -> None:
    sums = logs.host_moments(requests)
    _report(sums.withColumns({c: F.round(c, 6) for c in ("r", "r2")}))


@job
def correlate_logs(spark: SparkSession, source: str) -> None:
    """Moments, r and r2 of requests against bytes over hosts."""
    _report_correlation(logs.parse_access_log(readers.text_lines(spark, source)))


@job
def load_logs(spark: SparkSession, source: str, fmt: str, *options: str) -> None:
    """Parsed log lines into a table of any format; options are ``key=value``."""
    rows = logs.parse_access_log(readers.text_lines(spark, source), ids="hash")
    writers.table(rows, fmt, **dict(o.split("=", 1) for o in options))


@job
def correlate_table(spark: SparkSession, fmt: str, *options: str) -> None:
    """The correlation of ``correlate-logs`` over an already loaded table."""
    _report_correlation(readers.table(spark, fmt, **dict(o.split("=", 1) for o in options)))


@job
def shortest_path(spark: SparkSession, source: str, target: str, start: str, end: str,
                  hops: str = "6") -> None:
    """State after each round below ``iter=...`` and the path of at most ``hops``, one node per line."""
    edges = graph.edges_from_adjacency(readers.text_lines(spark, source))
    paths = graph.shortest_paths(edges, start, max_hops=int(hops), destination=end)
    writers.split(graph.by_iteration(paths), f"{target}/rounds", "iter", fmt="json")
    steps = graph.route(paths, end)
    writers.text(steps.orderBy("step").coalesce(1), f"{target}/path", F.col("node"))


def _station_split(series: DataFrame) -> tuple[DataFrame, DataFrame]:
    pairs = settle(
        learning.with_season(
            weather.previous_day_window(series, ["station"], "date", "tmax", "yesterday_tmax"))
        .withColumn("_side", F.xxhash64("station"))
    )
    return tuple(part.drop("_side") for part in learning.hash_split(pairs, "_side"))


@job
def weather_train(spark: SparkSession, source: str, target: str) -> None:
    """Fit next-day models with and without the day before, report them, save the first."""
    train, validation = _station_split(readers.daily_maxima(spark, source))
    parts = {"train": train, "validation": validation}
    model = learning.temperature_model(True).fit(train)
    without = learning.temperature_model(False).fit(train)
    _report(
        learning.score_regression(model, parts, "with_yesterday")
        .unionByName(learning.score_regression(without, parts, "without_yesterday"))
    )
    model.write().overwrite().save(target)


@job
def weather_test(spark: SparkSession, model_path: str, source: str) -> None:
    """Score a saved model on a file and show what it relies on."""
    model = PipelineModel.load(model_path)
    series = readers.daily_maxima(spark, source)
    rows = learning.with_season(
        weather.previous_day_window(series, ["station"], "date", "tmax", "yesterday_tmax"))
    _report(learning.score_regression(model, {"test": rows}, "saved"))
    _report(learning.feature_importances(model, rows))


@job
def weather_tomorrow(spark: SparkSession, model_path: str, station: str, date: str, latitude: str,
                     longitude: str, elevation: str, today: str) -> None:
    """Predict the maximum of the day after ``date`` from the maximum of ``date``."""
    row = (station, float(latitude), float(longitude), float(elevation), float(today))
    known = spark.createDataFrame(
        [row], "station string, latitude float, longitude float, elevation float, yesterday_tmax float"
    )
    asked = known.withColumn("date", F.date_add(F.to_date(F.lit(date)), 1))
    asked = asked.withColumn("tmax", F.lit(None).cast("float"))
    scored = PipelineModel.load(model_path).transform(learning.with_season(asked))
    _report(scored.select("station", "date", "prediction"))


@job
def colour_words(spark: SparkSession, source: str, target: str) -> None:
    """Colour-word models over RGB and LAB: accuracy, and predictions over a plane of colours."""
    data, counts = learning.whole_rows(readers.colours(spark, source), schemas.COLOURS_REQUIRED[:4])
    _report(counts)
    data = settle(data.withColumn("_side", F.xxhash64("R", "G", "B")))
    train, validation = learning.hash_split(data, "_side")
    grid = colourspace.lab_grid(spark).select("R", "G", "B", F.lit("black").alias("word"))
    for space in ("RGB", "LAB"):
        model = learning.fit_colour_model(train, space)
        _report(learning.score_words(model, validation, space))
        named = learning.with_predicted_word(model, model.transform(grid), "predicted")
        shown = colourspace.with_palette(named.select("R", "G", "B", "predicted"), "predicted")
        writers.csv(shown, f"{target}/{space}")


def _star(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The warehouse's files: comma-separated, the amenities JSON lines, each in a folder of its name."""
    tables = {name: readers.csv_rows(spark, f"{folder}/{name}", schema)
              for name, schema in catalog.WAREHOUSE.items() if name != "amenities"}
    return tables | {"amenities": readers.json_lines(spark, f"{folder}/amenities", schemas.AMENITIES)}


def _local(star: dict[str, DataFrame]) -> DataFrame:
    return warehouse.area_view(star["customers"], star["greater_vancouver_prefixes"])


@job
def warehouse_load(spark: SparkSession, folder: str, schema: str, location: str) -> None:
    """Create the typed tables of the star schema and load them from files."""
    catalog.create_warehouse(spark, schema, location)
    for name, rows in _star(spark, folder).items():
        catalog.load(rows, f"{schema}.{name}")


@job
def key_checks(spark: SparkSession, folder: str) -> None:
    """Offenders against the declared keys, references and required columns of the warehouse's files."""
    _report(quality.check_keys(_star(spark, folder)))


@job
def average_by_method(spark: SparkSession, folder: str, target: str, province: str = "ON") -> None:
    """Mean purchase per payment method of a province's customers, dearest first."""
    star = _star(spark, folder)
    out = warehouse.average_by_method(star["purchases"], star["paymentmethods"], star["customers"], province)
    writers.csv(out.orderBy(F.desc("average_amount"), "payment_method"), target)


@job
def visitor_segments(spark: SparkSession, folder: str, target: str, home: str = "BC") -> None:
    """Count, mean and median purchase of locals, the rest of the province, and others; by median."""
    star = _star(spark, folder)
    out = warehouse.visitor_segments(star["purchases"], _local(star), star["customers"], home)
    writers.csv(out.orderBy("median", "from_area", "from_province_only"), target)


@job
def average_at_tagged(spark: SparkSession, folder: str, target: str, key: str = "cuisine",
                      pattern: str = "%sushi%", kind: str = "restaurant") -> None:
    """Mean purchase at matching amenities, for locals and others, dearest first."""
    star = _star(spark, folder)
    out = warehouse.average_at_tagged(
        star["purchases"], star["amenities"], _local(star), key, pattern, kind)
    writers.csv(out.orderBy(F.desc("avg"), "in_area"), target)


@job
def average_by_day(spark: SparkSession, source: str, target: str, month: str = "8",
                   days: str = "1,2,3,4,5") -> None:
    """Mean purchase of chosen days of a month, from daily directories ``pdate=...``, by date."""
    chosen = tuple(int(d) for d in days.split(","))
    out = warehouse.average_by_day(readers.purchases_by_day(spark, source), int(month), chosen)
    writers.csv(out.orderBy("pdate"), target)


@job
def store_comparison(spark: SparkSession, source: str, target: str, first: str = "Burnaby",
                     second: str = "Vancouver") -> None:
    """Sales of two stores side by side, by date."""
    out = retail.store_comparison(readers.csv_rows(spark, source, schemas.SALES), first, second)
    writers.csv(out.orderBy("date"), target)


@job
def calendar_features(spark: SparkSession, sales: str, holidays: str, target: str) -> None:
    """Sales per staff member with holiday and weekend flags, by date and store."""
    out = retail.calendar_features(readers.csv_rows(spark, sales, schemas.SALES),
                                   readers.csv_rows(spark, holidays, schemas.HOLIDAYS))
    writers.csv(out.orderBy("date", "store"), target)


@job
def stream_fit(spark: SparkSession, servers: str, topic: str, seconds: str = "600") -> None:
    """Running slope and intercept of the points of a topic, on the console."""
    messages = regression.subscribe(spark, servers, topic)
    query = regression.start_console(regression.running_fit(messages))
    query.awaitTermination(int(seconds))
    query.stop()


def main(arguments: list[str]) -> None:
    if not arguments or arguments[0] not in JOBS:
        usage = [f"  {name} {' '.join(list(inspect.signature(f).parameters)[1:])}"
                 for name, f in JOBS.items()]
        raise SystemExit("jobs:\n" + "\n".join(usage))
    JOBS[arguments[0]](get_spark(f"quillwork {arguments[0]}"), *arguments[1:])


if __name__ == "__main__":
    main(sys.argv[1:])
