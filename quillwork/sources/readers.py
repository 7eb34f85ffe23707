"""Readers with explicit schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillwork import schemas
from quillwork.functions.calendar import hour_from_path
from quillwork.sources import tolerant


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text files or directories; ``.gz`` files are unpacked by suffix."""
    return spark.read.text(path)


def json_lines(spark: SparkSession, path: str, schema: T.StructType, malformed: str = "PERMISSIVE"
               ) -> DataFrame:
    """JSON lines by field name; ``malformed="DROPMALFORMED"`` skips broken records."""
    return spark.read.schema(schema).option("mode", malformed).json(path)


def csv_rows(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",") -> DataFrame:
    """CSV files without header."""
    return spark.read.schema(schema).option("sep", sep).csv(path)


def comments(spark: SparkSession, path: str) -> DataFrame:
    return json_lines(spark, path, schemas.COMMENTS)


def observations(spark: SparkSession, path: str) -> DataFrame:
    """Weather readings; filters on them are pushed into the CSV reader."""
    return csv_rows(spark, path, schemas.OBSERVATIONS)


def daily_maxima(spark: SparkSession, path: str) -> DataFrame:
    return csv_rows(spark, path, schemas.DAILY_MAXIMA)


def colours(spark: SparkSession, path: str) -> DataFrame:
    return csv_rows(spark, path, schemas.COLOURS)


def page_views(spark: SparkSession, path: str) -> DataFrame:
    """Five blank-separated fields per line, the last of which may be missing."""
    return tolerant.kept(page_views_with_rejects(spark, path))


def page_views_with_rejects(spark: SparkSession, path: str) -> DataFrame:
    """:func:`page_views` with a ``reject`` reason and the ``raw`` line of those that cannot be read."""
    return tolerant.spaced_rows(spark, path, schemas.PAGE_VIEWS, fewest=4, strict=["views"])


def page_views_by_file(spark: SparkSession, path: str) -> DataFrame:
    """Four blank-separated fields per line; the hour comes from the file name, at any depth."""
    rows = (
        spark.read.schema(schemas.PAGE_VIEWS_BY_FILE)
        .option("sep", " ").option("quote", "").option("recursiveFileLookup", "true").csv(path)
    )
    return rows.withColumn("hour", hour_from_path(F.col("_metadata.file_path")))


def table(spark: SparkSession, fmt: str, **options: str) -> DataFrame:
    """Any table source by format and options, e.g. a wide-column store with its connector."""
    return spark.read.format(fmt).options(**options).load()


def purchases_by_day(spark: SparkSession, path: str) -> DataFrame:
    """Comma-separated purchases in ``pdate=...`` directories, the date being a column."""
    schema = T.StructType([*schemas.PURCHASES_BY_DAY, T.StructField("pdate", T.DateType())])
    return spark.read.schema(schema).csv(path)


def literal_rows(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """A few rows given in code."""
    return spark.createDataFrame(rows, schema)
