"""Readers that lose no line: every line is a row, and a line that cannot be read says why.

The ``reject`` column is NULL for a good row and else the reason; ``raw`` holds the line of a rejected
row.  Both kinds come out of one scan: :func:`divided` writes them side by side, so the input, which may
be gzip or a text file, is read and parsed once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillwork.functions.text import split_on_space
from quillwork.session import new_path

CORRUPT = "_corrupt_record"
BLANK = "blank line"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).withColumnRenamed("value", "_line")


def _ledger(lines: DataFrame, cells: dict[str, Column], reason: Column, required: list[str]
            ) -> DataFrame:
    """Rows with ``reject`` and ``raw``; a required cell may not be NULL."""
    rows = lines.select("_line", reason.alias("_why"), *[c.alias(n) for n, c in cells.items()])
    lacking = F.coalesce(*[F.when(F.col(c).isNull(), F.lit(f"no {c}")) for c in required],
                         F.lit(None).cast("string"))
    rows = rows.withColumn("reject", F.coalesce("_why", lacking))
    bad = F.col("reject").isNotNull()
    return rows.select(*[F.when(~bad, F.col(c)).alias(c) for c in cells], "reject",
                       F.when(bad, F.col("_line")).alias("raw"))


def _with_corrupt(schema: T.StructType) -> str:
    cells = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema]
    return ", ".join([*cells, f"{CORRUPT} string"])


def json_lines(spark: SparkSession, path: str, schema: T.StructType,
               required: list[str] | None = None) -> DataFrame:
    """JSON lines by field name.

    Reasons: a blank line, ``not JSON``, ``not an object``, ``wrong type`` of a declared field, and
    ``no <column>`` for columns that may not be NULL (by default those the schema declares so).
    """
    lines = _lines(spark, path)
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = lines.withColumn("_j", F.from_json("_line", _with_corrupt(schema), options))
    reason = (
        F.when(F.trim("_line") == "", BLANK)
        .when(F.try_parse_json("_line").isNull(), "not JSON")
        .when(~F.ltrim("_line").startswith("{"), "not an object")
        .when(F.col(f"_j.{CORRUPT}").isNotNull(), "wrong type"))
    return _ledger(parsed, {f.name: F.col(f"_j.`{f.name}`") for f in schema}, reason,
                   _required(schema, required))


def csv_rows(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",",
             required: list[str] | None = None) -> DataFrame:
    """Lines of separated values.

    Reasons: a blank line, ``number of fields`` (an open quote takes in what follows),
    ``wrong type`` and
    ``no <column>``.
    """
    lines = _lines(spark, path)
    options = {"sep": sep, "columnNameOfCorruptRecord": CORRUPT}
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
    parsed = lines.withColumns({
        "_c": F.from_csv("_line", _with_corrupt(schema), options),
        "_t": F.from_csv("_line", _with_corrupt(texts), options)})
    reason = (
        F.when(F.trim("_line") == "", BLANK)
        .when(F.col(f"_t.{CORRUPT}").isNotNull(), "number of fields")
        .when(F.col(f"_c.{CORRUPT}").isNotNull(), "wrong type"))
    return _ledger(parsed, {f.name: F.col(f"_c.`{f.name}`") for f in schema}, reason,
                   _required(schema, required))


def spaced_rows(spark: SparkSession, path: str, schema: T.StructType, fewest: int | None = None,
                strict: list[str] | None = None) -> DataFrame:
    """Fields between blanks, quote characters being text like any other.

    Lines of ``fewest`` fields or more are read (all of the schema's by default; later ones are NULL),
    further fields are left.  Reasons: a blank line, ``number of fields`` and ``wrong type`` (of the
    ``strict`` columns, by default of any; other cells that cannot be read are NULL).
    """
    fewest = len(schema) if fewest is None else fewest
    pieces = F.filter(split_on_space(F.col("_line")), lambda piece: piece != "")
    cut = _lines(spark, path).withColumn("_f", pieces)
    cells = {f.name: F.get("_f", F.lit(i)).try_cast(f.dataType) for i, f in enumerate(schema)}
    misread = [F.get("_f", F.lit(i)).isNotNull() & cells[f.name].isNull()
               for i, f in enumerate(schema) if strict is None or f.name in strict]
    wrong = F.lit(False)
    for one in misread:
        wrong = wrong | one
    reason = (F.when(F.size("_f") == 0, BLANK).when(F.size("_f") < fewest, "number of fields")
              .when(wrong, "wrong type"))
    return _ledger(cut, cells, reason, [])


def _required(schema: T.StructType, given: list[str] | None) -> list[str]:
    return [f.name for f in schema if not f.nullable] if given is None else given


def kept(rows: DataFrame) -> DataFrame:
    """The rows that could be read."""
    return rows.filter("reject is null").drop("reject", "raw")


def rejected(rows: DataFrame) -> DataFrame:
    """``raw, reject`` of the others."""
    return rows.filter("reject is not null").select("raw", "reject")


def ledger(rows: DataFrame) -> DataFrame:
    """Rows per outcome: ``kept``, or the reason."""
    return rows.groupBy(F.coalesce("reject", F.lit("kept")).alias("outcome")).agg(
        F.count(F.lit(1)).alias("rows"))


def divided(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Kept and rejected rows as two settled tables, written by one scan of the input."""
    path = new_path(rows.sparkSession, "divided")
    rows.withColumn("good", F.col("reject").isNull()).write.partitionBy("good").parquet(path)
    both = rows.sparkSession.read.schema(
        T.StructType([*rows.schema.fields, T.StructField("good", T.BooleanType())])).parquet(path)
    return kept(both.filter("good").drop("good")), rejected(both.filter("not good").drop("good"))
