"""Writers; every result can be sorted on the way out, as results themselves are unordered."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from itertools import groupby, islice
from json import dumps as to_json

from pyarrow.fs import FileSystem, FileType
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from quillwork.operators.ordering import positioned
from quillwork.session import delete, exists, rename


def text(df: DataFrame, path: str, line: Column) -> None:
    """One formatted line per row."""
    df.select(line.alias("value")).write.mode("overwrite").text(path)


def tab_separated(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("sep", "\t").option("quote", "").csv(path)


def csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path)


def json(df: DataFrame, path: str, compression: str = "none") -> None:
    df.write.mode("overwrite").option("compression", compression).json(path)


def json_arrays(df: DataFrame, path: str, columns: list[str]) -> None:
    """One JSON array per line, e.g. ``["group",1.5]``."""
    cells = [F.regexp_extract(F.to_json(F.struct(F.col(c).alias("v"))), r"(?s)^\{\"v\":(.*)\}$", 1)
             for c in columns]
    cells = [F.when(F.col(c).isNull(), F.lit("null")).otherwise(v) for c, v in zip(columns, cells)]
    text(df, path, F.concat(F.lit("["), F.concat_ws(",", *cells), F.lit("]")))


def split(df: DataFrame, path: str, by: str, fmt: str = "json") -> None:
    """One pass into one directory per value of ``by``."""
    df.write.mode("overwrite").partitionBy(by).format(fmt).save(path)


def table(df: DataFrame, fmt: str, **options: str) -> None:
    """Replace a table of any format; a wide-column store also takes ``confirm.truncate``."""
    df.write.mode("overwrite").format(fmt).options(**options).save()


def publish(df: DataFrame, path: str, fmt: str = "parquet", **options: str) -> None:
    """Replace the folder ``path`` in one step, so that readers see the old rows or the new ones.

    Rows are written beside the folder first; a task may be repeated or the job fail without a trace
    in ``path``.  Then the folder is renamed away, the new one renamed in its place, and the old one
    deleted.  A failure between the renames is mended by the next call, or by hand from the one folder
    whose name ends in ``.old``.
    """
    spark, staged, old = df.sparkSession, f"{path}.staged-{uuid.uuid4().hex}", f"{path}.old"
    try:
        df.write.format(fmt).options(**options).save(staged)
    except BaseException:
        delete(spark, staged)
        raise
    if exists(spark, path):
        delete(spark, old)
        rename(spark, path, old)
    rename(spark, staged, path)
    delete(spark, old)


def clustered(df: DataFrame, path: str, by: str, files: int | None = None, **options: str) -> None:
    """Parquet files that each hold a range of ``by``, sorted, for readers that filter on it.

    Statistics of files, row groups and pages then tell nearly everything apart that a range of ``by``
    does not need.
    """
    parts = files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (df.repartitionByRange(parts, by).sortWithinPartitions(by)
     .write.mode("overwrite").options(**options).parquet(path))


def in_order(df: DataFrame, path: str, *order: Column | str, fmt: str = "parquet") -> None:
    """Write rows in an order, with their ``position`` from 1 on: file after file, line after line."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = positioned(df, *order).repartitionByRange(parts, "position")
    rows.sortWithinPartitions("position").write.mode("overwrite").format(fmt).save(path)


def in_batches(df: DataFrame, send: Callable[[list[Row]], None], size: int = 301,
               ledger: str | None = None) -> None:
    """Hand rows to ``send`` on the executors in lists of at most ``size``.

    Without a ``ledger`` (a folder that driver and executors share) a repeated task sends its rows
    again.  With one, the rows are written there first, cut into batches once and for all, and each
    batch leaves a mark when ``send`` has returned: a repeated task, or another call after a failure,
    sends only batches without a mark.  A batch is sent twice only if its task dies between ``send``
    and the mark.
    """
    if ledger is None:
        def deliver(rows: Iterator[Row]) -> None:
            while chunk := list(islice(rows, size)):
                send(chunk)

        df.foreachPartition(deliver)
        return
    spark, stored = df.sparkSession, f"{ledger}/rows"
    if not exists(spark, f"{stored}/_SUCCESS"):
        at = F.monotonically_increasing_id()
        batch = F.concat_ws("-", F.shiftright("_at", 33), F.floor(
            F.col("_at").bitwiseAND((1 << 33) - 1) / size))
        df.withColumn("_at", at).withColumn("_batch", batch).write.mode("overwrite").parquet(stored)
    marks = f"{ledger}/sent"
    rows = spark.read.parquet(stored).repartition("_batch").sortWithinPartitions("_batch", "_at")
    names = df.columns

    def deliver_once(rows: Iterator[Row]) -> None:
        files, folder = FileSystem.from_uri(marks)
        files.create_dir(folder, recursive=True)
        for batch, held in groupby(rows, key=lambda row: row["_batch"]):
            mark = f"{folder}/{batch}"
            if files.get_file_info(mark).type == FileType.NotFound:
                send([Row(**{c: row[c] for c in names}) for row in held])
                files.open_output_stream(mark).close()

    rows.foreachPartition(deliver_once)


def json_files(folder: str) -> Callable[[list[Row]], None]:
    """A ``send`` for :func:`in_batches` that puts each batch into a file of its own."""
    def send(rows: list[Row]) -> None:
        files, path = FileSystem.from_uri(folder)
        files.create_dir(path, recursive=True)
        lines = "".join(to_json(row.asDict(True), default=str) + "\n" for row in rows)
        with files.open_output_stream(f"{path}/{uuid.uuid4().hex}.json") as out:
            out.write(lines.encode())

    return send
