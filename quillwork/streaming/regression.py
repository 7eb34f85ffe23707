"""A running straight-line fit over a stream of ``"x y"`` messages."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from quillwork.operators.stats import linear_fit
from quillwork.session import new_path


def subscribe(spark: SparkSession, servers: str, topic: str, fmt: str = "kafka",
              **options: str) -> DataFrame:
    """Messages of a topic (needs the connector of ``fmt`` on the class path)."""
    reader = spark.readStream.format(fmt).option("kafka.bootstrap.servers", servers)
    return reader.option("subscribe", topic).options(**options).load()


def decode_points(messages: DataFrame, value: str = "value") -> DataFrame:
    """Binary ``"x y"`` messages to double columns; a malformed message gives NULL, not a failure."""
    parts = F.split(F.col(value).cast("string"), " ")
    number = lambda i: F.get(parts, F.lit(i)).try_cast("double")
    return messages.select(number(0).alias("x"), number(1).alias("y"))


def encode_point(x: Column, y: Column) -> Column:
    """The message form of a point."""
    return F.concat_ws(" ", x.cast("string"), y.cast("string")).cast("binary")


def running_fit(messages: DataFrame, value: str = "value") -> DataFrame:
    """Slope and intercept so far; the state of the stream is one row of sums."""
    return linear_fit(decode_points(messages, value), "x", "y")


def start_console(fit: DataFrame, checkpoint: str | None = None) -> StreamingQuery:
    """Print every refreshed fit."""
    writer = fit.writeStream.format("console").outputMode("complete")
    return writer.option("checkpointLocation", checkpoint or new_path(fit.sparkSession, "stream")
                         ).start()


def drain(result: DataFrame, timeout: int | None = None) -> DataFrame:
    """Process everything available now, then return the last state of a complete-mode result.

    The state goes through an in-memory table, so this is for results of a few rows, such as the
    single row of a running fit.  Waits until the stream is through; with ``timeout`` (seconds) a
    stream that is not through by then is stopped and ``TimeoutError`` raised, never a part shown.
    """
    spark = result.sparkSession
    name = f"drain_{uuid.uuid4().hex}"
    query = (
        result.writeStream.format("memory").queryName(name).outputMode("complete")
        .option("checkpointLocation", new_path(spark, "stream"))
        .trigger(availableNow=True).start()
    )
    if timeout is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError(f"the stream was not through after {timeout} s")
    return spark.table(name)
