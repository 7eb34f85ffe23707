"""Streams that may be stopped anywhere and go on from their checkpoint, every message counted once.

An epoch's partial result replaces whatever an earlier attempt at the same epoch has written, and the
checkpoint says which messages belong to it, so an epoch that is repeated after a failure changes
nothing.  The result of the stream is the sum over the epochs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from quillwork.operators.stats import moments

SUMS = ["n", "sum_x", "sum_y", "sum_xx", "sum_yy", "sum_xy"]


def start(messages: DataFrame, folder: str, checkpoint: str,
          partial: Callable[[DataFrame], DataFrame]) -> StreamingQuery:
    """Process what is there, each epoch's ``partial`` result going to ``epoch=...`` in ``folder``."""
    def store(batch: DataFrame, epoch: int) -> None:
        partial(batch).write.mode("overwrite").parquet(f"{folder}/epoch={epoch}")

    return (messages.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def stop_after(query: StreamingQuery, epochs: int, poll: float = 0.02) -> None:
    """Stop a running query once it has finished so many epochs, or wait for its end."""
    while not query.awaitTermination(poll):
        done = query.lastProgress
        if done is not None and done["batchId"] + 1 >= epochs:
            query.stop()
            return


def partial_moments(x: str = "x", y: str = "y") -> Callable[[DataFrame], DataFrame]:
    """The sums of one epoch; an epoch without a whole point has a row of zeros."""
    return lambda batch: moments(batch, x, y).na.fill(0)


def total_moments(spark: SparkSession, folder: str) -> DataFrame:
    """One row: the sums over all epochs so far, and how many there are."""
    epochs = spark.read.parquet(folder)
    return epochs.agg(*[F.sum(c).alias(c) for c in SUMS],
                      F.count_distinct("epoch").alias("epochs"))
