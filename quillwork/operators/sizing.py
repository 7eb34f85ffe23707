"""Joins against a lookup table: broadcast only after measuring it, salted otherwise."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from quillwork.session import new_path, settle_at

# A broadcast lookup may hold at most this much; beyond it the join is shuffled.
MAX_BROADCAST_ROWS = 2_000_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024
ROW_OVERHEAD_BYTES = 32
# Narrow rows that one file of a settled table may well hold.
ROWS_A_FILE = 100_000


def settle_measured(df: DataFrame, path: str | None = None) -> tuple[DataFrame, tuple[int, int]]:
    """Settle a table and learn its rows and approximate bytes from the same job."""
    width = sum(
        (F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in df.columns),
        F.lit(ROW_OVERHEAD_BYTES),
    )
    seen = Observation()
    table = settle_at(df.observe(
        seen, F.count(F.lit(1)).alias("rows"), F.sum(width.cast("long")).alias("bytes")
    ), path or new_path(df.sparkSession, "settled"))
    return table, (seen.get["rows"], seen.get["bytes"] or 0)


def settle_counted(df: DataFrame, path: str | None = None) -> tuple[DataFrame, int]:
    """Settle a table and learn its rows from the same job."""
    seen = Observation()
    table = settle_at(df.observe(seen, F.count(F.lit(1)).alias("rows")), path or new_path(df.sparkSession, "settled"))
    return table, seen.get["rows"]


def in_few_files(df: DataFrame, rows: int) -> DataFrame:
    """``df``, of at most ``rows`` narrow rows, in as many partitions as these fill, in all slots at least.

    Settled by each partition of the shuffle before it, a small table costs a task and a file for every
    one of them, most of which hold next to nothing.
    """
    slots = df.sparkSession.sparkContext.defaultParallelism
    return df.coalesce(max(slots, -(-rows // ROWS_A_FILE)))


def is_small(size: tuple[int, int]) -> bool:
    """Does a measured size stay inside the broadcast bounds?"""
    return size[0] <= MAX_BROADCAST_ROWS and size[1] <= MAX_BROADCAST_BYTES


def join_measured(facts: DataFrame, lookup: DataFrame, size: tuple[int, int],
                  on: list[str], how: str = "inner") -> DataFrame:
    """Join to a lookup of measured size: broadcast when small, otherwise left to the optimizer.

    The fallback is an ordinary shuffle join, whose oversized partitions adaptive execution splits.
    """
    return facts.join(F.broadcast(lookup) if is_small(size) else lookup, on, how)


def hot_keys(counts: DataFrame, on: list[str], rows: str, share: float = 0.01) -> DataFrame:
    """Keys that hold more than ``share`` of all rows, at most ``1 / share`` of them, with ``_salts``.

    A key gets twice as many salts as its share of the shuffle's partitions, so that none of its parts
    is larger than half an even partition.
    """
    parts = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = counts.agg(F.sum(rows)).first()[0] or 0
    salts = F.ceil(F.col(rows) * (2 * parts) / max(total, 1)).cast("int")
    return counts.filter(F.col(rows) > total * share).select(
        *on, F.greatest(salts, F.lit(2)).alias("_salts"))


def join_salted(facts: DataFrame, lookup: DataFrame, on: list[str], hot: DataFrame) -> DataFrame:
    """Inner shuffle join in which the rows of hot keys are spread over their salts.

    ``lookup`` has one row per key and ``hot`` comes from :func:`hot_keys`, so its size is bounded
    by arithmetic; it is the only thing broadcast.  Cold keys keep salt 0 and are not copied.  A row's
    salt is a hash of the row, so a repeated task sends it where it went before.
    """
    flags, salts = F.broadcast(hot), F.coalesce(F.col("_salts"), F.lit(1))
    left = (
        facts.join(flags, on, "left")
        .withColumn("_salt", F.pmod(F.xxhash64(*facts.columns), salts).cast("int")).drop("_salts")
    )
    copies = F.sequence(F.lit(0), salts - 1)
    right = lookup.join(flags, on, "left").withColumn("_salt", F.explode(copies)).drop("_salts")
    return left.join(right.hint("shuffle_hash"), [*on, "_salt"]).drop("_salt")
