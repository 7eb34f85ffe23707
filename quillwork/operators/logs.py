"""Access logs: parsing, rejects, and the correlation of requests and bytes per host."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillwork.functions.calendar import log_time
from quillwork.functions.fixed import ACCESS_LOG_PATTERN
from quillwork.operators.stats import correlation, moments_with_correlation


def parse_access_log(lines: DataFrame, column: str = "value", ids: str = "uuid") -> DataFrame:
    """Log lines to ``host, id, bytes, date_time, r_path``; lines of another shape are dropped.

    An impossible time or a byte count beyond 64 bits becomes NULL.  ``ids="uuid"`` gives every
    row its own id; ``ids="hash"`` derives it from the line, so that loading the same file twice
    writes the same keys (equal lines then share an id).

    The pattern allows no blank inside a field, so a record always has ten pieces between blanks.
    Cutting there costs little; capturing groups would run the pattern once more per field.
    """
    records = lines.filter(F.col(column).rlike(ACCESS_LOG_PATTERN))
    cut = records.select(F.col(column).alias("_line"), F.split(column, " ").alias("_p"))
    piece = lambda i: F.get("_p", F.lit(i))
    return cut.select(
        piece(0).alias("host"),
        (F.uuid() if ids == "uuid" else F.sha2("_line", 256)).alias("id"),
        piece(9).try_cast("bigint").alias("bytes"),
        log_time(F.ltrim(piece(3), F.lit("["))).alias("date_time"),
        piece(6).alias("r_path"),
    )


def log_quality(lines: DataFrame, column: str = "value") -> DataFrame:
    """One row: how many lines are records and how many are rejected."""
    good = F.coalesce(F.col(column).rlike(ACCESS_LOG_PATTERN), F.lit(False))
    return lines.agg(F.count_if(good).alias("accepted"), F.count_if(~good).alias("rejected"))


def host_totals(requests: DataFrame, host: str = "host", amount: str = "bytes") -> DataFrame:
    """Requests (x) and summed bytes (y) per host, in one aggregate."""
    return requests.groupBy(host).agg(
        F.count(F.lit(1)).alias("x"), F.sum(amount).alias("y")
    )


def host_moments(requests: DataFrame, host: str = "host", amount: str = "bytes") -> DataFrame:
    """Moments of (requests, bytes) over hosts with r and r2.

    Sums of squares are kept in 38-digit decimals: exact, and wide enough for any byte count.
    """
    exact = host_totals(requests, host, amount).select(
        F.col("x").cast("decimal(18,0)"), F.col("y").cast("decimal(20,0)")
    )
    sums = moments_with_correlation(exact, "x", "y")
    return sums.select("n", *[F.col(c).cast("double").alias(c) for c in sums.columns if c != "n"])


def host_correlation(requests: DataFrame, host: str = "host", amount: str = "bytes") -> DataFrame:
    """One row ``n, r, r2`` for requests against bytes over hosts."""
    return correlation(host_totals(requests, host, amount), "x", "y")
