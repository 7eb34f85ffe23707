"""Group means, relative scores and the filter-and-split job over comments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillwork.operators.sizing import hot_keys, is_small, join_salted, settle_measured


def group_mean(df: DataFrame, key: str, value: str, out: str = "mean") -> DataFrame:
    """Mean of ``value`` per ``key``."""
    return df.groupBy(key).agg(F.avg(value).alias(out))


def select_and_sign(df: DataFrame, key: str = "subreddit", score: str = "score",
                    author: str = "author", contains: str = "e",
                    include_zero: bool = True) -> DataFrame:
    """Rows whose key contains a text, with ``sign`` telling positive from non-positive scores.

    One pass labels both halves; writing partitioned by ``sign`` gives the two directories.
    ``include_zero=False`` leaves zero scores out of the negative half.
    """
    rows = df.filter(F.col(key).contains(contains)).select(key, score, author)
    rows = rows.filter(F.col(score).isNotNull() if include_zero else F.col(score) != 0)
    return rows.withColumn("sign", F.when(F.col(score) > 0, "positive").otherwise("negative"))


def relative_score(df: DataFrame, key: str = "subreddit", score: str = "score",
                   author: str = "author", strategy: str = "broadcast") -> DataFrame:
    """Each score divided by the mean of its group, for groups with a positive mean.

    The means are settled first (one pass with map-side combining).  ``broadcast`` joins them on the
    map side if they measure small enough and otherwise falls back to ``shuffle``, a join in
    which rows of groups known to be hot are salted.
    """
    if strategy not in ("broadcast", "shuffle"):
        raise ValueError(f"unknown strategy {strategy!r}")
    facts = df.select(key, score, author)
    counts = F.count(F.lit(1)).alias("_rows")
    means, size = settle_measured(
        facts.groupBy(key).agg(F.avg(score).alias("_mean"), counts).filter("_mean > 0")
    )
    lookup = means.select(key, "_mean")
    if strategy == "broadcast" and is_small(size):
        joined = facts.join(F.broadcast(lookup), key)
    else:
        joined = join_salted(facts, lookup, [key], hot_keys(means, [key], "_rows"))
    return joined.select((F.col(score) / F.col("_mean")).alias("relative_score"), author)


def preview_top(df: DataFrame, rank_by: str, n: int = 10, then: str | None = None) -> DataFrame:
    """The ``n`` largest rows in descending order."""
    order = [F.col(rank_by).desc()] + ([F.col(then)] if then else [])
    return df.orderBy(*order).limit(n)
