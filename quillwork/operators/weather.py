"""Weather observations: maxima extract, widest daily range, previous-day feature."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillwork.functions.nulls import present
from quillwork.operators.toplist import argmax_ties
from quillwork.session import settle


def maxima_extract(obs: DataFrame, prefix: str = "CA", kind: str = "TMAX",
                   out: str = "tmax") -> DataFrame:
    """Unflagged readings of one kind from stations with a prefix, in degrees."""
    keep = (
        F.col("qflag").isNull()
        & F.col("station").startswith(prefix)
        & (F.col("observation") == kind)
    )
    return obs.filter(keep).select("station", "date", (F.col("value") / 10).alias(out))


def station_ranges(obs: DataFrame, low: str = "TMIN", high: str = "TMAX") -> DataFrame:
    """Widest range per (date, station) and how many (low, high) reading pairs reach it.

    Joining low to high readings would emit every pair of repeated readings.  Only pairs of a
    lowest and a highest reading can be widest, so counting those two is enough.  Equal readings are
    tallied first, which also keeps a hot station-day from meeting in one task row by row.
    """
    tallied = (
        obs.filter(F.col("qflag").isNull() & F.col("observation").isin(low, high))
        .filter(present("date", "station", "value"))
        .groupBy("date", "station", "observation", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    low_value = F.when(F.col("observation") == low, F.col("value"))
    high_value = F.when(F.col("observation") == high, F.col("value"))
    extremes = tallied.groupBy("date", "station").agg(
        F.min(low_value).alias("low"),
        F.min_by("n", low_value).alias("n_low"),
        F.max(high_value).alias("high"),
        F.max_by("n", high_value).alias("n_high"),
    )
    return (
        extremes.filter("low is not null and high is not null")
        .select(
            "date", "station",
            ((F.col("high") - F.col("low")) / 10).alias("range"),
            (F.col("n_low") * F.col("n_high")).alias("pairs"),
        )
    )


def daily_range_champions(obs: DataFrame, low: str = "TMIN", high: str = "TMAX") -> DataFrame:
    """Stations with the widest range of each date, all ties kept, with their pair count."""
    return argmax_ties(settle(station_ranges(obs, low, high)), ["date"], "range")


def repeat_pairs(champions: DataFrame, piece: int = 10_000) -> DataFrame:
    """A row per reading pair instead of a count of pairs, as a join of low to high readings gives them.

    A count is cut into pieces of at most ``piece`` pairs, which are dealt out before they become rows,
    so the pairs of one hot station-day are written by all tasks.
    """
    last = F.ceil(F.col("pairs") / piece) - 1
    pieces = champions.withColumn("_piece", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    size = F.least(F.col("pairs") - F.col("_piece") * piece, F.lit(piece).cast("bigint"))
    dealt = pieces.repartition(*champions.columns, "_piece")
    copies = F.explode(F.sequence(F.lit(1).cast("bigint"), size))
    return dealt.withColumn("_copy", copies).drop("_copy", "_piece", "pairs")


DAILY_RANGE_SQL = """
WITH tallied AS (
  SELECT date, station, observation, value, count(*) AS n
  FROM {obs}
  WHERE qflag IS NULL AND observation IN (:low, :high)
    AND date IS NOT NULL AND station IS NOT NULL AND value IS NOT NULL
  GROUP BY date, station, observation, value
),
extremes AS (
  SELECT date, station,
         min(value) FILTER (WHERE observation = :low) AS low,
         min_by(n, value) FILTER (WHERE observation = :low) AS n_low,
         max(value) FILTER (WHERE observation = :high) AS high,
         max_by(n, value) FILTER (WHERE observation = :high) AS n_high
  FROM tallied GROUP BY date, station
),
ranges AS (
  SELECT date, station, (high - low) / 10 AS range, n_low * n_high AS pairs
  FROM extremes WHERE low IS NOT NULL AND high IS NOT NULL
),
widest AS (
  SELECT date, max(range) AS range FROM ranges GROUP BY date
)
SELECT r.date, r.station, r.range, r.pairs
FROM ranges r JOIN widest w ON r.date = w.date AND r.range = w.range
"""


def daily_range_champions_sql(obs: DataFrame, low: str = "TMIN", high: str = "TMAX") -> DataFrame:
    """The same champions written as one SQL query.

    The kinds are parameters of the statement, and the view it reads has a name of its own, so no view
    of the caller's is replaced.
    """
    return obs.sparkSession.sql(DAILY_RANGE_SQL, args={"low": low, "high": high}, obs=obs)


def previous_day(series: DataFrame, keys: list[str], date: str, value: str, out: str) -> DataFrame:
    """Rows joined to the row of the same key one calendar day before."""
    before = series.select(
        *keys, F.date_add(date, 1).alias(date), F.col(value).alias(out)
    )
    return series.join(before, [*keys, date])


def previous_day_window(series: DataFrame, keys: list[str], date: str, value: str,
                        out: str) -> DataFrame:
    """Same as :func:`previous_day` in one shuffle, for series with one row per key and date.

    A group holds at most one row per calendar day, which bounds it whatever the data size.
    """
    line = Window.partitionBy(*keys).orderBy(date)
    adjacent = F.col("_date") == F.date_sub(date, 1)
    return (
        series.withColumn("_date", F.lag(date).over(line)).withColumn(out, F.lag(value).over(line))
        .filter(adjacent).drop("_date")
    )
