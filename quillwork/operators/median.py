"""Exact median per group by radix selection, without gathering a group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillwork.functions.nulls import present
from quillwork.operators.sizing import join_measured, settle_measured
from quillwork.session import settle

SHIFTS = (48, 32, 16, 0)  # a 64-bit number is read in four digits of 16 bits


def ordered_words(value: Column, kind: T.DataType) -> list[Column]:
    """64-bit numbers whose order, the first one deciding first, is the order of the values.

    A double is its bits, those below the sign flipped where it is negative, so infinities lie at the
    ends and NaN above them.  A decimal of more than 18 digits takes three numbers of 18 digits each.
    """
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        raw = F.java_method(F.lit("java.lang.Double"), F.lit("doubleToLongBits"), value.cast("double"))
        bits = F.when(value.isNotNull(), raw.cast("long"))
        return [F.when(bits < 0, bits.bitwiseXOR(F.lit((1 << 63) - 1))).otherwise(bits)]
    if isinstance(kind, T.DecimalType) and kind.precision <= 18:
        return [(value * F.lit(10 ** kind.scale)).cast("long")]
    if isinstance(kind, T.DecimalType):
        # Digits without the point, from a number of blanks wide enough for 38 of them.
        digits = F.lpad(F.translate(F.abs(value).cast("string"), ".", ""), 54, "0")
        sign = F.when(value < 0, F.lit(-1)).otherwise(F.lit(1))
        return [F.substring(digits, at, 18).cast("long") * sign for at in (1, 19, 37)]
    return [value.cast("long")]


def _prefix(words: int, shift: int) -> Column:
    """What is known of a value after a round: all words before the last one, and its upper bits."""
    return F.array(*[F.col(f"_w{i}") for i in range(words - 1)],
                   F.shiftright(f"_w{words - 1}", shift))


def _rounds(tally: DataFrame, words: int) -> list[tuple[int, int]]:
    """The (words, shift) of the digits in which any two values differ."""
    ends = tally.agg(*[f(f"_w{i}").alias(f"{f.__name__}{i}")
                       for i in range(words) for f in (F.min, F.max)]).first()
    return [(i + 1, s) for i in range(words) for s in SHIFTS
            if ends[f"min{i}"] is not None and ends[f"min{i}"] >> s != ends[f"max{i}"] >> s
            ] or [(words, 0)]


def _narrowed(tally: DataFrame, state: DataFrame, size: tuple[int, int], keys: list[str],
              now: tuple[int, int], before: tuple[int, int] | None) -> DataFrame:
    """The digit that holds each wanted rank: at most 65,536 counts for each prefix.

    ``state`` and the result have, per group and prefix, the ranks wanted and how many values lie
    below the prefix.
    """
    on = keys if before is None else [*keys, "_prefix"]
    rows = tally if before is None else tally.withColumn("_prefix", _prefix(*before))
    line = [*on, "_below", "_ranks"]
    counts = join_measured(rows, state, size, on).groupBy(*line, _prefix(*now).alias("_next")).agg(
        F.sum("_n").alias("_n"), F.min("_v").alias("_v"))
    running = Window.partitionBy(*line).orderBy("_next").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    held = counts.withColumn("_upto", F.col("_below") + F.sum("_n").over(running)).withColumn(
        "_ranks", F.expr("filter(_ranks, r -> r <= _upto and r > _upto - _n)"))
    return held.filter(F.size("_ranks") > 0).select(
        *keys, F.col("_next").alias("_prefix"), (F.col("_upto") - F.col("_n")).alias("_below"),
        "_ranks", "_v")


def _total(kind: T.DataType) -> Column:
    """The sum of the tallied values; NULL where that of whole numbers does not fit 64 bits."""
    if isinstance(kind, T.IntegralType):
        return F.sum(F.col("_v").cast("decimal(20,0)") * F.col("_n")).try_cast("long")
    return F.sum(F.col("_v") * F.col("_n"))


def summary_with_median(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Per group: ``n_rows``, ``count`` and ``total`` of the values, and their exact ``median``.

    The built-in exact percentile keeps all distinct values of a group in one task.  Here equal values
    are tallied in one pass over ``df`` and the tallies settled.  The middle ranks are then found digit
    by digit: a round counts, for the values that agree with what is known so far, the next 16 bits of
    their order-preserving image.  Digits in which no two values differ are skipped, so there are at
    most four rounds (nine for wide decimals), whatever the size and spread of a group.

    Rows without key are left out; a NULL value counts as a row only, and a group of NULL values has
    neither total nor median.  NaN is larger than all other numbers.
    """
    kind = df.schema[value].dataType
    images = ordered_words(F.col("_v"), kind)
    tally = settle(
        df.filter(present(*keys)).groupBy(*keys, F.col(value).alias("_v"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumns({f"_w{i}": image for i, image in enumerate(images)})
    )
    groups, size = settle_measured(
        tally.groupBy(*keys).agg(
            F.sum("_n").alias("n_rows"), _total(kind).alias("total"),
            F.coalesce(F.sum(F.when(F.col("_v").isNotNull(), F.col("_n"))), F.lit(0))
            .alias("count"),
        )
    )
    values = tally.filter("_v is not null")
    state, before = groups.filter("count > 0").select(
        *keys, F.lit(0).cast("long").alias("_below"),
        F.expr("array((count + 1) div 2, (count + 2) div 2)").alias("_ranks")), None
    for now in _rounds(values, len(images)):
        state, size = settle_measured(
            _narrowed(values, state.drop("_v"), size, keys, now, before))
        before = now
    # A middle value may hold both ranks.
    medians = state.groupBy(*keys).agg(
        (F.sum(F.col("_v").cast("double") * F.size("_ranks")) / 2).alias("median"))
    return groups.join(medians, keys, "left").select(*keys, "n_rows", "count", "total", "median")
