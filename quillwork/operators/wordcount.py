"""Word counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillwork.functions.text import split_on_punctuation, split_on_space


def explode_words(df: DataFrame, text: str = "value", punctuation: bool = True,
                  unicode_spaces: bool = True) -> DataFrame:
    """One row per non-empty word; with ``punctuation`` words are also lower-cased."""
    pieces = split_on_punctuation if punctuation else split_on_space
    words = df.select(F.explode(pieces(F.col(text), unicode_spaces)).alias("word"))
    words = words.filter(F.col("word") != "")
    return words.select(F.lower("word").alias("word")) if punctuation else words


def word_count(df: DataFrame, text: str = "value", punctuation: bool = True,
               unicode_spaces: bool = True, partitions: int | None = None) -> DataFrame:
    """Occurrences of each word: ``(word, count)``.

    Counts are combined inside each input split before the shuffle, so a word that makes up a
    third of the text still arrives as one row per split.
    """
    if partitions:
        df = df.repartition(partitions)
    return explode_words(df, text, punctuation, unicode_spaces).groupBy("word").count()


def as_line(template: str, *columns: str) -> Column:
    """One text line per row, for example ``as_line("%s %d", "word", "count")``."""
    return F.format_string(template, *[F.col(c) for c in columns])
