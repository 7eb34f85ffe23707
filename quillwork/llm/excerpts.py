"""Bounded excerpts of long texts, for samples that models are fitted on."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def stretches(text: Column, most: Column, pieces: int = 16) -> Column:
    """A text of at most ``most`` characters as it is; of a longer one, stretches spread evenly from
    its first to its last character, joined by blanks, with ``most`` characters in all."""
    size = F.greatest(F.floor((most + 1) / pieces) - 1, F.lit(1)).cast("int")
    places = F.transform(F.sequence(F.lit(0), F.lit(pieces - 1)), lambda i: F.floor(
        i.cast("long") * (F.length(text) - size) / (pieces - 1)).cast("int"))
    return F.when(F.length(text) <= most, text).otherwise(F.array_join(
        F.transform(places, lambda at: F.substring(text, at + 1, size)), " "))
