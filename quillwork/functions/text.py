"""Tokenising text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillwork.functions.fixed import ASCII_WHITESPACE, PUNCTUATION, UNICODE_WHITESPACE


def _pieces(text: Column, separators: str) -> Column:
    # Turning every separator into one blank and cutting at single blanks takes about a third of
    # the time of a regular-expression split; runs of separators only add empty pieces.
    return F.split(F.translate(text, separators, " " * len(separators)), " ")


def split_on_space(text: Column, unicode_spaces: bool = True) -> Column:
    """Pieces between whitespace characters; runs of whitespace leave empty pieces."""
    return _pieces(text, ASCII_WHITESPACE + (UNICODE_WHITESPACE if unicode_spaces else ""))


def split_on_punctuation(text: Column, unicode_spaces: bool = True) -> Column:
    """Pieces between ASCII punctuation or whitespace; runs leave empty pieces."""
    return _pieces(
        text, PUNCTUATION + ASCII_WHITESPACE + (UNICODE_WHITESPACE if unicode_spaces else "")
    )
