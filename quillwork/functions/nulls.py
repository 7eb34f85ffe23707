"""Null tests that reach the scan."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def present(*columns: str) -> Column:
    """True where no column is NULL; unlike ``dropna`` the test is pushed into the file reader."""
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
