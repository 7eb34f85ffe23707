"""Looking at physical plans."""

from __future__ import annotations

import contextlib
import io

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """What ``df.explain(mode)`` prints."""
    printed = io.StringIO()
    with contextlib.redirect_stdout(printed):
        df.explain(mode)
    return printed.getvalue()
