"""Calendar helpers that do not depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillwork.functions.fixed import MONTH_NAMES, PAGE_FILE_HOUR_PATTERN


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hour_from_path(path: Column | str) -> Column:
    """``YYYYMMDD-HH`` out of a ``.../pagecounts-YYYYMMDD-HH...`` path; NULL for other paths."""
    hour = F.regexp_extract(_col(path), PAGE_FILE_HOUR_PATTERN, 1)
    return F.nullif(hour, F.lit(""))


def hour_bucket(ts: Column | str) -> Column:
    """``YYYYMMDD-HH`` of a timestamp without time zone."""
    return F.translate(F.substring(_col(ts).cast("string"), 1, 13), " -", "-")


def is_weekend(date: Column | str) -> Column:
    """True on Saturday and Sunday."""
    return F.dayofweek(_col(date)).isin(1, 7)


def log_time(text: Column | str) -> Column:
    """``dd/Mon/yyyy:HH:mm:ss`` as a timestamp without zone; NULL when it is not a valid time.

    The zone offset of the log line is not applied: times stay local to the server.
    """
    raw = _col(text)
    month = F.array_position(F.array(*[F.lit(m) for m in MONTH_NAMES]), F.substring(raw, 4, 3))
    iso = F.concat(
        F.substring(raw, 8, 4), F.lit("-"),
        F.lpad(month.cast("string"), 2, "0"), F.lit("-"),
        F.substring(raw, 1, 2), F.lit(" "),
        F.substring(raw, 13, 8),
    )
    return F.when(raw.like("__/___/____:__:__:__"), iso.try_cast("timestamp_ntz"))
