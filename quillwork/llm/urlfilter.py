"""URL filters as a temporal list join.

A list is a history of dated changes: from its date on, an entry blocks or allows a host, or a host
with a path prefix.  Changes of one entry become validity intervals by looking at the next change.
Every capture is judged by the entries active when it was fetched: an as-of join, expressed as equal
keys (host, or host and one of the path's prefixes) with the interval as a filter.  The most
specific active entry decides; among equals blocking does.

Only built-in functions are used.  Changes that do not alter the state are merged first, and a
host that a third of all captures have is a skewed key of an ordinary join, which adaptive execution
splits; a capture yields one row per prefix of its path of a depth that entries of the list have.

Defined results: a null URL, or one without a host, or a null fetch time, matches nothing and is
allowed; of several changes of an entry at one time blocking wins; an entry with a null host or date
is void; the end of an interval is exclusive; captures repeated are judged each; an empty list
allows everything; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def host_of(url: Column) -> Column:
    """The lower-case host of an absolute URL, without user, port and a final dot; else null."""
    place = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    host = F.rtrim(place, F.lit("."))
    return F.when(host != "", host)


def path_levels(url: Column) -> Column:
    """The non-empty levels of the path, without query and fragment."""
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    return F.filter(F.split(path, "/"), lambda x: x != "")


def intervals(changes: DataFrame) -> DataFrame:
    """``host, path, action, valid_from, valid_to`` from changes ``host, path, action, at``.

    ``action`` is block, allow or remove; a removed entry leaves a gap.  ``path`` is null or empty
    for a whole host, else levels joined by slashes.
    """
    clean = valid(changes)
    first = F.min(F.struct(F.expr("case action when 'block' then 0 when 'allow' then 1 else 2 end"),
                           F.col("action"))).alias("best")
    at_once = clean.groupBy("host", "path", "at").agg(first).select(
        "host", "path", "at", F.col("best.action").alias("action"))
    entry = Window.partitionBy("host", "path").orderBy("at")
    turned = at_once.withColumn("before", F.lag("action").over(entry)).filter(
        "before is null or before <> action")
    return turned.withColumn("valid_to", F.lead("at").over(entry)).filter(
        "action <> 'remove'").select(
        "host", "path", "action", F.col("at").alias("valid_from"), "valid_to")


def valid(changes: DataFrame) -> DataFrame:
    """The changes that name a host, a date and a known action, in plain form."""
    return changes.select(
        F.lower("host").alias("host"),
        F.array_join(F.filter(F.split(F.coalesce("path", F.lit("")), "/"), lambda x: x != ""), "/")
        .alias("path"), "action", "at",
    ).filter("host is not null and at is not null and action in ('block', 'allow', 'remove')")


def depths(changes: DataFrame) -> DataFrame:
    """One row: the numbers of path levels that entries have."""
    return valid(changes).agg(F.collect_set(
        F.expr("if(path = '', 0, size(split(path, '/')))")).alias("depths"))


def judge(captures: DataFrame, changes: DataFrame, id_col: str = "page_id", url_col: str = "url",
          time_col: str = "fetched_at") -> DataFrame:
    """Per capture: id, host, fetch time, the entry that decided, and ``blocked``."""
    url = F.col(url_col)
    rows = captures.select(
        F.col(id_col).alias("id"), url.alias("url"), F.col(time_col).alias("time"),
        host_of(url).alias("host"), path_levels(url).alias("levels"))
    row = F.struct("id", "url", "time", "host")
    # One key per depth that the list has and the path reaches; depth 0 is the host alone.  The list's
    # depths are a short list of numbers, read when this is called.
    row_of_depths = depths(changes).first()
    listed_depths = F.array(*[F.lit(d) for d in sorted(row_of_depths.depths)]).cast("array<int>")
    keys = F.transform(F.filter(listed_depths, lambda i: i <= F.size("levels")), lambda i: F.struct(
        i.alias("depth"), F.array_join(F.slice("levels", F.lit(1), i), "/").alias("path")))
    asked = rows.filter("host is not null and time is not null").select(
        row.alias("row"), "host", F.explode(keys).alias("key")).select(
        "row", "host", "key.depth", F.col("key.path").alias("path"), F.col("row.time").alias("time"))
    listed = intervals(changes)
    active = asked.join(listed, ["host", "path"]).filter(
        "time >= valid_from and (valid_to is null or time < valid_to)")
    winner = active.groupBy("row").agg(F.max(F.struct(
        "depth", (F.col("action") == "block").alias("blocked"), "path", "valid_from")).alias("hit"))
    hits = winner.select(
        F.col("row.id").alias("h_id"), F.col("row.url").alias("h_url"),
        F.col("row.time").alias("h_time"), "hit")
    joined = rows.join(hits, F.col("id").eqNullSafe(F.col("h_id")) & (F.col("url") == F.col("h_url"))
                       & (F.col("time") == F.col("h_time")), "left")
    return joined.select(
        F.col("id").alias("page_id"), "host", F.col("time").alias("fetched_at"),
        F.col("hit.path").alias("entry_path"), F.col("hit.valid_from").alias("entry_from"),
        F.coalesce("hit.blocked", F.lit(False)).alias("blocked"))


def number_of(text: Column) -> Column:
    """28 bits of a text's md5."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 7), 16, 10).cast("long")


def dated_list(pages: DataFrame, url_col: str = "url") -> DataFrame:
    """A list for tables that bring none: changes made from the hosts and paths of the pages.

    Of every host, and host with first level, a hash decides whether and when it is blocked,
    allowed again and removed, between days 0 and 364 of 2024.
    """
    url = F.col(url_col)
    whole = pages.select(host_of(url).alias("host"), path_levels(url).alias("levels")).select(
        "host", F.explode(F.array(F.lit(""), F.coalesce(F.get("levels", F.lit(0)), F.lit(""))))
        .alias("path")).filter("host is not null").distinct()
    seed = number_of(F.concat_ws("/", "host", "path"))
    steps = whole.select("host", "path", seed.alias("seed")).filter("seed % 3 <> 0").select(
        "host", "path", "seed", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("step"))
    action = F.expr("case (seed div 3 + step) % 3 when 0 then 'block' when 1 then 'allow' "
                    "else 'remove' end")
    day = F.expr("cast((seed div 9 + 97 * step) % 365 as int)")
    return steps.select("host", "path", action.alias("action"),
                        F.date_add(F.lit("2024-01-01").cast("date"), day).alias("at"))


def dated_captures(pages: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Pages with a fetch day from a hash of their id, for tables that bring none."""
    day = (number_of(F.col(id_col).cast("string")) % 365).cast("int")
    return pages.select(id_col, url_col, F.date_add(
        F.lit("2024-01-01").cast("date"), day).alias("fetched_at"))
