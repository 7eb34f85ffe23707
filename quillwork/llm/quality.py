"""Quality rules with thresholds that follow each language and source.

Every text is measured with built-in functions inside its own row.  Rates of the texts that pass the
base rules are counted in log-linear buckets per language, source and rate: a quantile sketch of
bounded size and relative error (1/32) that merges by adding counts, so it is combined in each map
task, a language's sketch is the sum of its sources', and a repeated task gives the same counts.

Limits are read off the sketches and replace fixed cutoffs.  Word lengths may lie ``REACH`` times as far
from the median as the nine tenths in the middle do (at least by the sketch's relative error), symbols
``REACH`` times as far above it; repeated lines and words may reach the 99th percentile.  A group's
limits are averaged with its language's, which count as ``PRIOR`` rows, and a language's with those of
all rows, so a group of any size is judged alike and one row more changes little.  A text may have a
few occurrences more than its limit (``SLACK``): in a short one a single occurrence is a high rate.  The
limits, one row per group, are joined back to the measures.

Defined results: null text has no words and fails the base rules; a null language or source is a
group of its own; repeated rows count as often as they occur; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillwork.session import settle

# White space, symbols, window and limits of the base rules.
BLANK_CHARS = " \t\n\x0b\f\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"
NO_SYMBOL = r"[^#*$%&|<>]+"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

# Rates as whole numbers: (name, scale, numerator, denominator).
RATES = (
    ("word_length", 100, "word_chars", "n_words"),
    ("symbols", 1000, "n_symbols", "n_words"),
    ("dup_lines", 1000, "n_dup_lines", "n_lines"),
    ("repeats", 1000, "n_repeat_words", "n_words"),
)
# Occurrences a text may have beyond its limit: of repeated words one repeated window, both times.
SLACK = {"symbols": 2, "dup_lines": 1, "repeats": 2 * WINDOW}
REACH = 6
PRIOR = 200


def split_words(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(BLANK_CHARS))
    return F.when(F.coalesce(trimmed, F.lit("")) == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, BLANK_RUN))


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``doc_id, lang, source`` and the counts of every whole text.

    Windows are hashed within the row, and only texts with an equal pair of hashes look further:
    they sort (hash, place) and add up how far the repeated windows reach.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(
        F.col(id_col).alias("doc_id"), F.col(lang_col).alias("lang"),
        F.col(source_col).alias("source"), split_words(text).alias("words"),
        F.length(F.regexp_replace(text, NO_SYMBOL, "")).cast("long").alias("n_symbols"),
        F.filter(F.split(text, "\n"),
                 lambda x: F.btrim(x, F.lit(BLANK_CHARS)) != "").alias("lines"),
    )
    n_windows = F.size("words") - WINDOW
    windows = F.when(n_windows >= 0, F.transform(
        F.sequence(F.lit(0), n_windows),
        lambda i: F.xxhash64(F.slice("words", i + 1, WINDOW))))
    hashed = base.select(
        "doc_id", "lang", "source", "n_symbols",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        windows.alias("hashes"),
    )
    counts = ["doc_id", "lang", "source", "n_symbols", "n_words", "word_chars", "n_lines",
              "n_dup_lines"]
    ordered = hashed.select(*counts, F.when(
        F.size(F.array_distinct("hashes")) < F.size("hashes"),
        F.sort_array(F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    ).alias("ordered"))
    follows = F.zip_with("ordered", F.slice("ordered", 2, F.size("ordered")),
                         lambda x, y: F.coalesce(x["h"] == y["h"], F.lit(False)))
    paired = ordered.select(*counts, "ordered", follows.alias("follows"))
    repeated = F.zip_with(
        F.zip_with("ordered", "follows", lambda x, f: F.when(f, x["i"]).otherwise(-1 - x["i"])),
        F.concat(F.array(F.lit(False)), F.slice("follows", 1, F.size("follows") - 1)),
        lambda i, f: F.when(f & (i < 0), -1 - i).otherwise(i))
    placed = paired.select(*counts, F.sort_array(
        F.filter(repeated, lambda i: i >= 0)).alias("places"))
    reach = F.zip_with("places", F.slice("places", 2, F.size("places")),
                       lambda a, b: F.least(F.coalesce(b - a, F.lit(WINDOW)), F.lit(WINDOW)))
    return placed.select(*counts, F.when(F.size("places") > 0, F.aggregate(
        reach, F.lit(0), lambda total, x: total + x)).otherwise(0).cast("long")
        .alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def rate(scale: int, part: str, whole: str) -> Column:
    """A whole number; zero where the whole is zero."""
    return F.expr(f"if({whole} > 0, ({scale} * {part}) div {whole}, 0L)")


def bucket(value: str) -> Column:
    """Lower end of the log-linear bucket of a non-negative number: its first six bits."""
    shift = f"greatest(length(bin({value})) - 6, 0)"
    return F.expr(f"shiftleft(shiftright({value}, {shift}), {shift})")


def sketches(measured: DataFrame) -> DataFrame:
    """Counts per language, source, rate and bucket over the rows that pass the base rules."""
    values = F.array(*[
        F.struct(F.lit(name).alias("rate"), rate(scale, part, whole).alias("value"))
        for name, scale, part, whole in RATES])
    return (
        measured.filter(~base_failed())
        .select("lang", "source", F.explode(values).alias("x"))
        .select("lang", "source", "x.rate", bucket("x.value").alias("bucket"))
        .groupBy("lang", "source", "rate", "bucket").agg(F.count("*").alias("n"))
    )


def limits(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """Rows, ``low`` and ``high`` per rate of the sketches merged to ``keys``."""
    group = [*keys, "rate"]
    merged = sketch.groupBy(*group, "bucket").agg(F.sum("n").alias("n"))
    part = "partition by " + ", ".join(group)
    ranked = merged.select(*group, "bucket", F.expr(f"sum(n) over ({part})").alias("rows"),
                           F.expr(f"sum(n) over ({part} order by bucket)").alias("upto"))
    reached = 100 * F.col("upto")
    points = ranked.groupBy(*group).agg(
        F.first("rows").alias("rows"),
        *[F.min(F.when(reached >= q * F.col("rows"), F.col("bucket"))).alias(f"q{q}")
          for q in (5, 10, 50, 90, 99)])
    length = F.col("rate") == "word_length"
    down = F.greatest(F.expr("q50 - q5"), F.expr("q50 div 32"))
    up = F.greatest(F.expr("q90 - q50"), F.when(length, F.expr("q50 div 32")).otherwise(F.lit(0)))
    high = F.when(F.col("rate").isin("dup_lines", "repeats"), F.col("q99")).otherwise(
        F.col("q50") + REACH * up)
    return points.select(*group, "rows", F.when(length, F.col("q50") - REACH * down).otherwise(
        F.lit(0)).cast("long").alias("low"), high.cast("long").alias("high"))


def thresholds(sketch: DataFrame, prior: int = PRIOR) -> DataFrame:
    """One row per language and source with ``low_<rate>`` and ``high_<rate>``."""
    def renamed(df: DataFrame, tag: str) -> DataFrame:
        return df.select(*[F.col(c).alias(f"{tag}_{c}") for c in df.columns])

    def averaged(rows: str, own: str, wide: Column) -> Column:
        """The limit of so many rows, and of ``prior`` rows like the wider group."""
        return F.floor((F.col(rows) * F.col(own) + prior * wide) / (F.col(rows) + prior))

    own = limits(sketch, ["lang", "source"])
    wide, all_rows = renamed(limits(sketch, ["lang"]), "l"), renamed(limits(sketch, []), "a")
    joined = own.join(wide, F.col("lang").eqNullSafe(F.col("l_lang")) & (
        F.col("rate") == F.col("l_rate"))).join(all_rows, F.col("rate") == F.col("a_rate"))
    picked = joined.select("lang", "source", "rate", *[
        averaged("rows", end, averaged("l_rows", f"l_{end}", F.col(f"a_{end}"))).alias(end)
        for end in ("low", "high")])
    return picked.groupBy("lang", "source").agg(*[
        F.max(F.when(F.col("rate") == name, F.col(end))).alias(f"{end}_{name}")
        for name, *_ in RATES for end in ("low", "high")])


def judge(docs: DataFrame, prior: int = PRIOR, **columns: str) -> DataFrame:
    """Counts, ``base_failed`` and ``kept`` of every row of ``docs``.

    The counts are written to the shared folder when this is called, and read from there for the
    sketches and for the result.
    """
    measured = settle(measures(docs, **columns))
    found = thresholds(sketches(measured), prior).select(
        F.col("lang").alias("t_lang"), F.col("source").alias("t_source"),
        *[f"{end}_{name}" for name, *_ in RATES for end in ("low", "high")])
    joined = measured.join(found, F.col("lang").eqNullSafe(F.col("t_lang"))
                           & F.col("source").eqNullSafe(F.col("t_source")), "left")
    inside = rate(*RATES[0][1:]) >= F.col("low_word_length")
    for name, scale, part, whole in RATES:
        if name in SLACK:
            inside &= (F.col(part) - SLACK[name]) * scale <= F.col(f"high_{name}") * F.col(whole)
        else:
            inside &= rate(scale, part, whole) <= F.col(f"high_{name}")
    failed = base_failed()
    return joined.select(
        "doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words", failed.alias("base_failed"),
        (~failed & F.coalesce(inside, F.lit(False))).alias("kept"))
