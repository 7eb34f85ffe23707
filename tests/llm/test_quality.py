"""Quality counts against a plain Python count, thresholds against sorted values."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quillwork.llm import quality as Q

SCHEMA = "doc_id long, text string, lang string, source string, n_words string, kept int, low int"
WORDS = " ".join(f"w{i}" for i in range(40))
TEXTS = [None, "", " \n\t ", "one", "a b c d e f g h", "a b c d e f g h " * 2, "x " * 50,
         WORDS, WORDS + "\n" + WORDS, f"{WORDS}\n\n{WORDS[:60]}\x0b{WORDS}", "#|a <b> $5 & 100%* ",
         "line\nline\n \nline\n\n\nother", "é ü\x1cß " * 9, "k\r\nk\r\nk\n", WORDS * 30]


def counted(text):
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(8)}
    lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\f\r")]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
            len(lines) - len(set(lines)), len(covered))


def test_counts(spark):
    rows = [(i, t, "en", "s", "clash", 1, 2) for i, t in enumerate(TEXTS)] + [
        (None, "null id", None, None, None, None, None)]
    found = Q.judge(spark.createDataFrame(rows + rows[:2], SCHEMA)).collect()
    assert len(found) == len(rows) + 2
    for r in found:
        text = TEXTS[r.doc_id] if r.doc_id is not None else "null id"
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert got == counted(text)
        assert r.base_failed == (got[0] < 20 or 100 * got[4] > 30 * got[0])
        assert not (r.base_failed and r.kept)


def test_a_very_long_text(spark):
    text = " ".join(f"w{i % 9000}" for i in range(100_000))
    row = Q.measures(spark.createDataFrame([(1, text, "en", "s", "", 0, 0)], SCHEMA)).first()
    assert row.n_repeat_words == 100_000


def test_buckets_keep_six_bits(spark):
    rows = spark.range(0, 5000).select("id", Q.bucket("id").alias("b")).collect()
    assert all(r.b <= r.id < r.b + max(1, r.b / 32 + 1) for r in rows)
    assert all(r.b == r.id for r in rows if r.id < 64)


def test_merged_sketches_equal_the_sketch_of_all(spark):
    rows = [(i, " ".join(f"{'ab'[j % 2] * (1 + i % 7)}{j}" for j in range(30)), "en", f"s{i % 3}",
             "", 0, 0) for i in range(90)]
    measured = Q.measures(spark.createDataFrame(rows, SCHEMA))
    sketch = Q.sketches(measured)
    merged = Q.limits(sketch, ["lang"])
    whole = Q.limits(sketch.withColumn("source", F.lit("one")), ["lang", "source"]).drop("source")
    assert sorted(merged.collect()) == sorted(whole.collect())


def row(i, text, lang="en", source="s"):
    return (i, text, lang, source, "", 0, 0)


def kept(spark, rows):
    return {r.doc_id: r.kept for r in Q.judge(spark.createDataFrame(rows, SCHEMA)).collect()}


def test_groups_have_their_own_limits(spark):
    """A source of long words keeps texts that another source rejects; a tiny one goes by its language."""
    short = " ".join(f"{chr(97 + i % 26)}{i:02}" for i in range(60))
    long = " ".join(f"{chr(97 + i % 26) * 20}{i:02}" for i in range(60))
    rows = [row(i, short, source="plain") for i in range(2000)]
    rows += [row(10_000 + i, long, source="long") for i in range(2000)]
    rows += [row(50_000, long, source="plain"), row(50_001, short, None, None), row(50_002, short, source="tiny")]
    verdicts = kept(spark, rows)
    assert not verdicts[50_000] and verdicts[50_001] and verdicts[50_002]
    assert all(v for k, v in verdicts.items() if k < 50_000)


def lines(i, n=12):
    return [" ".join(f"{chr(97 + (i + j) % 26)}{i % 7}{j}{k}x" for k in range(8)) for j in range(n)]


ODD = {  # each passes the base rules and breaks one rate of an otherwise plain corpus
    "word_length": " ".join(f"{'y' * 30}{k}" for k in range(96)),
    "symbols": "\n".join(lines(3)).replace("x ", "# "),
    "dup_lines": "\n".join([*lines(3), "short line", *["short line"] * 9]),
    "repeats": "\n".join([*lines(3), " ".join(["and", *lines(3)[4].split(), "again", *lines(3)[5].split()[:2]])]),
}


@pytest.mark.parametrize("name", ODD)
def test_each_rate_can_reject(spark, name):
    rows = [row(i, "\n".join(lines(i)), source=f"s{i % 3}") for i in range(300)] + [row(1000, ODD[name], source="s1")]
    found = {r.doc_id: r for r in Q.judge(spark.createDataFrame(rows, SCHEMA)).collect()}
    if name == "repeats":  # one repeated window is within the slack, three are not
        assert found[1000].kept and not found[1000].base_failed
        more = "\n".join([*lines(3), lines(3)[4], "and", lines(3)[7]])
        found = {r.doc_id: r for r in Q.judge(spark.createDataFrame([*rows[:-1], row(1000, more, source="s1")],
                                                                    SCHEMA)).collect()}
    assert not found[1000].base_failed and not found[1000].kept
    assert all(r.kept for i, r in found.items() if i < 1000)


def test_limits_move_little_with_one_row(spark):
    sizes = [1, 2, 5, 20, 199, 200, 201, 1000]
    rows = [(f"s{n}", "symbols", 7 * i % 40, 1) for n in sizes for i in range(n)]
    rows += [("base", "symbols", 20, 900)]
    sketch = spark.createDataFrame(rows, "source string, rate string, bucket long, n long").selectExpr(
        "'en' as lang", "source", "rate", "bucket", "n")
    high = {r.source: r.high_symbols for r in Q.thresholds(sketch).collect()}
    assert abs(high["s200"] - high["s199"]) <= 5 and abs(high["s201"] - high["s200"]) <= 5
    assert abs(high["s2"] - high["s1"]) <= 20


def test_no_python_in_the_plan(spark):
    plan = Q.judge(spark.createDataFrame([(1, "a", "en", "s", "", 0, 0)], SCHEMA))
    for df in (plan, Q.measures(spark.createDataFrame([(1, "a", "e", "s", "", 0, 0)], SCHEMA))):
        text = df._jdf.queryExecution().toString()
        assert "Python" not in text and "Pandas" not in text


def test_empty_table(spark):
    assert Q.judge(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("n", [0, 1])
def test_clean_words_are_kept(spark, n):
    rows = [(i, WORDS, None if n else "en", "s", "", 0, 0) for i in range(5)]
    assert all(r.kept for r in Q.judge(spark.createDataFrame(rows, SCHEMA)).collect())
