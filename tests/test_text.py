import random
import re
import string
from collections import Counter

from quillwork.operators.wordcount import as_line, word_count

TEXTS = [
    "The cat; the CAT, and a dog.", "", "   ", "tab\tnew\nline\r\nend", "a--b__c",
    "no break em　wide", "Élan élan ÉLAN", "x\x1cy\x85z", "!!!", "it's [odd] \\ `q`",
]


def counted(df):
    return {r["word"]: r["count"] for r in df.collect()}


def test_word_count_matches_python(lines):
    rng = random.Random(3)
    alphabet = string.ascii_letters + string.punctuation + " \t\n  é"
    texts = TEXTS + ["".join(rng.choice(alphabet) for _ in range(200)) for _ in range(50)]
    separators = re.compile(r"[%s\s]+" % re.escape(string.punctuation))
    expected = Counter(w.lower() for t in texts for w in separators.split(t) if w)
    assert counted(word_count(lines(*texts))) == expected


def test_plain_word_count_matches_python(lines):
    expected = Counter(w for t in TEXTS for w in t.split())
    assert counted(word_count(lines(*TEXTS), punctuation=False)) == expected


def test_ascii_spaces_only(lines):
    assert counted(word_count(lines("a b c"), unicode_spaces=False)) == {"a b": 1, "c": 1}


def test_repartition_keeps_counts(lines):
    table = lines(*TEXTS)
    assert counted(word_count(table, partitions=7)) == counted(word_count(table))


def test_lines_are_formatted(lines):
    out = word_count(lines("b a b")).select(as_line("%s %d", "word", "count").alias("value"))
    assert sorted(r[0] for r in out.collect()) == ["a 1", "b 2"]
