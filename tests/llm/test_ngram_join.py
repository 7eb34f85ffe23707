"""The n-gram Jaccard join and connected components against brute force."""

import random
import re
from collections import defaultdict

import numpy as np
import pandas as pd
import pytest
from hypothesis import given
from hypothesis import strategies as st

from quillwork.llm import ngramjoin as J
from quillwork.llm.components import components
from quillwork.operators import sizing

SCHEMA = "doc_id long, text string, node string, root string, n string"


def plain_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i:i + 5]) for i in range(len(words) - 4))


def groups(n, links):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        root[find(a)] = find(b)
    return [find(i) for i in range(n)]


def expected(rows):
    sets = [plain_set(t) for _, t, *_ in rows]
    having, links = defaultdict(set), []
    for i, s in enumerate(sets):
        for x in s:
            having[x].add(i)
    for i, s in enumerate(sets):
        for j in {j for x in s for j in having[x] if j < i}:
            if 100 * len(s & sets[j]) >= 80 * len(s | sets[j]):
                links.append((i, j))
    members = defaultdict(list)
    roots = groups(len(rows), links)
    for row, r in zip(rows, roots):
        if row[0] is not None:
            members[r].append(row[0])
    return sorted(((row[0], len(s), min(members[r], default=None) if s else row[0])
                   for row, s, r in zip(rows, sets, roots)), key=str)


def found(spark, rows, parts=5):
    table = spark.createDataFrame([(i, t, "a", "b", None) for i, t in rows], SCHEMA)
    return sorted(map(tuple, J.ngram_groups(table.repartition(parts)).collect()), key=str)


def corpus(seed):
    """Near copies around the threshold, a chain, shared passages, tiny texts, exact copies."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    texts, base = [], rng.choices(words, k=120)
    for _ in range(150):
        near = list(base)
        for _ in range(rng.randrange(5)):
            near[rng.randrange(120)] = rng.choice(words)
        texts.append(near)
    chain = list(base)
    for _ in range(40):
        chain[rng.randrange(120)] = rng.choice(words)
        texts.append(list(chain))
    passages = [rng.choices(words, k=55) for _ in range(3)]
    for _ in range(150):
        texts.append(rng.choice(passages) + rng.choices(words, k=rng.choice([0, 1, 3, 8, 12, 30])))
    texts += [rng.choices(words[:3], k=rng.randint(1, 7)) for _ in range(80)]
    texts += [rng.choices(words, k=80) for _ in range(100)]
    texts += [rng.choice(texts) for _ in range(100)]
    return [(i + 1, " ".join(t)) for i, t in enumerate(texts)]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    rows = corpus(seed) + [(5000, ""), (5001, None), (5002, " \n"), (5003, "One TWO"),
                           (5004, "one\ttwo"), (5005, "ONE\x0btwo É"), (5006, "one two é")]
    assert found(spark, rows) == expected(rows)


def test_null_and_repeated_ids(spark):
    near = " ".join(f"a{i}" for i in range(60))
    rows = [(None, near), (None, near + " b"), (7, near + " c"), (7, "other words stand here now ok"),
            (3, near), (3, near), (None, None), (None, "alone is this text of six words")]
    assert found(spark, rows) == expected(rows)


def test_groups_of_copies_only_and_empty_table(spark):
    rows = [(i, "the same text in all of them") for i in range(50)]
    assert found(spark, rows) == [(i, 3, 0) for i in sorted(range(50), key=str)] or {
        r[2] for r in found(spark, rows)} == {0}
    assert found(spark, [], 1) == []


def test_long_text(spark):
    rng = random.Random(5)
    long = rng.choices([f"w{i}" for i in range(1000)], k=50_000)
    rows = [(1, " ".join(long)), (2, " ".join(long[:45_000])), (3, " ".join(long[:20_000]))]
    assert [r[2] for r in found(spark, rows)] == [1, 1, 3]


def test_steps_after_the_hubs_find_the_links_that_hubs_miss(spark, monkeypatch):
    """Without hubs, and with a bad hub for all nodes, every link is still found."""
    rows = corpus(3)[60:350]
    with monkeypatch.context() as m:
        m.setattr(J, "hubs_of", lambda cut: cut.select("node", J.F.col("node").alias("hub")).limit(0))
        assert found(spark, rows) == expected(rows)
    least = lambda cut: cut.select("node").distinct().join(
        cut.agg(J.F.min("node").alias("hub"))).filter("node <> hub")
    with monkeypatch.context() as m:
        m.setattr(J, "hubs_of", least)
        assert found(spark, rows) == expected(rows)


@given(st.sets(st.integers(0, 300), min_size=1), st.data())
def test_fronts_of_linked_sets_share_enough(items, data):
    """The bound behind the first step, on any two sets that link."""
    gone = data.draw(st.sets(st.sampled_from(sorted(items)), max_size=len(items) // 5))
    more = data.draw(st.sets(st.integers(0, 300), max_size=len(items) // 5))
    other = (items - gone) | more
    if not other or 100 * len(items & other) < 80 * len(items | other):
        return
    fronts = [set(sorted(s)[:J.front_length(len(s))]) for s in (items, other)]
    common = len(fronts[0] & fronts[1])
    assert common >= max(J.front_needed(len(items)), J.front_needed(len(other)))


@given(st.lists(st.tuples(st.integers(0, 6), st.integers(0, 5)), max_size=60), st.integers(1, 9))
def test_streaming_finds_all_shared_items(rows, batch):
    rows = sorted(rows)
    table = pd.DataFrame(rows, columns=["item", "short"], dtype="i8")
    parts = [table[i:i + batch] for i in range(0, len(rows), batch)]
    out = [tuple(r) for b in J.shared_in_order(iter(parts)) for r in b.to_numpy().tolist()]
    holders = defaultdict(set)
    for item, short in rows:
        holders[item].add(short)
    shared = {r for r in rows if len(holders[r[0]]) > 1}
    ends = {r for r in rows if r[0] in (rows[0][0], rows[-1][0])}
    assert len(out) == len(set(out)) and shared <= set(out) <= shared | ends


@given(st.lists(st.tuples(st.sets(st.integers(-50, 50)), st.sets(st.integers(-50, 50))), min_size=1))
def test_differences_of_fragments(parts):
    left, right = (pd.Series([[np.array(sorted(p[i]), "i8") for p in parts]]) for i in (0, 1))
    both = [J.differences(pd.Series([a]), pd.Series([b])) for a, b in zip(left[0], right[0])]
    assert [int(x.common.iloc[0]) for x in both] == [len(a & b) for a, b in parts]
    assert [set(x.only.iloc[0].tolist()) for x in both] == [a ^ b for a, b in parts]


def test_overlaps_of_fragments_are_summed_per_pair(spark):
    rng = random.Random(6)
    base = sorted(rng.sample(range(1000), 60))
    sets = {i: sorted({*rng.sample(base, rng.choice([40, 54, 58])), *rng.sample(range(2000, 2010), rng.randrange(3))})
            for i in range(12)}
    rows = [(b"%02d" % i, len(items), part, [x for x in items if x % 8 == part])
            for i, items in sets.items() for part in range(8)]
    cut = spark.createDataFrame(rows, "node binary, n long, part int, items array<long>")
    pairs = spark.createDataFrame([(b"%02d" % i, b"%02d" % j) for i in sets for j in sets if i < j],
                                  "a binary, b binary")
    got = {(int(bytes(r.a)), int(bytes(r.b))) for r in J.linked(pairs, cut).collect()}
    links = {(i, j) for i in sets for j in sets if i < j
             and 100 * len({*sets[i]} & {*sets[j]}) >= 80 * len({*sets[i]} | {*sets[j]})}
    assert got == links and 0 < len(links) < 66


def test_components_of_a_path_a_star_and_loops(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(200)] + [(500, 500 + i) for i in range(1, 300)]
    edges += [(900, 900), (None, 3), (5, None)] + [(rng.randrange(1000, 1300),
                                                    rng.randrange(1000, 1300)) for _ in range(150)]
    rng.shuffle(edges)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    links = [e for e in edges if None not in e and e[0] != e[1]]
    roots = groups(1300, links)
    least = {}
    for i in range(1300):
        least.setdefault(roots[i], i)
    assert got == {i: least[roots[i]] for i in {x for e in links for x in e}}


def test_small_tables_are_not_written_by_every_partition_of_a_shuffle(spark):
    """With many partitions that are not merged, links between a few nodes come in as many files as slots."""
    was = {k: spark.conf.get(k) for k in (
        "spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    for key, value in zip(was, ("40", "false")):
        spark.conf.set(key, value)
    try:
        edges = spark.createDataFrame([(i, i - i % 10) for i in range(400)], "a long, b long")
        found = components(edges)
        got = {r.node: r.root for r in found.collect()}
        files = found.inputFiles()
    finally:
        for key, value in was.items():
            spark.conf.set(key, value)
    assert got == {i: i - i % 10 for i in range(400)}
    assert len(files) <= spark.sparkContext.defaultParallelism


def test_bounds_of_few_files(spark):
    """Rows beyond what a file may hold get more files, up to the partitions there are."""
    wide = spark.range(0, 100, 1, 50)
    slots = spark.sparkContext.defaultParallelism
    assert sizing.in_few_files(wide, 0).rdd.getNumPartitions() == slots
    assert sizing.in_few_files(wide, 20 * sizing.ROWS_A_FILE + 1).rdd.getNumPartitions() == 21
    assert sizing.in_few_files(wide, 10 ** 9).rdd.getNumPartitions() == 50


@pytest.mark.parametrize("n", [1, 4, 5, 16, 99, 1000])
def test_front_in_sql_is_that_of_a_set(spark, n):
    assert spark.sql(f"select {J.FRONT} as f from (select {n}L as n)").first().f == J.front_length(n)
