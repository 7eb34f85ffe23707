"""The temporal list join against a search through all entries."""

import datetime as dt
import random

from quillwork.llm import urlfilter as U

DAY = dt.date(2024, 1, 1)
LIST = "host string, path string, action string, at date"
PAGES = "page_id long, url string, fetched_at date, host string, hit string, levels int"


def on(n):
    return None if n is None else DAY + dt.timedelta(days=n)


def judged(spark, captures, changes):
    pages = spark.createDataFrame([(i, u, on(d), "x", "y", 1) for i, u, d in captures], PAGES)
    listed = spark.createDataFrame([(h, p, a, on(d)) for h, p, a, d in changes], LIST)
    return U.judge(pages, listed).collect()


def test_intervals_open_close_and_reopen(spark):
    changes = [("h.org", None, "block", 10), ("h.org", "", "block", 12), ("h.org", "", "remove", 20),
               ("h.org", "/a/", "allow", 15), ("h.org", "", "block", 30), (None, "", "block", 1),
               ("h.org", "a/b/c/d/e", "block", 0), ("H.ORG", "z", "wrong", 0), ("h.org", "q", "block", None)]
    captures = [(d, f"http://u@H.org.:80/{p}?q#f", d) for d in range(35) for p in ["x"]]
    captures += [(100 + d, "https://h.org//a//b", d) for d in range(35)]
    found = {r.page_id: r.blocked for r in judged(spark, captures, changes)}
    assert {d for d in range(35) if found[d]} == {*range(10, 20), *range(30, 35)}
    assert {d for d in range(35) if found[100 + d]} == {*range(10, 15)}


def test_odd_captures_are_allowed(spark):
    captures = [(1, None, 5), (2, "no url", 5), (3, "http://h.org/", None), (None, "http://h.org", 5),
                (5, "http://h.org", 5), (5, "http://h.org", 5), (6, "", 5), (7, "http://", 5)]
    found = judged(spark, captures, [("h.org", "", "block", 0), ("h.org", "", "allow", 0)])
    assert len(found) == 8
    assert sorted(str(r.page_id) for r in found if r.blocked) == ["5", "5", "None"]
    assert not any(r.blocked for r in judged(spark, captures, []))
    assert judged(spark, [], [("h.org", "", "block", 0)]) == []


def test_against_search(spark):
    rng = random.Random(7)
    hosts, levels = ["a.com", "b.org", "sub.a.com"], ["x", "y", "z"]
    changes = [(rng.choice(hosts), "/".join(rng.choices(levels, k=rng.randrange(4))),
                rng.choice(["block", "allow", "remove"]), rng.randrange(60)) for _ in range(150)]
    captures = [(i, f"http://{rng.choice(hosts)}/" + "/".join(rng.choices(levels, k=rng.randrange(6))),
                 rng.randrange(70)) for i in range(400)]

    def blocked(url, day):
        host, _, path = url.removeprefix("http://").partition("/")
        parts = [p for p in path.split("/") if p]
        for depth in range(min(4, len(parts)), -1, -1):
            past = [c for c in changes if c[0] == host and c[1] == "/".join(parts[:depth])
                    and c[3] <= day]
            if past:
                last = max(c[3] for c in past)
                actions = {c[2] for c in past if c[3] == last}
                action = next(a for a in ("block", "allow", "remove") if a in actions)
                if action != "remove":
                    return action == "block"
        return False

    found = {r.page_id: r.blocked for r in judged(spark, captures, changes)}
    assert found == {i: blocked(u, d) for i, u, d in captures}


def test_entries_of_any_depth(spark):
    """Entries apply as deep as the list names them."""
    deep = "/".join(f"l{i}" for i in range(60))
    changes = [("h.org", "", "block", 0), ("h.org", "a/b/c/d/e/f", "allow", 0), ("i.org", deep, "block", 5)]
    captures = [(1, "http://h.org/a/b/c/d/e/f/g", 3), (2, "http://h.org/a/b/c/d/e/x", 3),
                (3, f"http://i.org/{deep}", 4), (4, f"http://i.org/{deep}/more", 5),
                (5, f"http://i.org/{deep}x", 5), (6, "http://h.org/a/b/c/d/e/f", 3)]
    found = {r.page_id: (r.blocked, r.entry_path) for r in judged(spark, captures, changes)}
    assert found == {1: (False, "a/b/c/d/e/f"), 2: (True, ""), 3: (False, None), 4: (True, deep),
                     5: (False, None), 6: (False, "a/b/c/d/e/f")}


def test_no_python_in_the_plan(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    plan = U.judge(U.dated_captures(pages), U.dated_list(pages))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "CartesianProduct" not in plan
