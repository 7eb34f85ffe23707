import pytest

from quillwork.plans.inspect import plan_text
from quillwork.operators import scores, sizing

ROWS = [
    ("news", 4, "ann"), ("news", 0, "bob"), ("news", 2, "cid"),
    ("trolls", -5, "dan"), ("trolls", 3, "eve"),
    ("zero", 0, "fay"), ("art", 8, "gus"),
]


def comments(spark, rows=ROWS):
    return spark.createDataFrame(rows, "subreddit string, score bigint, author string")


@pytest.mark.parametrize("strategy", ["broadcast", "shuffle"])
def test_relative_score_drops_groups_without_positive_mean(spark, strategy):
    out = scores.relative_score(comments(spark), strategy=strategy)
    assert sorted((r.author, r.relative_score) for r in out.collect()) == [
        ("ann", 2.0), ("bob", 0.0), ("cid", 1.0), ("gus", 1.0)
    ]


def test_strategies_agree_on_a_hot_group(spark, monkeypatch):
    rows = [("hot", i % 7, f"h{i}") for i in range(900)]
    rows += [(f"g{i % 300}", i, f"c{i}") for i in range(1800)]
    df = comments(spark, rows).repartition(5)
    wanted = sorted(map(tuple, scores.relative_score(df).collect()))
    assert sorted(map(tuple, scores.relative_score(df, strategy="shuffle").collect())) == wanted
    monkeypatch.setattr(sizing, "MAX_BROADCAST_ROWS", 10)
    assert sorted(map(tuple, scores.relative_score(df).collect())) == wanted


def test_hot_rows_are_spread(spark):
    facts = spark.range(0, 4000).selectExpr("if(id % 3 = 0, 'hot', cast(id as string)) k", "id")
    counts = facts.groupBy("k").count()
    hot = sizing.hot_keys(counts, ["k"], "count")
    assert [r.k for r in hot.collect()] == ["hot"]
    lookup = counts.selectExpr("k", "count as n")
    out = sizing.join_salted(facts, lookup, ["k"], hot)
    assert "rand(" not in plan_text(out)
    assert out.count() == 4000
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = out.selectExpr("k", "spark_partition_id() p").filter("k = 'hot'")
        assert placed.select("p").distinct().count() > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_split_by_sign(spark):
    out = scores.select_and_sign(comments(spark))
    assert sorted((r.author, r.sign) for r in out.collect()) == [
        ("ann", "positive"), ("bob", "negative"), ("cid", "positive"), ("fay", "negative")
    ]
    strict = scores.select_and_sign(comments(spark), include_zero=False)
    assert sorted(r.author for r in strict.collect()) == ["ann", "cid"]


def test_group_mean_and_preview(spark):
    means = {r.subreddit: r["mean"] for r in scores.group_mean(comments(spark), "subreddit", "score").collect()}
    assert means == {"news": 2.0, "trolls": -1.0, "zero": 0.0, "art": 8.0}
    top = scores.preview_top(scores.relative_score(comments(spark)), "relative_score", 2, "author")
    assert [r.author for r in top.collect()] == ["ann", "cid"]


def test_unknown_strategy(spark):
    with pytest.raises(ValueError):
        scores.relative_score(comments(spark), strategy="guess")


def test_shuffled_lookup_splits_a_hot_key(spark):
    from quillwork.session import settle

    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k, None) for k in small}
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        facts = settle(spark.range(0, 90_000, 1, 6).selectExpr(
            "if(id % 3 = 0, 0, id % 5000) as k", "uuid() as payload"))
        lookup = settle(spark.range(5000).selectExpr("id as k", "id * 2 as v"))
        out = sizing.join_measured(facts, lookup, (10**12, 10**12), ["k"])
        assert len(out.collect()) == 90_000
        assert "skew=true" in plan_text(out, "simple")
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
