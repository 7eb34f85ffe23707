"""Time the headline queries and print one JSON line.

Reads ``BENCH_SF_DIR`` (default the 0.1 tables) on ``local[BENCH_CPUS]``.  Every headline query runs once
to warm up and is then timed to full evaluation; the best of two runs is reported.  The training-data
queries run once each.  ``headlines_only`` is the total to compare with benches without those.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from quillwork.operators import wordcount  # noqa: E402
from quillwork.plans import inputs as I  # noqa: E402
from quillwork.plans.queries import QUERIES  # noqa: E402
from quillwork.session import get_spark, new_path  # noqa: E402

HEADLINES = [
    "word_count", "word_count_plain", "max_per_key", "argmax_per_key", "argmax_ties",
    "argmax_ties_window", "group_mean", "filter_split", "relative_score",
    "relative_score_broadcast", "tmax_etl", "daily_range", "daily_range_sql", "store_comparison",
    "calendar_features", "parse_log", "log_host_correlation", "moments", "linear_fit",
    "star_avg_by_method", "segment_three_way", "ilike_semi", "five_day_avg", "dq_checks",
    "lagged_feature", "lagged_feature_window", "rgb_to_lab", "rgb_to_hsv", "shortest_paths",
    "stream_regression", "clustered_range", "json_ledger", "batched_inserts",
    "ordered_days", "stream_restart", "vector_assembly",
]


def evaluate(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def training_data() -> dict:
    """The training-data queries, where that subpackage is present; they take longer and run once."""
    try:
        import corpus_pipeline
        from quillwork.llm.queries import QUERIES as LLM
    except ImportError:
        return {}
    return {**LLM, "pipeline": corpus_pipeline.run}


def once(run) -> float:
    start = time.perf_counter()
    run()
    return round(time.perf_counter() - start, 3)


def best_of(run, times: int = 2) -> float:
    run()
    best = float("inf")
    for _ in range(times):
        start = time.perf_counter()
        run()
        best = min(best, time.perf_counter() - start)
    return round(best, 3)


def comparisons(spark, sf_dir: str) -> dict[str, float]:
    """Relative measures: input spread of word count, and pruned against full scans."""
    out = {}
    docs = I.table(spark, sf_dir, "documents")
    for parts in (None, 8, 20, 50):
        name = f"word_count_{parts or 'no'}_repartition"
        out[name] = best_of(lambda: evaluate(wordcount.word_count(docs, "text", partitions=parts)))
    sales = I.daily_purchases(spark, sf_dir).selectExpr("*", "month(pdate) as pmonth")
    by_month, text = new_path(spark, "by-month"), new_path(spark, "text")
    sales.repartition("pmonth").write.partitionBy("pmonth").parquet(by_month)
    sales.write.csv(text)
    days = "dayofmonth(pdate) in (1, 2, 3, 4, 5)"
    pruned = spark.read.parquet(by_month).filter("pmonth = 8").filter(days)
    full = spark.read.schema(sales.schema).csv(text).filter("month(pdate) = 8").filter(days)
    for name, rows in (("five_day_pruned_columnar", pruned), ("five_day_full_text", full)):
        report = rows.groupBy("pdate").avg("amount")
        out[name] = best_of(lambda: evaluate(report))
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_spark(
        "quillwork-bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINES:
        seconds[name] = best_of(lambda: evaluate(QUERIES[name](spark, sf_dir)))
    extra = comparisons(spark, sf_dir)
    headlines = round(sum(seconds.values()), 3)
    for name, query in training_data().items():
        seconds[name] = once(lambda: evaluate(query(spark, sf_dir)))
    print(json.dumps({
        "metric": "total seconds over headline and training-data queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "headlines_only": headlines,
        "queries": seconds,
        "comparisons": extra,
        "sf": Path(sf_dir).name.removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
