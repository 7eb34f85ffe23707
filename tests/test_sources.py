import gzip
import json
import subprocess
import sys
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from quillwork import schemas
from quillwork.operators.ordering import positioned
from quillwork.plans.inspect import plan_text
from quillwork.sources import catalog, readers, writers

ROOT = Path(__file__).resolve().parents[1]


def written(path):
    return sorted(
        line for file in path.rglob("part-*") if not file.name.endswith(".crc")
        for line in file.read_text().splitlines()
    )


def test_text_json_and_split_writers(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.5, "up"), ('q"', None, "down")], "k string, v double, s string")
    writers.text(df, str(tmp_path / "t"), F.concat_ws(" ", "k", "s"))
    assert written(tmp_path / "t") == ["a up", 'q" down']
    writers.tab_separated(df.select("k", "v"), str(tmp_path / "tsv"))
    assert "a\t1.5" in written(tmp_path / "tsv")
    writers.json_arrays(df, str(tmp_path / "j"), ["k", "v"])
    assert sorted(map(json.loads, written(tmp_path / "j"))) == [["a", 1.5], ['q"', None]]
    writers.split(df, str(tmp_path / "s"), "s")
    assert {p.name for p in (tmp_path / "s").glob("s=*")} == {"s=up", "s=down"}
    writers.csv(df, str(tmp_path / "c"))
    writers.csv(df, str(tmp_path / "c"))
    assert len(written(tmp_path / "c")) == 2


def test_gzip_json_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a", 1)], "k string, v int")
    writers.json(df, str(tmp_path / "g"), compression="gzip")
    assert list((tmp_path / "g").glob("*.json.gz"))
    assert readers.json_lines(spark, str(tmp_path / "g"), df.schema).collect() == df.collect()


def test_batches(spark):
    sizes = spark.sparkContext.accumulator(0)
    calls = spark.sparkContext.accumulator(0)

    def send(rows):
        assert len(rows) <= 301
        sizes.add(len(rows))
        calls.add(1)

    writers.in_batches(spark.range(0, 1000, 1, 2), send)
    assert (sizes.value, calls.value) == (1000, 4)


def sent_once(spark, tmp_path, fails):
    """Rows in batches of 30 to a receiver that fails after taking the batches named."""
    log, ledger = tmp_path / "log", str(tmp_path / "ledger")
    log.mkdir(exist_ok=True)
    folder = str(log)

    def send(rows):
        import os
        import uuid
        ids = [r.id for r in rows]
        with open(os.path.join(folder, f"{min(ids)}-{uuid.uuid4().hex}"), "w") as f:
            f.write(" ".join(map(str, ids)))
        if min(ids) in fails:
            raise RuntimeError("receiver gone")

    writers.in_batches(spark.range(0, 200, 1, 2), send, size=30, ledger=ledger)


def received(tmp_path):
    return [sorted(map(int, f.read_text().split())) for f in (tmp_path / "log").iterdir()]


def test_a_ledger_sends_marked_batches_once(spark, tmp_path):
    with pytest.raises(Exception, match="receiver gone"):
        sent_once(spark, tmp_path, {60})
    sent_once(spark, tmp_path, set())
    sent_once(spark, tmp_path, set())
    batches = received(tmp_path)
    # The batch that failed after it was taken has no mark, so it comes again; no other does.
    assert sorted(b[0] for b in batches) == sorted([0, 30, 60, 60, 90, 100, 130, 160, 190])
    assert {i for b in batches for i in b} == set(range(200))


def test_a_repeated_task_sends_marked_batches_once(tmp_path):
    """Three batches in one task, which dies once after its second batch was marked."""
    code = f"""
import os, sys; sys.path.insert(0, {str(ROOT)!r})
from quillwork.session import get_spark
from quillwork.sources import writers
spark = get_spark(master="local[1,3]", **{{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "1"}})
def send(rows):
    first = min(r.id for r in rows)
    if first == 20 and not os.path.exists({str(tmp_path / "died")!r}):
        open({str(tmp_path / "died")!r}, "w").close()
        raise RuntimeError("task dies")
    with open({str(tmp_path / "log")!r}, "a") as f:
        f.write(str(first) + " ")
writers.in_batches(spark.range(0, 30, 1, 1), send, size=10, ledger={str(tmp_path / "ledger")!r})
"""
    subprocess.run([sys.executable, "-c", code], check=True, timeout=300)
    assert (tmp_path / "died").exists()
    assert sorted(map(int, (tmp_path / "log").read_text().split())) == [0, 10, 20]


def test_publish_replaces_in_one_step(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.publish(spark.range(3), path)
    writers.publish(spark.range(5), path)
    assert spark.read.parquet(path).count() == 5
    with pytest.raises(Exception, match="boom"):
        writers.publish(spark.sql("select raise_error('boom') x"), path)
    assert spark.read.parquet(path).count() == 5
    # A table may be computed from the one it replaces.
    writers.publish(spark.read.parquet(path).union(spark.range(2)), path)
    assert spark.read.parquet(path).count() == 7
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def rows_read(df):
    """Rows that left the scan of a collected frame."""
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.length()))


def test_clustered_files_are_skipped(spark, tmp_path):
    df = spark.range(40_000).selectExpr("(id * 7919) % 40000 as k", "id")
    writers.clustered(df, str(tmp_path / "c"), "k", files=4, **{"parquet.block.size": "16384"})
    df.write.parquet(str(tmp_path / "plain"))
    asked = [spark.read.parquet(str(tmp_path / name)).filter("k between 100 and 199") for name in ("c", "plain")]
    for frame in asked:
        assert len(frame.collect()) == 100
    assert rows_read(asked[0]) < 20_000 and rows_read(asked[1]) == 40_000


def test_rows_in_order(spark, tmp_path):
    df = spark.range(1000).selectExpr("(id * 37) % 1000 as k", "id % 7 as g")
    writers.in_order(df, str(tmp_path / "o"), F.when(F.col("g") == 3, 0).otherwise(1), F.desc("k"), fmt="json")
    files = sorted(f for f in (tmp_path / "o").glob("part-*.json"))
    lines = [json.loads(line) for f in files for line in f.read_text().splitlines()]
    assert len(files) > 1 and [r["position"] for r in lines] == list(range(1, 1001))
    order = [(r["g"] != 3, -r["k"]) for r in lines]
    assert order == sorted(order)


def test_positions_of_ties_and_of_nothing(spark):
    ties = spark.range(500).selectExpr("1 as k")
    assert sorted(r.position for r in positioned(ties, "k").collect()) == list(range(1, 501))
    assert positioned(ties.limit(0), "k").collect() == []


def test_gzip_csv_and_pushed_filter(spark, tmp_path):
    with gzip.open(tmp_path / "w.csv.gz", "wt") as f:
        f.write("CA1,20200101,TMAX,12,,,S,\nUS1,20200101,TMAX,15,,X,S,\n")
    obs = readers.observations(spark, str(tmp_path))
    kept = obs.filter(F.col("station").startswith("CA") & F.col("qflag").isNull())
    assert [r.value for r in kept.collect()] == [12]
    assert "StringStartsWith(station,CA)" in plan_text(kept)


def test_malformed_json(spark, tmp_path):
    (tmp_path / "c.json").write_text('{"subreddit": "x", "score": 3, "more": 1}\n{"subreddit": \n')
    df = readers.json_lines(spark, str(tmp_path), schemas.COMMENTS, "DROPMALFORMED")
    assert [(r.subreddit, r.score) for r in df.collect()] == [("x", 3)]


def test_table_source_and_sink(spark, tmp_path):
    df = spark.range(3)
    path = str(tmp_path / "t")
    writers.table(df, "parquet", path=path)
    writers.table(df, "parquet", path=path)
    assert readers.table(spark, "parquet", path=path).count() == 3


def test_warehouse_tables(spark, tmp_path):
    catalog.create_warehouse(spark, "shop", str(tmp_path / "shop"))
    rows = [("x1", "c1", "p1", "a1", "2021-08-01", "9.50")]
    (tmp_path / "in.csv").write_text("\n".join(",".join(r) for r in rows))
    catalog.load(readers.csv_rows(spark, str(tmp_path / "in.csv"), schemas.PURCHASES), "shop.purchases")
    assert spark.table("shop.purchases").first().amount == Decimal("9.50")
    (tmp_path / "am.json").write_text('{"amname": "A", "amenid": "a1", "amenity": "cafe", "tags": {"cuisine": "sushi"}}')
    catalog.load(readers.json_lines(spark, str(tmp_path / "am.json"), schemas.AMENITIES), "shop.amenities")
    assert spark.table("shop.amenities").first().tags == {"cuisine": "sushi"}
    catalog.create_view(spark.table("shop.amenities"), "places")
    assert spark.sql("SELECT amenid FROM places").count() == 1
    view = catalog.create_permanent_view(
        spark, "shop.sushi", "WITH f AS (SELECT amenid, tags.cuisine AS c FROM shop.amenities) "
        "SELECT amenid FROM f WHERE c = 'sushi'")
    assert [r.amenid for r in view.collect()] == ["a1"]
    assert spark.newSession().table("shop.sushi").count() == 1
    spark.sql("DROP VIEW shop.sushi")
    # Rows without a declared column refuse the load and leave the table as it was.
    assert catalog.required_columns(spark, "shop.amenities") == ["amenid", "amenity"]
    assert "NOT NULL" in catalog.columns_of(schemas.AMENITIES)
    with pytest.raises(ValueError, match="1 rows without amenity"):
        catalog.load(spark.table("shop.amenities").withColumn("amenity", F.lit(None).cast("string")),
                     "shop.amenities")
    assert spark.table("shop.amenities").count() == 1
    # Created again over the same folder, the tables are empty.
    catalog.create_warehouse(spark, "shop", str(tmp_path / "shop"))
    assert spark.table("shop.purchases").count() == spark.table("shop.amenities").count() == 0
    catalog.drop_warehouse(spark, "shop")
    assert not spark.catalog.tableExists("shop.purchases")
    catalog.drop_schema(spark, "shop")
    assert not spark.catalog.databaseExists("shop")


def test_daily_partitions_are_pruned(spark, tmp_path):
    from quillwork.operators.warehouse import average_by_day, average_on_days

    for day in ("2021-07-31", "2021-08-01", "2021-08-02", "2021-08-09"):
        (tmp_path / f"pdate={day}").mkdir()
        (tmp_path / f"pdate={day}" / "part.csv").write_text("x,c,p,a,2.00\ny,c,p,a,4.00\n")
    found = readers.purchases_by_day(spark, str(tmp_path))
    out = average_by_day(found)
    assert [(str(r.pdate), r.avg) for r in out.orderBy("pdate").collect()] == [
        ("2021-08-01", 3.0), ("2021-08-02", 3.0)
    ]
    plan = plan_text(out)
    assert "month(pdate" in plan.split("PartitionFilters")[1].split("\n")[0]

    catalog.create_schema(spark, "ext")
    catalog.create_purchases_by_day(spark, "ext.purchases", str(tmp_path))
    catalog.add_days(spark, "ext.purchases", str(tmp_path), ["2021-08-01", "2021-08-09"])
    assert spark.table("ext.purchases").count() == 4
    assert average_by_day(spark.table("ext.purchases")).count() == 1
    assert catalog.register_days(spark, "ext.purchases", str(tmp_path)) == ["2021-07-31", "2021-08-02"]
    assert catalog.register_days(spark, "ext.purchases", str(tmp_path)) == []
    assert spark.table("ext.purchases").count() == 8
    days = spark.sql("select date'2021-08-02' date, 'fair' holiday union all select date'2021-08-09', 'x'")
    fair = average_on_days(spark.table("ext.purchases"), days, "fair")
    assert "dynamicpruning" in plan_text(fair).split("PartitionFilters")[1].split("\n")[0]
    assert [(str(r.pdate), r.purchases, r.avg) for r in fair.collect()] == [("2021-08-02", 2, 3.0)]
    catalog.drop_table(spark, "ext.purchases")
    catalog.drop_schema(spark, "ext")
    assert (tmp_path / "pdate=2021-08-01").exists(), "an external table leaves its files"
