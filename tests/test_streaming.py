import pytest
from pyspark.sql import functions as F

from quillwork.operators.stats import linear_fit
from quillwork.streaming import regression, restartable


def test_stream_equals_batch_and_skips_malformed(spark, tmp_path):
    points = [(float(i), 2.5 * i + (i % 3)) for i in range(50)]
    for part in range(3):
        text = [f"{x} {y}" for x, y in points[part::3]] + ["broken", "1.0 nope", "", "3"]
        (tmp_path / f"m{part}.txt").write_text("\n".join(text))
    messages = (
        spark.readStream.option("maxFilesPerTrigger", 1).text(str(tmp_path))
        .select(F.col("value").cast("binary").alias("value"))
    )
    got = regression.drain(regression.running_fit(messages)).first()
    batch = linear_fit(spark.createDataFrame(points, "x double, y double"), "x", "y").first()
    assert got.slope_beta == pytest.approx(batch.slope_beta)
    assert got.intercept_alpha == pytest.approx(batch.intercept_alpha)


def test_encode_decode(spark):
    df = spark.createDataFrame([(1, 2.5)], "x int, y double")
    coded = df.select(regression.encode_point(F.col("x"), F.col("y")).alias("value"))
    assert coded.first().value == bytearray(b"1 2.5")
    assert tuple(regression.decode_points(coded).first()) == (1.0, 2.5)


def test_console_sink(spark, tmp_path):
    (tmp_path / "m.txt").write_text("1 2\n2 4\n")
    query = regression.start_console(regression.running_fit(spark.readStream.text(str(tmp_path))))
    query.processAllAvailable()
    assert query.exception() is None
    query.stop()


def test_a_stream_stopped_early_raises(spark, tmp_path):
    spark.range(2000).selectExpr("cast(id as string) as value").repartition(40).write.parquet(
        str(tmp_path / "in"))
    source = spark.readStream.schema("value string").option("maxFilesPerTrigger", 1)
    messages = source.parquet(str(tmp_path / "in"))
    with pytest.raises(TimeoutError):
        regression.drain(regression.running_fit(messages), timeout=1)


def numbered_files(tmp_path, numbers):
    for i in numbers:
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / f"m{i}.txt").write_text(f"{i} {2 * i}\nbroken\n")


def totals(spark, tmp_path):
    return restartable.total_moments(spark, str(tmp_path / "out")).first()


def started(spark, tmp_path, partial=restartable.partial_moments()):
    lines = spark.readStream.option("maxFilesPerTrigger", 1).text(str(tmp_path / "in"))
    points = regression.decode_points(lines.select(F.col("value").cast("binary").alias("value")))
    return restartable.start(points, str(tmp_path / "out"), str(tmp_path / "checkpoint"), partial)


def test_a_stopped_stream_goes_on_and_counts_each_message_once(spark, tmp_path):
    numbered_files(tmp_path, range(8))
    restartable.stop_after(started(spark, tmp_path), 3)
    first = totals(spark, tmp_path)
    assert first.n >= 3
    started(spark, tmp_path).awaitTermination()
    assert (totals(spark, tmp_path).n, totals(spark, tmp_path).sum_x) == (8, 28.0)
    numbered_files(tmp_path, range(8, 12))
    started(spark, tmp_path).awaitTermination()
    got = totals(spark, tmp_path)
    assert (got.n, got.sum_x, got.sum_xy, got.epochs) == (12, 66.0, 2.0 * sum(i * i for i in range(12)), 12)


def test_an_epoch_that_failed_after_its_write_is_not_counted_twice(spark, tmp_path):
    numbered_files(tmp_path, range(6))
    sums = restartable.partial_moments()
    folder = str(tmp_path / "out")

    def store_then_fail(batch):
        if len(list((tmp_path / "out").glob("epoch=*"))) == 3:
            # What a process that dies before the commit leaves behind: the epoch's output is there.
            sums(batch).write.mode("overwrite").parquet(f"{folder}/epoch=3")
            raise RuntimeError("died")
        return sums(batch)

    with pytest.raises(Exception, match="died"):
        started(spark, tmp_path, store_then_fail).awaitTermination()
    assert totals(spark, tmp_path).n == 4
    started(spark, tmp_path).awaitTermination()
    assert (totals(spark, tmp_path).n, totals(spark, tmp_path).sum_x) == (6, 15.0)
