"""Settled tables: who owns them and when they go."""

import os
import subprocess
import sys
import time
from pathlib import Path

import pytest

from quillwork.session import Scratch, delete, exists, new_path, settle, shared_folder

ROOT = Path(__file__).resolve().parents[1]


def folders(spark):
    return set(os.listdir(shared_folder(spark)))


def test_settled_rows_are_those_of_the_frame(spark):
    df = spark.sql("select 1L a, cast(null as string) b union all select 2L, 'x'")
    assert sorted(settle(df).collect()) == sorted(df.collect())
    assert settle(df.limit(0)).dtypes == df.dtypes


def test_a_name_holds_its_last_table_only(spark):
    before, scratch = folders(spark), Scratch(spark)
    for i in range(3):
        state = scratch.settle(spark.range(i), "state")
    other = scratch.settle(spark.range(7), "other")
    assert (state.count(), other.count()) == (2, 7)
    assert len(folders(spark) - before) == 2
    scratch.close("other")
    assert other.count() == 7 and len(folders(spark) - before) == 1
    scratch.close()
    assert folders(spark) == before


def test_a_state_may_be_computed_from_the_one_it_replaces(spark):
    with Scratch(spark) as scratch:
        state = scratch.settle(spark.range(3), "state")
        for _ in range(3):
            state = scratch.settle(state.union(state), "state")
        assert state.count() == 24


def test_nothing_is_left_of_a_failed_write_or_block(spark):
    before = folders(spark)
    with pytest.raises(Exception, match="boom"), Scratch(spark) as scratch:
        scratch.settle(spark.range(5), "fine")
        scratch.settle(spark.sql("select raise_error('boom') x from range(2)"), "broken")
    assert folders(spark) == before


def test_delete_takes_folders_and_absent_paths(spark):
    path = new_path(spark, "gone")
    spark.range(1).write.parquet(path)
    assert exists(spark, path)
    delete(spark, path)
    delete(spark, path)
    assert not exists(spark, path)


def test_the_shared_folder_is_empty_when_the_driver_has_ended(tmp_path):
    code = f"""
import sys; sys.path.insert(0, {str(ROOT)!r})
from quillwork.session import get_spark, settle, Scratch
spark = get_spark(master="local[1]", **{{"spark.checkpoint.dir": {str(tmp_path)!r}, "spark.ui.enabled": "false"}})
settle(spark.range(3)); Scratch(spark).settle(spark.range(3), "kept")
import os
assert len(os.listdir({str(tmp_path)!r})) >= 1
"""
    subprocess.run([sys.executable, "-c", code], check=True, timeout=300)
    # Spark's process ends a moment after the driver's; it may leave an empty folder for checkpoints.
    deadline = time.monotonic() + 60
    while time.monotonic() < deadline and any(d.startswith("quillwork-") for d in os.listdir(tmp_path)):
        time.sleep(0.2)
    assert [f for _, _, files in os.walk(tmp_path) for f in files] == []
    assert not [d for d in os.listdir(tmp_path) if d.startswith("quillwork-")]
