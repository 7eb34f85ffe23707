"""Checks of declared keys: duplicates, orphans and missing values."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillwork.functions.nulls import present
from quillwork.schemas import DECLARED_KEYS


def duplicate_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """Key values that occur more than once, with their row count.

    A key with a NULL part is no key: it equals nothing, and :func:`check_keys` reports it as missing.
    """
    return df.filter(present(*key)).groupBy(*key).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def orphans(child: DataFrame, foreign: str, parent: DataFrame, key: str) -> DataFrame:
    """Foreign values without a parent, with their row count; NULL refers to nothing.

    Values are counted before the join, so a value held by a third of the rows is one row there.
    """
    used = child.filter(present(foreign)).groupBy(foreign).agg(F.count(F.lit(1)).alias("rows"))
    return used.join(parent.select(F.col(key).alias(foreign)), foreign, "left_anti")


def missing(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row per required column with the number of NULLs, from a single scan."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counted.unpivot([], columns, "column", "rows")


def _verdict(found: DataFrame, table: str, check: str) -> DataFrame:
    return found.agg(
        F.count(F.lit(1)).alias("offenders"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")
    ).select(F.lit(table).alias("table"), F.lit(check).alias("check"), "offenders", "rows")


def check_keys(tables: dict[str, DataFrame], declared: dict[str, dict] = DECLARED_KEYS) -> DataFrame:
    """One row per declared constraint: distinct offending values and rows concerned.

    Columns of a key must not be NULL, like the required ones; all of a table are counted in one scan.
    """
    out = []
    for name, rule in declared.items():
        if rule["key"]:
            label = "unique " + ",".join(rule["key"])
            out.append(_verdict(duplicate_keys(tables[name], rule["key"]), name, label))
        if needed := list(dict.fromkeys([*rule["key"], *rule["required"]])):
            out.append(missing(tables[name], needed).select(
                F.lit(name).alias("table"), F.concat(F.lit("not null "), "column").alias("check"),
                (F.col("rows") > 0).cast("bigint").alias("offenders"), "rows"))
        for foreign, (parent, key) in rule["references"].items():
            found = orphans(tables[name], foreign, tables[parent], key)
            out.append(_verdict(found, name, f"{foreign} in {parent}.{key}"))
    return reduce(DataFrame.unionByName, out)
