"""Store comparison and calendar features over sales."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillwork.functions.calendar import is_weekend
from quillwork.functions.nulls import present
from quillwork.operators.sizing import join_measured, settle_measured


def store_comparison(sales: DataFrame, first: str = "Burnaby", second: str = "Vancouver",
                     names: tuple[str, str] | None = None) -> DataFrame:
    """Sales of two stores side by side for the dates on which both sold.

    A store with several rows on a date is summed.  One grouped pass, no self-join.
    """
    left, right = names or (first, second)
    store, amount = F.col("store"), F.col("sales")
    return (
        sales.filter(store.isin(first, second))
        .groupBy("date")
        .agg(
            F.sum(F.when(store == first, amount)).alias(left),
            F.sum(F.when(store == second, amount)).alias(right),
        )
        .filter(present("date", left, right))
    )


def calendar_features(sales: DataFrame, holidays: DataFrame) -> DataFrame:
    """Sales per staff member with holiday and weekend flags; all sales rows are kept.

    The holiday list is measured before it is broadcast: dates are few and sales would pile up on
    the busy ones if they were shuffled.  A date listed with several holidays counts once.
    """
    named = holidays.filter("holiday is not null")
    listed, size = settle_measured(named.groupBy("date").agg(F.min("holiday").alias("holiday")))
    return join_measured(sales, listed, size, ["date"], "left").select(
        "date", "store", "sales",
        F.try_divide("sales", "staff").alias("sales_per_staff"),
        F.col("holiday").isNotNull().alias("is_holiday"),
        is_weekend("date").alias("is_weekend"),
    )
