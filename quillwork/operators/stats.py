"""Global moments, correlation and straight-line fits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillwork.functions.nulls import present


def moments(df: DataFrame, x: str, y: str, also: dict[str, Column] = {}) -> DataFrame:
    """One row: n, sum_x, sum_y, sum_xx, sum_yy, sum_xy over rows with both values.

    ``also`` names further aggregates for the same pass.
    """
    a, b = F.col(x), F.col(y)
    return df.filter(present(x, y)).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(a).alias("sum_x"),
        F.sum(b).alias("sum_y"),
        F.sum(a * a).alias("sum_xx"),
        F.sum(b * b).alias("sum_yy"),
        F.sum(a * b).alias("sum_xy"),
        *[column.alias(name) for name, column in also.items()],
    )


def moments_with_correlation(df: DataFrame, x: str, y: str) -> DataFrame:
    """The row of ``moments`` with r and r2 from central moments of the same aggregate."""
    columns = ["n", "sum_x", "sum_y", "sum_xx", "sum_yy", "sum_xy"]
    central = {"r": pearson(x, y)}
    return moments(df, x, y, central).select(*columns, "r", (F.col("r") * F.col("r")).alias("r2"))


def pearson(x: str, y: str) -> Column:
    """Pearson's r as an aggregate, NULL where a variance is zero."""
    a, b = F.col(x).cast("double"), F.col(y).cast("double")
    return F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))


def correlation(df: DataFrame, x: str, y: str) -> DataFrame:
    """One row: n, r, r2; r is NULL where a variance is zero."""
    r = pearson(x, y)
    return df.filter(present(x, y)).agg(
        F.count(F.lit(1)).alias("n"), r.alias("r"), (r * r).alias("r2")
    )


def slope(x: str, y: str) -> Column:
    """Least-squares slope of y on x, as an aggregate."""
    return F.regr_slope(F.col(y).cast("double"), F.col(x).cast("double"))


def intercept(x: str, y: str) -> Column:
    """Least-squares intercept of y on x, as an aggregate."""
    return F.regr_intercept(F.col(y).cast("double"), F.col(x).cast("double"))


def linear_fit(df: DataFrame, x: str, y: str) -> DataFrame:
    """One row ``(slope_beta, intercept_alpha)``; the same call serves a batch and a stream."""
    return df.agg(slope(x, y).alias("slope_beta"), intercept(x, y).alias("intercept_alpha"))


def regression_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """One row: n, rmse, r2 of predictions, in a single aggregate."""
    y = F.col(label).cast("double")
    error = y - F.col(prediction).cast("double")
    return df.filter(present(label, prediction)).agg(
        F.count(F.lit(1)).alias("n"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        (1 - F.try_divide(F.avg(error * error), F.var_pop(y))).alias("r2"),
    )


def accuracy(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """One row: n and the share of rows whose prediction equals the label."""
    hit = (F.col(label) == F.col(prediction)).cast("double")
    return df.filter(present(label, prediction)).agg(
        F.count(F.lit(1)).alias("n"), F.avg(hit).alias("accuracy")
    )
