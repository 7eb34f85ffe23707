"""Regression and classification models built on Spark ML."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.feature import (
    IndexToString,
    SQLTransformer,
    StringIndexer,
    StringIndexerModel,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillwork.functions.nulls import present
from quillwork.operators.colourspace import conversion
from quillwork.operators.ordering import positioned
from quillwork.operators.stats import accuracy, regression_metrics

LEAST_ROWS = 25_000  # of a partition of a fit
PLACE = ["latitude", "longitude", "elevation"]


def hash_split(df: DataFrame, key: str, percent: int = 75) -> tuple[DataFrame, DataFrame]:
    """Split by a hash of ``key``: repeatable, and one key is never on both sides."""
    side = in_first_part(key, percent)
    return df.filter(side), df.filter(~side)


def in_first_part(key: str, percent: int = 75):
    """Whether a whole-number key falls in the first part (multiplicative hashing)."""
    return F.pmod(F.pmod(F.col(key), F.lit(1 << 31)) * 2654435761, F.lit(100)) < percent


def with_season(df: DataFrame, date: str = "date") -> DataFrame:
    """Add ``season_day``, the day of the year, which the temperature model takes as input."""
    return df.withColumn("season_day", F.dayofyear(date))


def temperature_model(with_yesterday: bool = True, max_depth: int = 5, max_iter: int = 100,
                      seed: int = 7, place: list[str] = PLACE) -> Pipeline:
    """Boosted trees for ``tmax`` from the day of the year, the place and the day before.

    The input carries ``season_day`` of ``with_season`` and ``yesterday_tmax`` of ``previous_day``;
    building it before the split
    keeps all day pairs.
    """
    inputs = ["season_day", *place] + (["yesterday_tmax"] if with_yesterday else [])
    return Pipeline(stages=[
        VectorAssembler(inputCols=inputs, outputCol="features"),
        GBTRegressor(featuresCol="features", labelCol="tmax", maxDepth=max_depth,
                     maxIter=max_iter, seed=seed),
    ])


def colour_model(space: str = "RGB", words: int = 11, hidden: int = 10, max_iter: int = 900,
                 seed: int = 7) -> Pipeline:
    """A multilayer perceptron from R, G, B columns to a word, working in ``RGB`` or ``LAB``.

    For LAB the conversion is a stage of the model, so it is always applied to plain RGB tables.
    """
    if space not in ("RGB", "LAB"):
        raise ValueError(f"unknown colour space {space!r}")
    inputs = ["R", "G", "B"] if space == "RGB" else ["labL", "labA", "labB"]
    convert = [SQLTransformer(statement=conversion("lab", ["R", "G", "B", "word"]))] if space == "LAB" else []
    return Pipeline(stages=[
        *convert,
        VectorAssembler(inputCols=inputs, outputCol="features"),
        StringIndexer(inputCol="word", outputCol="label", handleInvalid="keep"),
        MultilayerPerceptronClassifier(layers=[len(inputs), hidden, words], maxIter=max_iter,
                                       seed=seed),
    ])


def whole_rows(df: DataFrame, needed: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with all the columns a model needs, and a count per outcome: ``kept`` or the first lacking.

    A model cannot be fitted on the others, and scoring one of them fails; they are counted, not lost.
    """
    lacking = F.coalesce(*[F.when(F.col(c).isNull(), F.lit(f"no {c}")) for c in needed])
    counts = df.groupBy(F.coalesce(lacking, F.lit("kept")).alias("outcome")).agg(
        F.count(F.lit(1)).alias("rows"))
    return df.filter(present(*needed)), counts


def dealt(df: DataFrame, least: int = LEAST_ROWS) -> DataFrame:
    """Rows dealt evenly to all slots, for a fit that goes over them hundreds of times.

    A small or freshly settled table often lies in one or two files, and so in as many tasks.  A
    partition has ``least`` rows or more, as a round over fewer costs less than its tasks; a table too
    small for two of those stays as it is.
    """
    parts = min(df.count() // least, df.sparkSession.sparkContext.defaultParallelism)
    return df.repartition(parts) if parts > 1 else df


def fit_colour_model(df: DataFrame, space: str = "RGB", **settings) -> PipelineModel:
    """:func:`colour_model` fitted on the rows with all channels and a word, sized by their words."""
    rows, _ = whole_rows(df, ["R", "G", "B", "word"])
    words = rows.select("word").distinct().count()
    return colour_model(space, words=words, **settings).fit(dealt(rows))


def label_index(df: DataFrame, column: str) -> DataFrame:
    """Labels with their index: most frequent first, ties in alphabetical order; without nulls.

    Counts are numbered in their order where they lie.
    """
    labels = df.select(column).na.drop().select(F.col(column).cast("string").alias("word"))
    counts = labels.groupBy("word").agg(F.count("*").alias("n"))
    return positioned(counts, F.desc("n"), F.asc("word"), out="place", first=0).select(
        F.col("place").cast("double").alias("label"), F.col("word").alias(column))


def with_predicted_word(model: PipelineModel, scored: DataFrame, out: str) -> DataFrame:
    """Turn the predicted index of a scored table back into its word."""
    labels = next(s for s in model.stages if isinstance(s, StringIndexerModel)).labels
    return IndexToString(inputCol="prediction", outputCol=out, labels=labels).transform(scored)


def feature_importances(model: PipelineModel, df_scored: DataFrame) -> DataFrame:
    """``(feature, importance)`` of the last stage of a fitted model."""
    assembler = next(s for s in model.stages if isinstance(s, VectorAssembler))
    weights = model.stages[-1].featureImportances.toArray().tolist()
    rows = list(zip(assembler.getInputCols(), weights))
    return df_scored.sparkSession.createDataFrame(rows, "feature string, importance double")


def score_regression(model: PipelineModel, parts: dict[str, DataFrame], name: str) -> DataFrame:
    """RMSE and R2 of a model on named parts of the data, one row each."""
    out = None
    for part, rows in parts.items():
        row = regression_metrics(model.transform(rows), "tmax", "prediction").select(
            F.lit(name).alias("model"), F.lit(part).alias("part"), "n", "rmse", "r2"
        )
        out = row if out is None else out.unionByName(row)
    return out


def score_words(model: PipelineModel, rows: DataFrame, name: str) -> DataFrame:
    """Share of rows whose word was predicted, of those with all channels and a word."""
    rows, _ = whole_rows(rows, ["R", "G", "B", "word"])
    return accuracy(model.transform(rows), "label", "prediction").select(
        F.lit(name).alias("model"), "n", "accuracy"
    )


def probabilities(scored: DataFrame) -> DataFrame:
    """Class probabilities of a scored table as an array column."""
    return scored.withColumn("probability", vector_to_array("probability"))
