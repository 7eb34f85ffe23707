"""Fitted models as column expressions, scored inside a query without the model's own operators."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.ml.classification import MultilayerPerceptronClassificationModel
from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import Column
from pyspark.sql import functions as F


def _branch(node, inputs: list[str]) -> str:
    """A node of a fitted tree as SQL: a leaf's value, or a test of one input."""
    if node.getClass().getSimpleName() == "LeafNode":
        return f"{node.prediction()!r}D"
    split = node.split()
    name = f"`{inputs[split.featureIndex()]}`"
    if split.getClass().getSimpleName() == "ContinuousSplit":
        test = f"{name} <= {split.threshold()!r}D"
    else:
        test = f"{name} IN ({', '.join(f'{c!r}D' for c in split.leftCategories())})"
    return (f"CASE WHEN {test} THEN {_branch(node.leftChild(), inputs)} "
            f"ELSE {_branch(node.rightChild(), inputs)} END")


def boosted_trees(model: GBTRegressionModel, inputs: list[str]) -> Column:
    """The prediction of boosted trees: each tree a nest of CASE, summed with the trees' weights.

    NULL where an input is NULL.
    """
    trees = [F.expr(_branch(t._java_obj.rootNode(), inputs)) * weight
             for t, weight in zip(model.trees, model.treeWeights)]
    whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in inputs])
    return F.when(whole, reduce(lambda a, b: a + b, trees))


def _layer(cells: Column, last: bool) -> Callable[[Column], Column]:
    """Sums of products of a layer's inputs, through the logistic curve unless it is the last."""
    def through(before: Column) -> Column:
        sums = F.transform(cells, lambda c: F.aggregate(
            F.zip_with(c["w"], before, lambda w, x: w * x), c["b"], lambda total, x: total + x))
        return sums if last else F.transform(sums, lambda z: 1.0 / (1.0 + F.exp(-z)))

    return through


def perceptron(model: MultilayerPerceptronClassificationModel, inputs: list[str], layers: list[int]
               ) -> tuple[Column, Column]:
    """Class probabilities (an array) and the predicted class of a perceptron.

    A layer is an array of sums of products of the layer before, computed once a row: hidden layers
    through the logistic curve, the last one as shares.  NULL where an input is NULL.
    """
    weights = model.weights.toArray().tolist()
    values, at = F.array(*[F.col(c).cast("double") for c in inputs]), 0
    for depth, (n, m) in enumerate(zip(layers, layers[1:])):
        rows = [F.array(*[F.lit(weights[at + i * m + o]) for i in range(n)]) for o in range(m)]
        offsets = weights[at + n * m:at + n * m + m]
        at += n * m + m
        cells = F.array(*[F.struct(row.alias("w"), F.lit(b).alias("b")) for row, b in zip(rows, offsets)])
        # An array of one, so that what a layer is made of is written once and computed once.
        values = F.transform(F.array(values), _layer(cells, depth == len(layers) - 2))[0]
    top = F.transform(F.array(values), lambda z: F.transform(z, lambda x: F.exp(x - F.array_max(z))))[0]
    shares = F.transform(F.array(top), lambda e: F.transform(
        e, lambda x: x / F.aggregate(e, F.lit(0.0), lambda total, y: total + y)))[0]
    whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in inputs])
    shares = F.when(whole, shares)
    return shares, (F.array_position(shares, F.array_max(shares)) - 1).cast("double")
