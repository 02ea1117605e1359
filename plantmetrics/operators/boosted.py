"""Boosted failure model with patience: trees as plain values, stored as a table, scored as column expressions.

Spark fits the trees; what is kept of a fit is their splits. To score, they are built again as Spark's own trees, which walk a row
inside the scan's own stage: no Python, no model service, and a plan of the same size for any number of trees. The stored form is
one row per node.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plantmetrics.functions.sizing import stored
from plantmetrics.operators.features import MODEL_FEATURES, assemble, class_weight
from plantmetrics.session import scratch_path

ROUNDS, PATIENCE = 300, 30
#: The JVM interprets methods of more bytes than this, however often they run.
METHOD_BYTES = 8000
NODES = "tree int, weight double, node long, feature string, threshold double, value double"


@dataclass(frozen=True)
class Node:
    """A split (rows up to the threshold go left) or, without a feature, a leaf."""

    value: float
    feature: str | None = None
    threshold: float = 0.0
    left: Node | None = None
    right: Node | None = None


@dataclass(frozen=True)
class BoostedModel:
    """Weighted trees over named columns; missing values count as 0, as in training."""

    columns: tuple[str, ...]
    weights: tuple[float, ...]
    trees: tuple[Node, ...]

    def first(self, rounds: int) -> BoostedModel:
        """The model as it was after so many rounds."""
        return BoostedModel(self.columns, self.weights[:rounds], self.trees[:rounds])


def from_spark(model: GBTClassificationModel, columns: Sequence[str]) -> BoostedModel:
    """The splits of a fitted classifier."""
    def walk(node) -> Node:
        if node.subtreeDepth() == 0:
            return Node(node.prediction())
        split = node.split()
        return Node(node.prediction(), columns[split.featureIndex()], split.threshold(), walk(node.leftChild()), walk(node.rightChild()))

    return BoostedModel(tuple(columns), tuple(model.treeWeights), tuple(walk(t._call_java("rootNode")) for t in model.trees))


def to_spark(model: BoostedModel, spark: SparkSession) -> GBTClassificationModel:
    """A classifier of the same splits over vectors in the order of the columns; the opposite of `from_spark`."""
    ml, at = spark._jvm.org.apache.spark.ml, {c: i for i, c in enumerate(model.columns)}
    # Looked up once: each name on such a path is a call to the JVM.
    leaf, inner, split, whole = ml.tree.LeafNode, ml.tree.InternalNode, ml.tree.ContinuousSplit, ml.regression.DecisionTreeRegressionModel

    def build(node: Node):
        if node.feature is None:
            return leaf(float(node.value), 0.0, None)
        return inner(float(node.value), 0.0, 0.0, build(node.left), build(node.right), split(at[node.feature], float(node.threshold)), None)

    gateway = spark.sparkContext._gateway
    trees, weights = gateway.new_array(whole, len(model.trees)), gateway.new_array(spark._jvm.double, len(model.trees))
    for i, (weight, root) in enumerate(zip(model.weights, model.trees, strict=True)):
        trees[i] = whole(build(root), len(model.columns))
        weights[i] = float(weight)
    return GBTClassificationModel(ml.classification.GBTClassificationModel(f"boosted_{uuid.uuid4().hex}", trees, weights))


def save_model(model: BoostedModel, spark: SparkSession, path: str) -> None:
    """One row per node, numbered 1 for the root and 2n, 2n + 1 below n; a weightless row per column keeps the inputs."""
    rows = [(-1 - i, 0.0, 0, c, 0.0, 0.0) for i, c in enumerate(model.columns)]

    def walk(tree: int, weight: float, number: int, node: Node) -> None:
        rows.append((tree, weight, number, node.feature, node.threshold, node.value))
        if node.feature is not None:
            walk(tree, weight, 2 * number, node.left)
            walk(tree, weight, 2 * number + 1, node.right)

    for tree, (weight, root) in enumerate(zip(model.weights, model.trees, strict=True)):
        walk(tree, weight, 1, root)
    spark.createDataFrame(rows, NODES).coalesce(1).write.parquet(path)


def load_model(spark: SparkSession, path: str) -> BoostedModel:
    """A stored model; its rows number the nodes of its trees, not the data it was fitted on."""
    rows = {(r.tree, r.node): r for r in spark.read.schema(NODES).parquet(path).collect()}

    def build(tree: int, number: int) -> Node:
        row = rows[tree, number]
        if row.feature is None:
            return Node(row.value)
        return Node(row.value, row.feature, row.threshold, build(tree, 2 * number), build(tree, 2 * number + 1))

    size = 1 + max((tree for tree, _ in rows), default=-1)
    columns = [rows[t, 0].feature for t in sorted((tree for tree, _ in rows if tree < 0), reverse=True)]
    return BoostedModel(tuple(columns), tuple(rows[t, 1].weight for t in range(size)), tuple(build(t, 1) for t in range(size)))


def score_rows(model: BoostedModel, df: DataFrame, out: str = "failure_probability") -> DataFrame:
    """All rows with their failure probability, 1 / (1 + exp(-2 * margin)).

    The trees are no part of the plan: as an expression, 300 of them fill a driver of 750 MB with generated code. What is
    generated around them is still kept to methods that the JVM compiles.
    """
    df.sparkSession.conf.set("spark.sql.codegen.hugeMethodLimit", str(METHOD_BYTES))
    if not model.trees:
        return df.withColumn(out, F.lit(0.5))
    inputs = {f"_{c}": F.col(c).cast("double") for c in model.columns}
    ready = assemble(df.withColumns(inputs), list(inputs), "_features").drop(*inputs)
    spark_model = to_spark(model, df.sparkSession).setFeaturesCol("_features").setRawPredictionCol("_margins")
    # Of the class probabilities only the margin is taken: 1 less the other class's chance is 0 where the margin is very low.
    margins = spark_model.setProbabilityCol("").setPredictionCol("").transform(ready)
    margin = vector_to_array("_margins")[1]
    return margins.withColumn(out, 1 / (1 + F.exp(-2 * margin))).drop("_features", "_margins")


def stop_after(losses: Sequence[float], patience: int) -> tuple[int, bool]:
    """(rounds up to the best loss before `patience` rounds bring no gain, whether that point was reached)."""
    best = 0
    for r, loss in enumerate(losses):
        if loss < losses[best]:
            best = r
        elif r - best >= patience:
            return best + 1, True
    return best + 1, False


@dataclass(frozen=True)
class Fit:
    """A model cut back to its best round, with the validation loss of every round that was looked at."""

    model: BoostedModel
    best_round: int
    losses: tuple[float, ...]


def fit_with_patience(
    train: DataFrame, validation: DataFrame, label: str, columns: Sequence[str] = MODEL_FEATURES, rounds: int = ROUNDS,
    patience: int = PATIENCE, depth: int = 5, step: float = 0.1, seed: int = 42, first: int | None = None,
) -> Fit:
    """Gradient-boosted trees until the validation loss has not fallen for `patience` rounds, then cut back to the best round.

    The positive class is weighted by negatives / positives of `train`. Spark cannot go on with a fit, so `first` rounds
    (4 * patience) are fitted and, where their loss curve has not turned, all `rounds` at once; a fit of more rounds begins
    with the same trees, so the result is that of one fit with a look after every round, and at most two fits are made.
    A fit's lineage grows by every round; it is cut through the session's checkpoint folder, or one below the shared folder.
    """
    context = train.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch_path(train.sparkSession, "checkpoints"))
    ready = stored(train.select(F.col(label), *columns), "train")
    weight = class_weight(ready, label).select("scale_pos_weight").first()[0]

    def prepared(df: DataFrame) -> DataFrame:
        return assemble(df, columns).withColumn("_weight", F.when(F.col(label) == 1, weight).otherwise(1.0))

    taught, held = prepared(ready), prepared(stored(validation.select(F.col(label), *columns), "validation"))
    size = min(first or 4 * patience, rounds)
    while True:
        gbt = GBTClassifier(featuresCol="features", labelCol=label, weightCol="_weight", maxIter=size, maxDepth=depth, stepSize=step, seed=seed)
        fitted = gbt.fit(taught)
        losses = fitted.evaluateEachIteration(held)
        best, turned = stop_after(losses, patience)
        if turned or size >= rounds:
            seen = best + patience if turned else len(losses)
            return Fit(from_spark(fitted, columns).first(best), best, tuple(losses[:seen]))
        size = rounds
