"""Tree models: fitting with MLlib, importances, and scoring as a column expression."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def assemble(df: DataFrame, features: Sequence[str], name: str = "features") -> DataFrame:
    """Add the feature vector; a null feature counts as 0, as in the fitted matrix."""
    filled = df.withColumns({f"_f{i}": F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for i, c in enumerate(features)})
    inputs = [f"_f{i}" for i in range(len(features))]
    return VectorAssembler(inputCols=inputs, outputCol=name).transform(filled).drop(*inputs)


def fit_forest(df: DataFrame, features: Sequence[str], y: str, **params):
    """Random forest; ``params`` are MLlib's (``numTrees``, ``maxDepth``, ``seed`` …)."""
    options = {"seed": 42, **params}
    model = RandomForestRegressor(featuresCol="features", labelCol="_label", **options)
    return model.fit(assemble(df, features).withColumn("_label", F.col(y).cast("double")))


def fit_boosted(df: DataFrame, features: Sequence[str], y: str, validation: DataFrame | None = None, **params):
    """Boosted trees; a validation frame stops the boosting when it no longer improves."""
    options = {"seed": 42, **params}
    rows = df
    if validation is not None:
        rows = df.withColumn("_validation", F.lit(False)).unionByName(
            validation.withColumn("_validation", F.lit(True))
        )
        options["validationIndicatorCol"] = "_validation"
    model = GBTRegressor(featuresCol="features", labelCol="_label", **options)
    return model.fit(assemble(rows, features).withColumn("_label", F.col(y).cast("double")))


def score_trees(df: DataFrame, model, features: Sequence[str], name: str = "prediction") -> DataFrame:
    scored = model.setPredictionCol(name).transform(assemble(df, features))
    return scored.drop("features")


TREES_SCHEMA = (
    "trees array<struct<weight: double, nodes: array<struct<"
    "feature: int, threshold: double, left: int, right: int, value: double>>>>"
)


def _nodes_of(root) -> list[tuple]:
    """The nodes below a fitted tree's root, parents first; raises on a kind of node it does not know."""
    nodes: list[list] = []
    todo = [(root, -1, 0)]
    while todo:
        node, parent, side = todo.pop()
        if parent >= 0:
            nodes[parent][side] = len(nodes)
        kind = node.getClass().getSimpleName()
        if kind == "LeafNode":
            nodes.append([-1, 0.0, -1, -1, float(node.prediction())])
            continue
        split = node.split()
        if kind != "InternalNode" or split.getClass().getSimpleName() != "ContinuousSplit":
            raise TypeError(f"cannot read {kind} with {split.getClass().getSimpleName()}")
        at = len(nodes)
        nodes.append([int(split.featureIndex()), float(split.threshold()), -1, -1, 0.0])
        todo += [(node.rightChild(), at, 3), (node.leftChild(), at, 2)]
    return [tuple(n) for n in nodes]


def tree_nodes(model) -> list[tuple[float, list[tuple]]]:
    """Trees of a fitted ensemble as ``(weight, [(feature, threshold, left, right, value)])``.

    A leaf has feature -1. Node 0 is the root.
    """
    weights = [float(w) for w in model.treeWeights]
    total = sum(weights) if "RandomForest" in type(model).__name__ else 1.0
    return [(w / total, _nodes_of(t._java_obj.rootNode())) for w, t in zip(weights, model.trees)]


def trees_frame(spark: SparkSession, model) -> DataFrame:
    """The ensemble as a one-row frame; its size is that of the model the driver holds."""
    return spark.createDataFrame([(tree_nodes(model),)], TREES_SCHEMA)


def trees_value(trees: Column, x: Column, max_depth: int) -> Column:
    """Prediction for an array of features, walked inside the JVM."""

    def walk(tree: Column) -> Column:
        def step(at: Column, _: Column) -> Column:
            node = F.get(tree["nodes"], at)
            down = F.when(F.get(x, node["feature"]) <= node["threshold"], node["left"])
            return F.when(node["feature"] < 0, at).otherwise(down.otherwise(node["right"]))

        path = F.sequence(F.lit(1), F.lit(max(max_depth, 1)))
        return F.aggregate(path, F.lit(0), step, lambda at: F.get(tree["nodes"], at)["value"])

    return F.aggregate(trees, F.lit(0.0), lambda total, t: total + t["weight"] * walk(t))


def importance_table(spark: SparkSession, model, features: Sequence[str]) -> DataFrame:
    """``feature, gain, splits``: MLlib's impurity share and the share of splits, strongest first."""
    used = [n[0] for _, nodes in tree_nodes(model) for n in nodes if n[0] >= 0]
    gains = model.featureImportances.toArray()
    rows = [
        (name, float(gains[i]), used.count(i) / max(len(used), 1)) for i, name in enumerate(features)
    ]
    frame = spark.createDataFrame(rows, "feature string, gain double, splits double")
    return frame.orderBy(F.col("gain").desc(), F.col("feature").asc())
