"""Audit of tree ensembles: a fitted forest as a table of nodes, and scores walked from that table.

The node table comes from the ensemble's saved form (one row per node, written by tasks), so any
engine can repeat the scores: go left where the feature's value is at most the threshold, until
a node has no feature; a forest averages its leaves' class shares, boosting adds its leaves'
values times the trees' weights and squeezes twice the sum by the logistic function.

The walk moves all (row, tree) pairs one level at a time. The node table is bounded by trees and
depth and joined behind a size check; a row's trees stay in one task, so the final sum needs no
row of another.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import fits_broadcast
from ..session import materialize, stage_path

ROOT = 0                                                  # node ids of a tree start here


def node_table(model: PipelineModel) -> DataFrame:
    """(tree, node, feature, threshold, left, right, value, weight); a leaf has null feature, threshold, left
    and right. ``value`` is what the tree answers there: the share of label 1 (forest) or the fitted value
    (boosting). Numeric features only (categorical splits are refused); an unfitted model has no table."""
    spark = SparkSession.getActiveSession()
    trees = model.stages[-1]
    path = stage_path(spark, "ensemble")
    trees.write().save(path)
    boosted = isinstance(trees, GBTClassificationModel)
    n = F.col("nodeData")
    stats = n["impurityStats"]
    total = F.aggregate(stats, F.lit(0.0), lambda acc, x: acc + x)
    value = n["prediction"] if boosted else F.get(stats, F.lit(1)) / total
    inner = n["leftChild"] >= 0
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in trees.treeWeights]), F.col("treeID") + 1)
    nodes = spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), n["id"].alias("node"), F.when(inner, n["split"]["featureIndex"]).alias("feature"),
        F.when(inner, F.get(n["split"]["leftCategoriesOrThreshold"], F.lit(0))).alias("threshold"),
        F.when(inner, n["leftChild"]).alias("left"), F.when(inner, n["rightChild"]).alias("right"),
        value.alias("value"), (weight if boosted else F.lit(1.0)).alias("weight"),
        F.coalesce(n["split"]["numCategories"], F.lit(-1)).alias("categories"))
    nodes = materialize(nodes, "nodes")
    if not nodes.where("feature IS NOT NULL AND categories >= 0").isEmpty():
        raise ValueError("the ensemble splits on categories; the node table holds thresholds only")
    return nodes.drop("categories")


def depth(model: PipelineModel) -> int:
    """Levels below the root of the deepest tree."""
    return max(t.depth for t in model.stages[-1].trees)


def walk(nodes: DataFrame, df: DataFrame, cols: list[str], key: str, levels: int, boosted: bool,
         out: str = "p") -> DataFrame:
    """(key, ``out``) for every row of ``df``, from the node table alone, ``levels`` steps down. Missing features
    count as 0, as in the fit; ``key`` must name one row; no rows give no rows; a row that a broken table leads
    nowhere is missing from the result."""
    side = F.broadcast(nodes) if fits_broadcast(nodes) else nodes
    trees = nodes.agg(F.max("tree")).first()[0]
    at = df.select(F.col(key).alias("key"),
                   F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in cols]).alias("x"),
                   F.explode(F.sequence(F.lit(0), F.lit(trees))).alias("tree"), F.lit(ROOT).alias("node"))
    for step in range(levels + 1):
        at = at.join(side, ["tree", "node"])
        if step < levels:                                 # a row that has reached its leaf stays there
            goes = F.when(F.get("x", F.col("feature")) <= F.col("threshold"), F.col("left")) \
                .when(F.col("feature").isNotNull(), F.col("right"))
            at = at.select("key", "x", "tree", F.coalesce(goes, F.col("node")).alias("node"))
    total = F.sum(F.col("value") * F.col("weight")) / (F.lit(1.0) if boosted else F.sum("weight"))
    score = 1 / (1 + F.exp(-2 * total)) if boosted else total
    return at.groupBy(F.col("key").alias(key)).agg(score.alias(out))
