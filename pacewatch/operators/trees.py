"""A fitted boosted-tree model as a table of nodes, scored and summed up by joins.

One row a node: (tree, node, feature, cut, left, right, value, gain, rows, weight). Inner nodes
have a feature (by its place among the inputs) and a cut: values up to it go left. Leaves
have no children and a value. So a model can be kept, compared, audited and scored where no
tree library is at hand.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pacewatch.schema import MODEL_COLUMNS

#: Nodes up to which the table is sent to every task.
BROADCAST_NODES = 1_000_000


def node_table(spark: SparkSession, path: str) -> DataFrame:
    """The nodes of a model that :func:`pacewatch.operators.model.save_model` wrote."""
    stage = f"{path}/stages/1_*"
    node = F.col("nodeData")
    nodes = spark.read.parquet(f"{stage}/data").select(
        F.col("treeID").alias("tree"),
        node["id"].alias("node"),
        F.when(node["leftChild"] >= 0, node["split"]["featureIndex"]).alias("feature"),
        F.when(node["leftChild"] >= 0, F.get(node["split"]["leftCategoriesOrThreshold"], 0)).alias("cut"),
        F.when(node["leftChild"] >= 0, node["leftChild"]).alias("left"),
        F.when(node["leftChild"] >= 0, node["rightChild"]).alias("right"),
        node["prediction"].alias("value"),
        F.when(node["leftChild"] >= 0, node["gain"]).alias("gain"),
        F.get(node["impurityStats"], 0).alias("rows"),
    )
    weights = spark.read.parquet(f"{stage}/treesMetadata").select(F.col("_1").alias("tree"), F.col("_3").alias("weight"))
    return nodes.join(weights, "tree")


def depth_of(spark: SparkSession, path: str) -> int:
    """The greatest depth that the saved model's trees can have."""
    saved = json.loads(spark.read.text(f"{path}/stages/1_*/metadata").first()[0])
    return int({**saved["defaultParamMap"], **saved["paramMap"]}["maxDepth"])


def walk(df: DataFrame, nodes: DataFrame, depth: int, features: Sequence[str] = MODEL_COLUMNS, key: str = "transaction_id") -> DataFrame:
    """(key, probability): every row goes down every tree, one join a level.

    ``key`` names a row. Missing values are 0. A row takes as many steps as trees have
    levels; what is shuffled is one partial sum a row, as its trees stay in its task.
    """
    trees, size = nodes.agg(F.max("tree") + 1, F.count(F.lit(1))).first()
    sent = F.broadcast if size <= BROADCAST_NODES else lambda frame: frame
    values = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in features])
    every = F.explode(F.sequence(F.lit(0), F.lit(int(trees) - 1))).alias("tree")
    at = df.select(F.col(key), values.alias("v"), every).withColumn("node", F.lit(0))
    steps = sent(nodes.select("tree", "node", "feature", "cut", "left", "right"))
    for _ in range(depth):
        goes = F.when(F.col("feature").isNull(), F.col("node")).when(F.get("v", F.col("feature")) <= F.col("cut"), F.col("left")).otherwise(F.col("right"))
        at = at.join(steps, ["tree", "node"]).select(key, "v", "tree", goes.alias("node"))
    ends = at.join(sent(nodes.select("tree", "node", (F.col("value") * F.col("weight")).alias("share"))), ["tree", "node"])
    margin = ends.groupBy(key).agg(F.sum("share").alias("margin"))
    return margin.select(key, (1 / (1 + F.exp(-2 * F.col("margin")))).alias("probability"))


def importances(nodes: DataFrame, features: Sequence[str] = MODEL_COLUMNS) -> DataFrame:
    """(feature, importance): the gain of each input's cuts, weighted by their rows, as a share of all."""
    spark = nodes.sparkSession
    gained = nodes.filter("feature is not null").groupBy("feature").agg(F.sum(F.col("gain") * F.col("rows")).alias("gained"))
    total = gained.agg(F.sum("gained")).first()[0]
    names = spark.createDataFrame(list(enumerate(features)), "feature int, name string")
    share = F.coalesce("gained", F.lit(0.0)) / F.lit(total) if total else F.lit(0.0)
    return names.join(gained, "feature", "left").select(F.col("name").alias("feature"), share.alias("importance"))
