"""Fitted tree ensembles as tables: nodes as rows, and rows walked down by joins.

A fitted ensemble is saved in the shared folder and its nodes are read back as a table, so
they can be queried, stored and joined like any other; no node passes through the driver.
"""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tidecast.session import scratch_path


def node_table(model, spark):
    """``tree, node, feature, threshold, left, right, prediction`` of a fitted ensemble.

    A leaf has -1 for ``feature``, ``left`` and ``right``. There are at most 2^(depth + 1)
    rows a tree, whatever it was fitted on.
    """
    path = scratch_path(spark, "ensemble")
    model.save(path)
    node = F.col("nodeData")
    split = node["split"]
    leaf = node["leftChild"] < 0
    return spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), node["id"].alias("node"),
        F.when(leaf, -1).otherwise(split["featureIndex"]).alias("feature"),
        F.when(~leaf, F.get(split["leftCategoriesOrThreshold"], F.lit(0))).alias("threshold"),
        node["leftChild"].alias("left"), node["rightChild"].alias("right"),
        node["prediction"].alias("prediction"))


def leaves(rows, nodes, trees, depth):
    """Each row with ``tree``, ``leaf`` and the leaf's ``prediction``, for every tree.

    ``rows`` have an assembled ``features`` vector. A row goes one level down with each of
    ``depth`` joins; one that has come to a leaf stays. The node table is bounded by the
    ensemble's size, so it is broadcast.
    """
    inner = F.broadcast(nodes.where("left >= 0").select(
        F.col("tree").alias("_tree"), F.col("node").alias("_node"), "feature", "threshold",
        "left", "right"))
    found = rows.withColumn("_values", vector_to_array("features")).withColumn(
        "tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1)))).withColumn("leaf", F.lit(0))
    for _ in range(depth):
        below = F.when(F.get("_values", F.col("feature")) <= F.col("threshold"), F.col("left")) \
            .otherwise(F.col("right"))
        found = found.join(inner, (F.col("tree") == F.col("_tree")) & (F.col("leaf") == F.col("_node")),
                           "left").withColumn("leaf", F.coalesce(below, "leaf")).drop(
            "_tree", "_node", "feature", "threshold", "left", "right")
    ends = F.broadcast(nodes.where("left < 0").select(
        "tree", F.col("node").alias("leaf"), "prediction"))
    return found.drop("_values").join(ends, ["tree", "leaf"])


def leaf_statistics(routed):
    """``n`` and mean label of the rows in each leaf, beside what the leaf predicts."""
    return routed.groupBy("tree", "leaf").agg(
        F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean"),
        F.first("prediction").alias("prediction"))
