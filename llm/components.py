"""Connected components of an edge table by repeated contraction."""

from functools import reduce

from pyspark.sql import functions as F

from llm.frames import written


def components(edges):
    """``node, label`` for every node of ``edges(a, b)``; nodes of a component share a label.

    Each round maps every node to the smallest node beside it and keeps the edges between
    the images. A node with very many edges is a key of aggregates and joins only, so its
    rows combine before the shuffle or are split by adaptive execution. Rounds are written
    to the shared folder.
    """
    left = written(edges.where("a <> b").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    maps = []
    while True:
        both = left.union(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("b"))
        image = written(least.select(
            F.col("a").alias("node"), F.least("a", "b").alias("label")), "images")
        maps.append(image)
        first = image.select(F.col("node").alias("a"), F.col("label").alias("x"))
        second = image.select(F.col("node").alias("b"), F.col("label").alias("y"))
        left = written(left.join(first, "a").join(second, "b").where("x <> y").select(
            F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges")
        if left.isEmpty():
            break

    def composed(labels, image):
        following = image.select(F.col("node").alias("label"), F.col("label").alias("next"))
        return labels.join(following, "label", "left").select(
            "node", F.coalesce("next", "label").alias("label"))
    return reduce(composed, maps)
