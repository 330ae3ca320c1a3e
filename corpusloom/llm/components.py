"""Connected components of a table of links."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.shared import written


def connected(links: DataFrame) -> DataFrame:
    """(node, root) of every node in links (a, b); root is the smallest node of its component.

    Each round a node takes the smallest root among its neighbours, then its root's root, so the
    rounds follow the logarithm of the longest path. Every round ends in a written table.
    """
    both = written(links.select("a", "b").unionByName(
        links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    roots = written(both.groupBy("a").agg(F.min("b").alias("b")).select(
        F.col("a").alias("node"), F.least("a", "b").alias("root")), "roots")
    while True:
        near = (both.join(roots.withColumnRenamed("node", "b"), "b").groupBy("a")
                .agg(F.min("root").alias("near")).withColumnRenamed("a", "node"))
        lower = roots.join(near, "node").select(
            "node", F.col("root").alias("old"), F.least("root", "near").alias("root"))
        above = roots.select(F.col("node").alias("root"), F.col("root").alias("top"))
        step = written(lower.join(above, "root").select(
            "node", "old", F.least("root", "top").alias("root")), "roots")
        roots = step.select("node", "root")
        if step.filter("root <> old").isEmpty():
            return roots
