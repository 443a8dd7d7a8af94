"""Connected components of a table of links, as repeated joins and minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandfold.llm.common import forget, stored


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node of a stored table of links; root is the smallest node it reaches.

    Each round gives both ends of a link the smaller of their labels and then follows
    the label one step (pointer jumping), so the rounds grow with the logarithm of the
    longest chain. Labels are written each round; both sides of every join come
    from files, so Spark can split a node with very many links. No link: an empty table.
    """
    links = links.select(F.col(a).alias("a"), F.col(b).alias("b"))
    both = links.union(links.select("b", "a"))
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("root")), "labels")
    while True:
        near = labels.select(F.col("node").alias("b"), F.col("root").alias("label"))
        heard = both.join(near, "b").select(F.col("a").alias("node"), "label")
        own = labels.select("node", F.col("root").alias("label"))
        least = heard.union(own).groupBy("node").agg(F.min("label").alias("label"))
        step = labels.select(F.col("node").alias("label"), F.col("root").alias("next"))
        jumped = least.join(step, "label").select("node", F.least("label", "next").alias("root"))
        after = stored(jumped, "labels")
        changed = after.join(labels, ["node", "root"], "left_anti").limit(1).count()
        forget(labels)
        labels = after
        if not changed:
            return labels
