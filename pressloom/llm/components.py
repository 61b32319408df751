"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressloom.llm.common import stage


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node of ``links``: the smallest node reachable.

    Rounds of: every node takes the smallest label among its own and its neighbours',
    then the label of its label. Rounds end when no label changes; a star or a clique
    takes two, a chain about the logarithm of its length. Only (node, label) pairs
    are shuffled, minima are combined before the shuffle, and every round is staged.
    """
    both = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u is not null and v is not null and u <> v")
    edges = stage(both.union(both.select("v", "u")).distinct(), "component-edges", narrow=True)
    labels = stage(edges.groupBy("u").agg(F.least("u", F.min("v")).alias("label")).select(F.col("u").alias("node"), "label"), "component-labels", narrow=True)
    while True:
        seen = edges.join(labels, F.col("v") == F.col("node")).groupBy("u").agg(F.min("label").alias("near"))
        hooked = labels.join(seen, F.col("node") == F.col("u")).select("node", F.col("label").alias("was"), F.least("label", "near").alias("label"))
        hooked = stage(hooked, "component-hooked", narrow=True)
        up = hooked.select(F.col("node").alias("_up"), F.col("label").alias("_top"))
        labels = stage(hooked.join(up, F.col("label") == F.col("_up"))
                       .select("node", "was", F.least("label", "_top").alias("label")), "component-labels", narrow=True)
        if labels.where("label <> was").limit(1).count() == 0:
            return labels.select("node", F.col("label").alias("component"))
        labels = labels.drop("was")
