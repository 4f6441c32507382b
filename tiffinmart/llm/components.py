"""Connected components over links between 64-bit ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiffinmart.llm.storage import settled


def components(links: DataFrame) -> DataFrame:
    """node, comp: the least id reachable, for every node of `links` (a, b).

    Each round takes the least label among neighbours and then follows labels twice, so that the number of rounds
    grows with the logarithm of the longest path. Every round is a written table.
    """
    both = links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a <> b").distinct()
    edges = settled(both, "edges")
    labels = settled(edges.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("comp")), "labels")
    while True:
        heard = edges.join(labels, edges["b"] == labels["node"]).groupBy("a").agg(F.min("comp").alias("heard"))
        nearer = labels.join(heard, labels["node"] == heard["a"]).select("node", F.least("comp", "heard").alias("comp"), F.col("comp").alias("was"))
        jump = labels.select(F.col("node").alias("via"), F.col("comp").alias("to"))
        moved = nearer.join(jump, nearer["comp"] == jump["via"]).select("node", F.least("comp", "to").alias("comp"), "was")
        new = settled(moved, "labels")
        labels = new.select("node", "comp")
        if new.filter("comp <> was").isEmpty():
            return labels
