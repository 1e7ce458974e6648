"""Connected components of a distributed edge list.

Labels are the smallest node known to be reachable. A round sends labels over all edges, keeps the minimum
by node and then jumps to the label of the label, so the distance that a label covers at least doubles. Each
round's labels are a table in the shared checkpoint folder: lost executors cost a re-read, and both sides of
each join are plain shuffles, so that adaptive execution can split a node with very many edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankwell.llm.frames import cut_lineage


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of the edges (a, b); label is the smallest node of its component.

    Repeated edges and loops are harmless; an empty edge list gives no rows.
    """
    pairs = edges.select("a", "b").filter("a <> b")
    both = cut_lineage(pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = cut_lineage(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("label")))
    while True:
        sent = both.join(labels, both.a == labels.node).select(F.col("b").alias("node"), "label", F.lit(None).cast("long").alias("old"))
        best = sent.unionByName(labels.withColumn("old", F.col("label"))).groupBy("node").agg(
            F.min("label").alias("label"), F.max("old").alias("old"))
        of = labels.select(F.col("node").alias("via"), F.col("label").alias("further"))
        labels = cut_lineage(best.join(of, best.label == of.via).select(
            "node", F.least("label", "further").alias("label"), "old"))
        if labels.filter("label < old").isEmpty():
            return labels.select("node", "label")
        labels = labels.select("node", "label")
