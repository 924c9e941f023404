"""Connected components of a table of links, by hooking and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import materialize


def connected(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, label): the least node of each node's component; nodes without links are left out.

    Each round a node takes the least label among its neighbours' and its own,
    then the label's label. Labels are written each round, so no round repeats
    another's work; rounds end when nothing changes. A star takes two rounds, a
    chain as many as the logarithm of its length.
    """
    both = links.select(F.col(a).alias("node"), F.col(b).alias("other"))
    both = both.unionByName(both.select(F.col("other").alias("node"), F.col("node").alias("other")))
    both = materialize(both.where("node <> other").distinct(), "graph")
    labels = both.groupBy("node").agg(F.min("other").alias("low"))
    labels = materialize(labels.select("node", F.least("node", "low").alias("label")), "labels")
    while True:
        theirs = labels.select(F.col("node").alias("other"), F.col("label").alias("near"))
        # The partial minimum is taken before the shuffle, so a hub is one row per task.
        low = both.join(theirs, "other").groupBy("node").agg(F.min("near").alias("near"))
        hooked = labels.join(low, "node").select("node", "label", F.least("label", "near").alias("next"))
        jump = labels.select(F.col("node").alias("next"), F.col("label").alias("far"))
        moved = hooked.join(jump, "next").select(
            "node", F.least("next", "far").alias("label"), (F.least("next", "far") < F.col("label")).alias("moved")
        )
        moved = materialize(moved, "labels")
        labels = moved.select("node", "label")
        if moved.where("moved").isEmpty():
            return labels


def with_links(labels: DataFrame, links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, label) after more links: only the components that they join are worked on."""
    ends = links.select(F.explode(F.array(a, b)).alias("node")).distinct()
    new = ends.join(labels.select("node"), "node", "left_anti").withColumn("label", F.col("node"))
    nodes = materialize(labels.select("node", "label").unionByName(new), "nodes")
    of = lambda end, label: nodes.select(F.col("node").alias(end), F.col("label").alias(label))
    between = links.select(a, b).join(of(a, "_la"), a).join(of(b, "_lb"), b).where("_la <> _lb")
    joined = connected(between.select("_la", "_lb").distinct(), "_la", "_lb")
    joined = joined.select(F.col("node").alias("label"), F.col("label").alias("_least"))
    moved = nodes.join(joined, "label", "left").select("node", F.coalesce("_least", "label").alias("label"))
    return materialize(moved, "labels")
