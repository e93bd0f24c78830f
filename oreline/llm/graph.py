"""Connected components by joins: minimum labels with shortcuts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of the nodes of ``edges`` (a, b: long); the component is its least node.

    Each round a node takes the least label among its neighbours', then its label's label; rounds end when none changes. Labels
    are written to the shared folder each round, which cuts the lineage; nothing but a count comes to the driver. A hub's edges
    are reduced by partial aggregation, and its join side can be split.
    """
    both = materialize(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a <> b").distinct(), "cc-edges")
    labels = materialize(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("component")), "cc-labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), F.col("component").alias("l")), "b").groupBy("a").agg(F.min("l").alias("l"))
        lowered = labels.join(near.withColumnRenamed("a", "node"), "node").select("node", F.least("component", "l").alias("next"), F.col("component").alias("was"))
        roots = labels.select(F.col("node").alias("next"), F.col("component").alias("root"))
        new = materialize(lowered.join(roots, "next", "left").select("node", F.least("next", F.coalesce("root", "next")).alias("component"), "was"), "cc-labels")
        changed = new.filter("component <> was").limit(1).count()
        discard(labels)
        labels = new.select("node", "component")
        labels._oreline_path = new._oreline_path
        if not changed:
            discard(both)
            return labels
