"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed


def components(links: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """``node`` and ``component`` (the smallest node reachable) for the ends of ``links`` (``a``, ``b``).

    With ``before``, the components of earlier links, only what these leave apart is worked on. Each round a node takes the smallest
    label among its neighbours' and its own, then the label of its label; the rounds end when no label changes. Labels are written to
    the checkpoint folder each round, and only a count of changes reaches the driver.
    """
    if before is not None:
        for end in ("a", "b"):
            known = before.select(F.col("node").alias(end), F.col("component").alias("__label"))
            links = links.join(known, end, "left").withColumn(end, F.coalesce("__label", end)).drop("__label")
    links = links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    both = checkpointed(links.select(F.col("a").alias("node"), F.col("b").alias("near")).union(links.select("b", "a")))
    labels = checkpointed(both.groupBy("node").agg(F.least(F.col("node"), F.min("near")).alias("component")))
    changed = not labels.isEmpty()
    while changed:
        seen = both.join(labels.select(F.col("node").alias("near"), F.col("component").alias("theirs")), "near")
        lowest = seen.groupBy("node").agg(F.min("theirs").alias("theirs"))
        nearer = labels.join(lowest, "node").select("node", F.col("component").alias("before"), F.least("component", "theirs").alias("component"))
        jump = nearer.select(F.col("node").alias("component"), F.col("component").alias("beyond"))
        nearer = checkpointed(
            nearer.join(jump, "component", "left").select(
                "node", "before", F.least("component", F.coalesce("beyond", "component")).alias("component")
            )
        )
        changed = not nearer.where("component <> before").isEmpty()
        labels = nearer.select("node", "component")
    if before is None:
        return labels
    moved = labels.select(F.col("node").alias("component"), F.col("component").alias("__label"))
    old = before.join(moved, "component", "left").select("node", F.coalesce("__label", "component").alias("component"))
    return checkpointed(old.union(labels.join(before, "node", "left_anti")))
