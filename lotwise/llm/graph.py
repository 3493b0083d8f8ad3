"""Connected components of links between documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Staged


def components(links: DataFrame, staged: Staged) -> DataFrame:
    """(id, label) of all ids in links (a, b): the smallest id that each reaches.

    Each round gives both ends of a link, and the labels they had, the smaller of their labels, then replaces every label by
    its own label. Sides of every join are tables, so Spark splits the links of a hub."""
    edges = staged.write("edges", links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = staged.write("labels", edges.groupBy(F.col("a").alias("id")).agg(F.min(F.least("a", "b")).alias("label")))
    while True:
        at_a, at_b = (labels.select(F.col("id").alias(c), F.col("label").alias(f"label_{c}")) for c in "ab")
        crossing = staged.write("crossing", edges.join(at_a, "a").join(at_b, "b").filter("label_a < label_b").select("b", "label_a", "label_b"))
        if crossing.isEmpty():
            return labels
        better = crossing.select(F.col("b").alias("id"), "label_a").unionByName(crossing.select(F.col("label_b").alias("id"), "label_a"))
        better = staged.write("better", better.groupBy("id").agg(F.min("label_a").alias("better")))
        hooked = staged.write("hooked", labels.join(better, "id", "left").select("id", F.least("label", F.coalesce("better", "label")).alias("label")))
        up = hooked.select(F.col("id").alias("label"), F.col("label").alias("root"))
        labels = staged.write("labels", hooked.join(up, "label", "left").select("id", F.coalesce("root", "label").alias("label")))
