"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.workspace import write_table


def components(links: DataFrame) -> DataFrame:
    """id and label, the smallest id of its component, of every id in the links a and b.

    Each round takes the smallest label among neighbours, then the label's own label; written
    tables cut the lineage. The rounds grow with the logarithm of the longest path, usually.
    """
    both = links.select("a", "b").union(links.select("b", "a")).filter("a <> b")
    edges = write_table(both, "edges")
    labels = edges.groupBy(F.col("a").alias("id")).agg(F.least(F.min("a"), F.min("b")).alias("label"))
    labels = write_table(labels, "labels")
    total = None
    while True:
        near = edges.join(labels.select(F.col("id").alias("b"), "label"), "b").groupBy(F.col("a").alias("id"))
        near = near.agg(F.min("label").alias("near"))
        lower = labels.join(near, "id").select("id", F.least("label", "near").alias("label"))
        own = lower.select(F.col("id").alias("label"), F.col("label").alias("lowest"))
        labels = write_table(lower.join(own, "label").select("id", F.col("lowest").alias("label")), "labels")
        now = labels.agg(F.sum(F.col("label").cast("decimal(38,0)"))).first()[0]
        if now == total:
            return labels
        total = now
