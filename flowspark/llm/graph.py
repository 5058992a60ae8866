"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowspark.llm.common import Scratch


def components(links: DataFrame) -> DataFrame:
    """Each linked node and the least node of its component: columns node, label.

    `links` has columns a and b, in either direction, repeated or not. Every round takes the least label of the neighbours
    and then the label of the label, so paths shorten by half; rounds end when nothing changes. No links give no rows.
    """
    ends = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    links_kept, last = Scratch(), Scratch()
    edges = links_kept.kept(ends.where("a <> b").distinct(), "edges")
    labels = last.kept(edges.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("label")), "labels")
    while True:
        near = edges.join(labels, edges.b == labels.node).groupBy("a").agg(F.min("label").alias("near"))
        hooked = labels.join(near, labels.node == near.a).select("node", "label", F.least("label", "near").alias("new"))
        of = labels.select(F.col("node").alias("new"), F.col("label").alias("next"))
        this = Scratch()
        moved = this.kept(hooked.join(of, "new").select("node", "label", F.least("new", "next").alias("new")), "labels")
        last.clear()
        labels, last = moved.select("node", F.col("new").alias("label")), this
        if moved.where("new <> label").isEmpty():
            links_kept.clear()
            return labels
