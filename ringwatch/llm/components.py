"""Connected components of a link table."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringwatch.session import Scratch


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """``node, label``: the smallest node reachable, for every node of the links ``a, b``.

    In each round a node takes the smallest label among its neighbours and itself,
    then the label of that label, which halves the way left to the smallest node.
    Every round is written down, so no lineage grows; only an emptiness test reaches
    the driver. A hub is a hot key of joins between plain tables, which adaptive
    execution splits, and its neighbours' labels are combined before they move.
    """
    ends = F.array(
        F.struct(F.col("a").alias("node"), F.col("b").alias("other")),
        F.struct(F.col("b").alias("node"), F.col("a").alias("other")),
    )
    both = links.filter("a <> b").select(F.explode(ends).alias("e")).select("e.*").distinct()
    both = scratch.cut(both, "links")
    labels = both.groupBy("node").agg(F.min("other").alias("label"))
    labels = scratch.cut(labels.select("node", F.least("node", "label").alias("label")), "labels")
    while True:
        near = labels.select(F.col("node").alias("other"), F.col("label").alias("heard"))
        heard = both.join(near, "other").groupBy("node").agg(F.min("heard").alias("heard"))
        told = labels.join(heard, "node").select(
            "node", F.col("label").alias("old"), F.least("label", "heard").alias("label")
        )
        told = scratch.cut(told, "told")
        root = told.select(F.col("node").alias("label"), F.col("label").alias("next"))
        jumped = told.join(root, "label").select("node", "old", F.col("next").alias("label"))
        labels = scratch.cut(jumped, "labels")
        if labels.filter("label <> old").isEmpty():
            return labels.select("node", "label")
