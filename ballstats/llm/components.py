"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ballstats.llm import common


def components(links: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """``node`` and ``label``, the smallest node that can be reached, for every node of a link.

    Each round takes the smallest label among neighbours and then that label's own label, so that
    chains halve. Labels of a round are written to the shared folder, which cuts the lineage.
    """
    both = links.select(F.col(left).alias("node"), F.col(right).alias("other"))
    both = both.union(both.select("other", "node")).where("node <> other").distinct()
    both = common.stored(both, "links")
    labels = common.stored(
        both.groupBy("node").agg(F.min("other").alias("least")).select("node", F.least("node", "least").alias("label")), "labels"
    )
    while True:
        near = both.join(labels.select(F.col("node").alias("other"), "label"), "other").groupBy("node").agg(F.min("label").alias("near"))
        stepped = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("next"))
        jump = labels.select(F.col("node").alias("next"), F.col("label").alias("further"))
        fresh = stepped.join(jump, "next").select(
            "node", F.least("next", "further").alias("label"), (F.least("next", "further") < F.col("label")).alias("moved")
        )
        fresh = common.stored(fresh, "labels")
        common.dropped(labels)
        labels = fresh.select("node", "label")
        if not fresh.where("moved").limit(1).count():
            common.dropped(both)
            return labels
