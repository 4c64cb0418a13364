"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kelpforge.session import materialize


def components(edges: DataFrame) -> DataFrame:
    """(doc_id, label): the smallest id of each node's component, from edges (a, b).

    Each round takes the least label among the neighbours and then the label's own label
    (pointer jumping), so chains shrink fast and stars need two rounds. Only the count of
    changed labels comes to the driver.
    """
    both = materialize(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct(), "edges")
    labels = materialize(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("label")).withColumnRenamed("a", "doc_id"), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("doc_id", "b"), "b").groupBy("a").agg(F.min("label").alias("near"))
        step = labels.join(near.withColumnRenamed("a", "doc_id"), "doc_id").select("doc_id", F.col("label").alias("was"), F.least("label", "near").alias("label"))
        step = materialize(step, "step")
        up = step.select(F.col("doc_id").alias("label"), F.col("label").alias("up"))
        after = materialize(step.join(up, "label", "left").select("doc_id", "was", F.least(F.coalesce("up", "label"), "label").alias("label")), "labels")
        if after.where("label <> was").limit(1).count() == 0:
            return after.select("doc_id", "label")
        labels = after.select("doc_id", "label")
