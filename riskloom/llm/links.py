"""Connected components of stored links, by contraction."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.session import materialize


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``label`` (the smallest node reachable) for all ends of ``edges`` (``a``, ``b``).

    Each round sends a node to its smallest neighbour, follows such steps once more, and
    replaces the ends of all links; links inside a component vanish, so rounds
    shrink fast. Nothing is collected but one flag per round.
    """
    ends = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    nodes = ends.select(F.col("u").alias("node")).union(ends.select("v")).distinct()
    labels = materialize(nodes.withColumn("label", F.col("node")), "labels")
    live = materialize(ends.where("u <> v").select(
        F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "links")
    while not live.isEmpty():
        both = live.union(live.select("v", "u"))
        step = materialize(both.groupBy("u").agg(F.min("v").alias("v"))
                           .select("u", F.least("u", "v").alias("to")), "steps")
        after = step.select(F.col("u").alias("to"), F.col("to").alias("then"))
        step = materialize(step.join(after, "to").select("u", F.col("then").alias("to")), "steps")
        labels = materialize(
            labels.join(step.select(F.col("u").alias("label"), "to"), "label", "left")
            .select("node", F.coalesce("to", "label").alias("label")), "labels")
        moved = (live.join(step, "u").select(F.col("to").alias("a"), F.col("v").alias("u"))
                 .join(step, "u").select(F.least("a", "to").alias("u"), F.greatest("a", "to").alias("v")))
        live = materialize(moved.where("u <> v").distinct(), "links")
    # A label may have been replaced after it was given; the smallest node names the component.
    smallest = labels.groupBy("label").agg(F.min("node").alias("least"))
    return materialize(labels.join(smallest, "label").select("node", F.col("least").alias("label")), "labels")
