"""Connected components of a link table, by minimum labels.

Each round takes every vertex to the smallest label in its neighbourhood and
then jumps pointers (label of the label), which halves the remaining distance
to the root, so rounds grow with the logarithm of the longest path.  Labels
never leave the executors: a round is two joins and an aggregation, its result
is a checkpoint, and only the number of changed vertices reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import checkpoint


def components(links: DataFrame) -> DataFrame:
    """(vertex, root) for every vertex of ``links`` (a, b), both long; root is
    the smallest vertex that a path reaches, the vertex itself included.

    Direction, repeats and self-links of the rows do not matter; rows with a
    null end are ignored; no rows give no rows.
    """
    both = (
        links.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
        .select(F.expr("inline(array(named_struct('v', a, 'u', b), named_struct('v', b, 'u', a)))"))
        .distinct()
    )
    both = checkpoint(both)
    labels = checkpoint(both.groupBy("v").agg(F.min("u").alias("u")).select("v", F.least("v", "u").alias("root")))
    while True:
        near = (
            both.join(labels.withColumnRenamed("v", "u").withColumnRenamed("root", "near"), "u")
            .groupBy("v")
            .agg(F.min("near").alias("near"))
        )
        met = labels.join(near, "v").select("v", "root", F.least("root", "near").alias("low"))
        # Hooking: the old root learns the smaller label as well, so a whole tree moves with one of its vertices.
        hooks = met.where("low < root").groupBy(F.col("root").alias("v")).agg(F.min("low").alias("hook"))
        met = met.join(hooks, "v", "left").select("v", F.col("root").alias("was"), F.least("low", "hook").alias("low"))
        jump = met.select(F.col("v").alias("low"), F.col("low").alias("up"))
        labels_next = checkpoint(
            met.join(jump, "low", "left").select("v", "was", F.least("low", "up").alias("root"))
        )
        if labels_next.where("root < was").isEmpty():
            return labels_next.select(F.col("v").alias("vertex"), "root")
        labels = labels_next.select("v", "root")
