"""Running sums without a window per group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.session import ensure_checkpoint_dir


def running_sums(df: DataFrame, group: str, order: str, value: str) -> DataFrame:
    """(group, order, total): one row per distinct pair, the sum of ``value``
    over the group's rows up to and including that place (nulls last).

    Two passes: the distinct places are range partitioned by group and place,
    so a group with many of them lies in many partitions; sums run within a
    partition, and what a group brings from earlier partitions is added.  Only
    the first group of a partition can bring anything, a row a partition.
    """
    ensure_checkpoint_dir(df.sparkSession)
    steps = df.groupBy(group, order).agg(F.sum(value).alias("_step"))
    keys = [F.col(group), F.col(order).isNull(), F.col(order)]
    # Kept as it is: another sample would cut the ranges elsewhere.
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # named, so that small ones are not put together
    placed = steps.repartitionByRange(parts, *keys).checkpoint().withColumn("_part", F.spark_partition_id())
    within = Window.partitionBy("_part", group).orderBy(F.asc_nulls_last(order)).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        placed.groupBy(group, "_part")
        .agg(F.sum("_step").alias("_sum"))
        .select(group, "_part", F.sum("_sum").over(before).alias("_carried"))
        .where("_carried IS NOT NULL")
    )
    summed = placed.withColumn("_own", F.sum("_step").over(within)).join(F.broadcast(carried), [group, "_part"], "left")
    return summed.select(group, order, (F.col("_own") + F.coalesce("_carried", F.lit(0))).alias("total"))
