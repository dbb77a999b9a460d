"""Running sums over range partitions against a plain window."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from tillroll.operators.prefix import running_sums


def test_hot_and_tied_groups(spark):
    rng = random.Random(3)
    rows = [(1, n, rng.randint(0, 30)) for n in range(6000)]  # a third and more of all rows
    rows += [(u, rng.choice([None, *range(9)]), rng.randint(-3, 9)) for u in range(2, 400) for _ in range(rng.randint(1, 20))]
    df = spark.createDataFrame(rows, "u long, n int, v int").repartition(7)
    plain = Window.partitionBy("u").orderBy(F.asc_nulls_last("n"))
    want = df.select("u", "n", F.sum("v").over(plain).alias("total")).distinct()
    got = running_sums(df, "u", "n", "v")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_a_hot_group_spreads_over_tasks(spark):
    df = spark.range(8000).select(F.lit(7).alias("u"), F.col("id").alias("n"), F.lit(1).alias("v"))
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    out = running_sums(df, "u", "n", "v")
    tasks = out.withColumn("p", F.spark_partition_id()).groupBy("p").count().collect()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert len(tasks) > 1 and max(r["count"] for r in tasks) < 6000
    assert out.where("total <> n + 1").count() == 0


def test_no_rows(spark):
    assert running_sums(spark.createDataFrame([], "u long, n int, v int"), "u", "n", "v").count() == 0
