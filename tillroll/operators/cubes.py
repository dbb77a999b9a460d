"""Stored aggregates beside the fact: line counts, and bitmaps by which exact
distinct counts add up.

Orders and customers get dense numbers.  A bitmap holds which of 32 768
neighbouring numbers occur on a date, in a branch, in a department; the bitmaps
of any selection are or-ed and counted, so a distinct count under a filter
never reads the fact again.  Orders are numbered by date: those of one date
share few bitmaps.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.session import ensure_checkpoint_dir

KEYS = ["product_key", "date_key", "branch_key"]
ORDER, CUSTOMER = "order", "customer"


def line_counts(fact: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """The fact per (product, date, branch) instead of per line, with ``_lines``,
    ``_quantity`` and ``_reordered`` to add up."""
    return fact.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_lines"),
        F.sum("quantity").alias("_quantity"),
        F.count_if("reordered").alias("_reordered"),
    )


def row_numbers(placed: DataFrame) -> DataFrame:
    """``placed`` (a checkpoint: partitions and their order stay) with
    ``number``, from 0 without a gap in the order of its rows.  A prefix sum in
    two passes: a row number within each partition is added to the sizes of
    those before it."""
    part = F.spark_partition_id()
    place = F.monotonically_increasing_id() - F.shiftleft(part.cast("long"), 33)
    placed = placed.withColumns({"_part": part, "_place": place})
    # A row per partition.
    sizes = sorted((r["_part"], r["count"]) for r in placed.groupBy("_part").count().collect())
    starts, total = [], 0
    for number, size in sizes:
        starts.append((number, total))
        total += size
    offsets = placed.sparkSession.createDataFrame(starts, "_part int, _start long")
    numbered = placed.join(F.broadcast(offsets), "_part").withColumn("number", F.col("_start") + F.col("_place"))
    return numbered.drop("_part", "_place", "_start")


def dense_numbers(values: DataFrame, column: str, order_by: list[str]) -> DataFrame:
    """(column, number): the distinct non-null values numbered from 0 without a
    gap, by ``order_by`` and value."""
    ensure_checkpoint_dir(values.sparkSession)
    known = values.where(F.col(column).isNotNull())
    distinct = known.groupBy(column).agg(*[F.min(c).alias(c) for c in order_by]) if order_by else known.distinct()
    keys = [*order_by, column]
    # Kept as it is: another sample would cut the ranges elsewhere.
    placed = distinct.repartitionByRange(*keys).sortWithinPartitions(*keys).checkpoint()
    return row_numbers(placed).select(column, "number")


def distinct_cube(fact: DataFrame, dim_product: DataFrame) -> DataFrame:
    """(kind, department_name, known, date_key, branch_key, bucket, bits): which
    orders and which customers occur there.  ``known`` is false for lines whose
    product the dimension lacks.

    A row per order goes through the numbering, with the set of its departments.
    """
    ensure_checkpoint_dir(fact.sparkSession)
    departments = dim_product.select("product_key", "department_name", F.lit(True).alias("known")).distinct()
    placed = fact.select("product_key", "order_id_nk", "customer_key", "date_key", "branch_key").join(departments, "product_key", "left")
    department = F.struct("department_name", F.coalesce("known", F.lit(False)).alias("known"))
    per_order = placed.groupBy("order_id_nk", "customer_key", "date_key", "branch_key").agg(F.collect_set(department).alias("departments")).checkpoint()
    orders = _bitmaps(per_order, ORDER, "order_id_nk", ["date_key"])
    return orders.unionByName(_bitmaps(per_order, CUSTOMER, "customer_key", []))


def _bitmaps(per_order: DataFrame, kind: str, column: str, order_by: list[str]) -> DataFrame:
    """The cube's rows of one kind.

    A bitmap is 4 KB even of a single number, so numbers are brought together
    before bitmaps are made of them: one per row of the cube, and none from each
    task that holds a part.  At most 32 768 different numbers share a bucket.
    """
    numbers = dense_numbers(per_order.select(column, *order_by), column, order_by)
    seen = per_order.select(column, "date_key", "branch_key", "departments").distinct().join(numbers, column)
    seen = seen.select("date_key", "branch_key", "departments", F.bitmap_bucket_number("number").alias("bucket"), F.bitmap_bit_position("number").alias("_bit"))
    together = seen.repartition("bucket", "date_key", "branch_key").select("date_key", "branch_key", "bucket", "_bit", F.inline("departments"))
    return (
        together.groupBy(F.lit(kind).alias("kind"), "department_name", "known", "date_key", "branch_key", "bucket")
        .agg(F.bitmap_construct_agg("_bit").alias("bits"))
    )


def distinct_counts(cube: DataFrame, keys: list[str | Column], kind: str) -> DataFrame:
    """(keys, ``kind``s): how many different ones per key."""
    return (
        cube.where(F.col("kind") == kind)
        .groupBy(*keys, "bucket")
        .agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("_n"))
        .groupBy(*keys)
        .agg(F.sum("_n").cast("long").alias(f"{kind}s"))
    )


def distinct_total(cube: DataFrame, kind: str) -> Column:
    """The same over all rows, as a scalar subquery."""
    return distinct_counts(cube, [], kind).select(F.coalesce(F.col(f"{kind}s"), F.lit(0))).scalar()
