"""Silver layer: typed, null-filtered, de-duplicated staging tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed value: day zero of the synthetic calendar.
SYNTHETIC_EPOCH = dt.date(2024, 1, 1)

# Distinct order numbers of one key are split into buckets of this width, so
# the running sum of a key with very many of them is spread over tasks.
RUNNING_SUM_BUCKET = 4096
LAST_BUCKET = 2**62  # of rows without an order number, which come last


def _round_to_int(c: Column) -> Column:
    """DOUBLE -> INT rounding half-to-even (a plain cast would truncate)."""
    return F.rint(c).cast("int")


def typed_orders(bronze_orders: DataFrame) -> DataFrame:
    """Cast, drop rows with null keys, missing gap -> 0."""
    return bronze_orders.where(
        F.col("order_id").isNotNull() & F.col("user_id").isNotNull()
    ).select(
        F.col("order_id").cast("long").alias("order_id"),
        F.col("user_id").cast("long").alias("user_id"),
        F.col("order_number").cast("int").alias("order_number"),
        F.col("order_dow").cast("int").alias("order_dow"),
        F.col("order_hour_of_day").cast("int").alias("order_hour_of_day"),
        F.coalesce(_round_to_int(F.col("days_since_prior_order")), F.lit(0)).alias(
            "days_since_prior_order"
        ),
    )


def running_sum(
    df: DataFrame,
    key: str,
    order_col: str,
    value_col: str,
    out_col: str,
    bucket_width: int = RUNNING_SUM_BUCKET,
) -> DataFrame:
    """``sum(value) over (partition by key order by order_col nulls last)`` with
    the default RANGE frame (ties on ``order_col`` share one value), computed
    so that neither a hot key nor a hot tie is one task's work:

    1. per (key, order_col) totals, an aggregation with map-side combine: ties
       collapse before the shuffle, however many rows they have;
    2. those distinct numbers in buckets (order_col div width): running sum
       inside each (key, bucket), plus the totals of the buckets before;
    3. the sums joined back to the rows on (key, order_col).
    """
    totals = df.groupBy(F.col(key).alias("_rs_key"), F.col(order_col).alias("_rs_order")).agg(
        F.sum(value_col).alias("_rs_total")
    )
    bucket = F.coalesce(F.floor(F.col("_rs_order") / F.lit(bucket_width)), F.lit(LAST_BUCKET))
    totals = totals.withColumn("_rs_bucket", bucket)
    before = Window.partitionBy("_rs_key").orderBy("_rs_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.groupBy("_rs_key", "_rs_bucket").agg(F.sum("_rs_total").alias("_rs_sum")).select(
        F.col("_rs_key").alias("_rs_okey"),
        F.col("_rs_bucket").alias("_rs_obucket"),
        F.coalesce(F.sum("_rs_sum").over(before), F.lit(0)).alias("_rs_off"),
    )
    inside = Window.partitionBy("_rs_key", "_rs_bucket").orderBy("_rs_order").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    sums = (
        totals.withColumn("_rs_in", F.sum("_rs_total").over(inside))
        .join(
            offsets,
            F.col("_rs_key").eqNullSafe(F.col("_rs_okey")) & (F.col("_rs_bucket") == F.col("_rs_obucket")),
        )
        .select("_rs_key", "_rs_order", (F.col("_rs_in") + F.col("_rs_off")).alias(out_col))
    )
    return df.join(
        sums, F.col(key).eqNullSafe(F.col("_rs_key")) & F.col(order_col).eqNullSafe(F.col("_rs_order")), "left"
    ).drop("_rs_key", "_rs_order")


def synthetic_order_date(typed: DataFrame, bucket_width: int = RUNNING_SUM_BUCKET) -> DataFrame:
    """Epoch + running sum of gaps per user in order-number order."""
    with_sum = running_sum(
        typed, "user_id", "order_number", "days_since_prior_order", "_days", bucket_width
    )
    return with_sum.withColumn(
        "synthetic_order_date",
        F.date_add(F.lit(SYNTHETIC_EPOCH), F.col("_days").cast("int")),
    ).drop("_days")


def stg_orders(bronze_orders: DataFrame, bucket_width: int = RUNNING_SUM_BUCKET) -> DataFrame:
    """T1 + T2."""
    return synthetic_order_date(typed_orders(bronze_orders), bucket_width)


def stg_order_products(prior: DataFrame, train: DataFrame) -> DataFrame:
    """Union both line files, drop null keys, cast, distinct 4-tuple
    (distinct = hash aggregate with map-side combine, so copies collapse
    before the shuffle)."""
    cols = ["order_id", "product_id", "add_to_cart_order", "reordered"]
    both = prior.select(*cols).unionByName(train.select(*cols))
    return (
        both.where(F.col("order_id").isNotNull() & F.col("product_id").isNotNull())
        .select(
            F.col("order_id").cast("long").alias("order_id"),
            F.col("product_id").cast("long").alias("product_id"),
            F.col("add_to_cart_order").cast("int").alias("add_to_cart_order"),
            F.col("reordered").cast("int").alias("reordered"),
        )
        .distinct()
    )


def stg_products(products: DataFrame) -> DataFrame:
    """T4: cast, trim names (spaces only, like SQL trim), drop null ids."""
    return products.where(F.col("product_id").isNotNull()).select(
        F.col("product_id").cast("long").alias("product_id"),
        F.trim(F.col("product_name")).alias("product_name"),
        F.col("aisle_id").cast("int").alias("aisle_id"),
        F.col("department_id").cast("int").alias("department_id"),
    )


def stg_users(orders: DataFrame) -> DataFrame:
    """T5: number of staged order rows per user."""
    return orders.groupBy(F.col("user_id").cast("long").alias("user_id")).agg(
        F.count(F.lit(1)).alias("total_orders")
    )
