"""Map the driver's TPC-H-style tables onto the retail source roles.

The warehouse expects grocery-order sources (orders, order lines, products,
aisles, departments, a branch seed and a run log).  The test data is a
TPC-H-like star, so this module derives each role from it with the rules in
SURVEY §7.2.  Everything is lazy and built from whole tables.

Skew: the per-customer windows (order number, gap to the previous order) are
computed on the *distinct (customer, day)* set, which is bounded by the
calendar per customer, and joined back -- a customer holding a third of all
orders never lands in one window task with all of its rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillroll.schemas import DEFAULT_BRANCH_ID

# Fixed values of the adapter.
PRIOR_LINESTATUS = "F"
TRAIN_LINESTATUS = "O"
REORDERED_RETURNFLAG = "R"
DEFAULT_BRANCH_REGION = "ASIA"
MAX_DAYS_SINCE_PRIOR = 30
ORGANIC_PATTERN_ON_TEST_DATA = "red"
FAILED_EVENT_TYPE = "error"
UNFINISHED_EVENT_TYPE = "view"
UNSTARTED_EVENT_TYPE = "signup"


@dataclass(frozen=True)
class RawSources:
    """The bronze-role inputs of one warehouse build."""

    orders: DataFrame
    order_products_prior: DataFrame
    order_products_train: DataFrame
    products: DataFrame
    aisles: DataFrame
    departments: DataFrame
    branches: DataFrame
    # Rows that did not fit their types, where the sources were read checked.
    rejects: DataFrame | None = None


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def orders_role(orders: DataFrame) -> DataFrame:
    """orders -> (order_id, user_id, eval_set, order_number, order_dow,
    order_hour_of_day, days_since_prior_order)."""
    o = orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderdate").alias("_ts"),
        F.to_date("o_orderdate").alias("_day"),
    )
    # One row per (customer, day): first order of the day, previous active
    # day and the month rank.  Bounded by the calendar per customer.
    days = o.groupBy("user_id", "_day").agg(F.min("order_id").alias("_first_id"))
    by_day = Window.partitionBy("user_id").orderBy("_day")
    by_month = Window.partitionBy("user_id").orderBy(F.trunc("_day", "month"))
    days = days.select(
        "user_id",
        "_day",
        "_first_id",
        F.lag("_day").over(by_day).alias("_prev_day"),
        F.dense_rank().over(by_month).cast("int").alias("order_number"),
    )
    j = o.join(days, ["user_id", "_day"])
    # Previous order in (date, key) order: same day -> 0 days; otherwise the
    # last active day before; none -> null.  Capped at 30 (null stays null).
    gap = F.when(F.col("order_id") != F.col("_first_id"), F.lit(0)).otherwise(
        F.datediff("_day", "_prev_day")
    )
    capped = F.when(gap > MAX_DAYS_SINCE_PRIOR, F.lit(MAX_DAYS_SINCE_PRIOR)).otherwise(gap)
    return j.select(
        "order_id",
        "user_id",
        F.lit("prior").alias("eval_set"),
        "order_number",
        (F.dayofweek("_day") - 1).cast("int").alias("order_dow"),
        F.hour("_ts").cast("int").alias("order_hour_of_day"),
        capped.cast("double").alias("days_since_prior_order"),
    )


def order_products_role(lineitem: DataFrame, linestatus: str) -> DataFrame:
    """lineitem split by status -> (order_id, product_id, add_to_cart_order, reordered)."""
    return lineitem.where(F.col("l_linestatus") == linestatus).select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_linenumber").alias("add_to_cart_order"),
        (F.col("l_returnflag") == REORDERED_RETURNFLAG).cast("int").alias("reordered"),
    )


def _catalog(part: DataFrame, source: str, id_col: str, name_col: str) -> DataFrame:
    """Distinct values of a part attribute with dense ids (a small catalog:
    the window runs over the distinct values only)."""
    values = part.select(F.col(source).alias(name_col)).distinct()
    return values.select(
        F.dense_rank().over(Window.orderBy(name_col)).cast("int").alias(id_col), name_col
    )


def aisles_role(part: DataFrame) -> DataFrame:
    return _catalog(part, "p_brand", "aisle_id", "aisle")


def departments_role(part: DataFrame) -> DataFrame:
    return _catalog(part, "p_type", "department_id", "department")


def products_role(part: DataFrame, aisles: DataFrame, departments: DataFrame) -> DataFrame:
    return (
        part.join(aisles, part["p_brand"] == aisles["aisle"])
        .join(departments, part["p_type"] == departments["department"])
        .select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("product_name"),
            "aisle_id",
            "department_id",
        )
    )


def branches_role(region: DataFrame) -> DataFrame:
    """region -> branch seed, ASIA being the DEFAULT_BRANCH member."""
    nk = F.when(F.col("r_name") == DEFAULT_BRANCH_REGION, F.lit(DEFAULT_BRANCH_ID)).otherwise(
        F.concat(F.lit("BR-"), F.col("r_name"))
    )
    return region.select(
        nk.alias("branch_id_nk"),
        F.col("r_name").alias("branch_name"),
        F.col("r_name").alias("city"),
        F.col("r_name").alias("region"),
    )


def etl_log_role(events: DataFrame) -> DataFrame:
    """events -> run log rows (one per event)."""
    failed = F.col("event_type") == FAILED_EVENT_TYPE
    return events.select(
        F.col("event_id").cast("string").alias("run_id"),
        F.col("event_type").alias("stage"),
        F.when(F.col("event_type") == UNSTARTED_EVENT_TYPE, F.lit(None))
        .otherwise(F.col("ts"))
        .cast("timestamp_ntz")
        .alias("started_at"),
        F.when(F.col("event_type") == UNFINISHED_EVENT_TYPE, F.lit(None))
        .otherwise(F.col("ts"))
        .cast("timestamp_ntz")
        .alias("finished_at"),
        F.when(failed, F.lit("FAILED")).otherwise(F.lit("SUCCESS")).alias("status"),
        F.floor("value").cast("long").alias("rows_loaded"),
        F.col("event_id").cast("long").alias("watermark_order_id"),
        F.when(failed, F.col("props")).otherwise(F.lit("OK")).alias("message"),
    )


def raw_sources(spark: SparkSession, sf_dir: str) -> RawSources:
    part = read_table(spark, sf_dir, "part")
    lineitem = read_table(spark, sf_dir, "lineitem")
    aisles = aisles_role(part)
    departments = departments_role(part)
    return RawSources(
        orders=orders_role(read_table(spark, sf_dir, "orders")),
        order_products_prior=order_products_role(lineitem, PRIOR_LINESTATUS),
        order_products_train=order_products_role(lineitem, TRAIN_LINESTATUS),
        products=products_role(part, aisles, departments),
        aisles=aisles,
        departments=departments,
        branches=branches_role(read_table(spark, sf_dir, "region")),
    )


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return etl_log_role(read_table(spark, sf_dir, "events"))
