"""Gold layer: the star schema.

Joins are written as plain equi-joins; Catalyst picks the strategy.  When
the dimensions come from written tables their real file size is known and
``spark.sql.autoBroadcastJoinThreshold`` broadcasts them only if small --
the size check with sort-merge as the way beyond it.  Only the branch seed
(a hand-maintained seed file) is hinted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.dates import day_name, is_weekend
from tillroll.functions.keys import composite_key, surrogate_key
from tillroll.schemas import DEFAULT_BRANCH_ID

# Membership tier thresholds on total orders, and the
# product-name pattern that marks an organic product.
PLATINUM_MIN_ORDERS = 40
GOLD_MIN_ORDERS = 15
ORGANIC_PATTERN = "organic"


def dim_date(stg_orders: DataFrame) -> DataFrame:
    """One row per date that occurs."""
    d = F.col("full_date")
    return (
        stg_orders.select(F.col("synthetic_order_date").alias("full_date"))
        .distinct()
        .select(
            surrogate_key(d.cast("string")).alias("date_key"),
            d,
            F.dayofmonth(d).alias("day_of_month"),
            F.month(d).alias("month"),
            F.quarter(d).alias("quarter"),
            F.year(d).alias("year"),
            day_name(d).alias("day_of_week"),
            is_weekend(d).alias("is_weekend"),
        )
    )


def dim_product(
    stg_products: DataFrame,
    aisles: DataFrame,
    departments: DataFrame,
    organic_pattern: str = ORGANIC_PATTERN,
) -> DataFrame:
    """Products with known aisle and department (inner joins)."""
    a = aisles.select(F.col("aisle_id").cast("int").alias("_aisle_id"), F.col("aisle").alias("aisle_name"))
    d = departments.select(
        F.col("department_id").cast("int").alias("_department_id"),
        F.col("department").alias("department_name"),
    )
    p = stg_products.join(a, F.col("aisle_id") == F.col("_aisle_id")).join(
        d, F.col("department_id") == F.col("_department_id")
    )
    return p.select(
        surrogate_key(F.col("product_id").cast("string")).alias("product_key"),
        F.col("product_id").cast("string").alias("product_id_nk"),
        "product_name",
        "aisle_name",
        "department_name",
        F.lower("product_name").rlike(organic_pattern).alias("is_organic"),
    )


def membership_tier(
    total_orders: str = "total_orders",
    platinum_min: int = PLATINUM_MIN_ORDERS,
    gold_min: int = GOLD_MIN_ORDERS,
):
    n = F.col(total_orders)
    return (
        F.when(n >= platinum_min, F.lit("Platinum"))
        .when(n >= gold_min, F.lit("Gold"))
        .otherwise(F.lit("Silver"))
    )


def dim_customer(
    stg_users: DataFrame,
    platinum_min: int = PLATINUM_MIN_ORDERS,
    gold_min: int = GOLD_MIN_ORDERS,
) -> DataFrame:
    """One row per user with a tier."""
    nk = F.col("user_id").cast("string")
    return stg_users.select(
        surrogate_key(nk).alias("customer_key"),
        nk.alias("user_id_nk"),
        membership_tier("total_orders", platinum_min, gold_min).alias("membership_tier"),
        "total_orders",
    )


def dim_branch(branch_seed: DataFrame) -> DataFrame:
    """Seed rows plus key."""
    return branch_seed.select(
        surrogate_key("branch_id_nk").alias("branch_key"),
        "branch_id_nk",
        "branch_name",
        "city",
        "region",
    )


def fact_order_line(
    stg_order_products: DataFrame,
    stg_orders: DataFrame,
    dim_date: DataFrame | None,
    dim_product: DataFrame,
    dim_customer: DataFrame | None,
    dim_branch: DataFrame,
    branch_id: str = DEFAULT_BRANCH_ID,
    derived_dims: bool = False,
) -> DataFrame:
    """One row per staged line that finds its order, date, product,
    customer and the default branch (any miss drops the line).

    The order-level keys (date, customer) are attached to the orders first
    -- a quarter of the line count -- so the line table is shuffled once, on
    order id.  With ``derived_dims=True`` (the warehouse build, where
    ``dim_date`` and ``dim_customer`` are built from these same staged
    orders and so hold exactly one row per order date / user) those two
    keys are computed from the natural keys instead of joined: the same
    rows, without a join against a user-sized dimension.
    """
    orders = stg_orders.select(
        F.col("order_id").alias("_o_id"),
        F.col("user_id").cast("string").alias("_user_nk"),
        F.col("synthetic_order_date").alias("_o_date"),
    )
    if derived_dims:
        enriched = orders.where(F.col("_o_date").isNotNull() & F.col("_user_nk").isNotNull()).select(
            "_o_id",
            surrogate_key(F.col("_o_date").cast("string")).alias("date_key"),
            surrogate_key("_user_nk").alias("customer_key"),
        )
    else:
        if dim_date is None or dim_customer is None:
            raise ValueError("dim_date and dim_customer are required unless derived_dims=True")
        dates = dim_date.select(F.col("full_date").alias("_o_date"), "date_key")
        customers = dim_customer.select(F.col("user_id_nk").alias("_user_nk"), "customer_key")
        enriched = orders.join(dates, "_o_date").join(customers, "_user_nk").select(
            "_o_id", "date_key", "customer_key"
        )
    products = dim_product.select(F.col("product_id_nk").alias("_p_nk"), "product_key")
    # Every line belongs to the constant branch member: the keys of the seed
    # rows with that natural key (one, per Q10) come from a scalar subquery
    # and are exploded onto each line -- k members give k copies and none
    # gives no lines, exactly like the inner join, without a join.
    branch_keys = (
        dim_branch.where(F.col("branch_id_nk") == branch_id)
        .agg(F.collect_list("branch_key"))
        .scalar()
    )
    # The text of the product id is made after the shuffle on order id.
    lines = (
        stg_order_products.join(enriched, F.col("order_id") == F.col("_o_id"))
        .withColumn("_p_nk", F.col("product_id").cast("string"))
        .join(products, "_p_nk")
    )
    return lines.select(
        composite_key("order_id", "product_id", "add_to_cart_order").alias("order_line_key"),
        F.col("order_id").cast("string").alias("order_id_nk"),
        "date_key",
        "product_key",
        "customer_key",
        F.explode(branch_keys).alias("branch_key"),
        F.col("add_to_cart_order").cast("int").alias("add_to_cart_order"),
        F.col("reordered").cast("boolean").alias("reordered"),
        F.lit(1).alias("quantity"),
    )


def fact_order_summary(fact_order_line: DataFrame, stg_orders: DataFrame) -> DataFrame:
    """One row per order of the line fact.

    Lines are aggregated per order before the join, and staged orders are
    pre-aggregated to (copies, max gap) per id: joining k copies of an order
    multiplies its summed quantity by k and leaves min/max/distinct alone,
    so the result equals join-then-group without fanning lines out.
    """
    per_order = fact_order_line.groupBy("order_id_nk").agg(
        F.min("date_key").alias("date_key"),
        F.min("customer_key").alias("customer_key"),
        F.min("branch_key").alias("branch_key"),
        F.sum("quantity").alias("_qty"),
        F.countDistinct("product_key").alias("total_distinct_items"),
    )
    staged = stg_orders.groupBy(F.col("order_id").cast("string").alias("order_id_nk")).agg(
        F.count(F.lit(1)).alias("_copies"),
        F.max("days_since_prior_order").alias("days_since_prior"),
    )
    return per_order.join(staged, "order_id_nk").select(
        surrogate_key("order_id_nk").alias("order_summary_key"),
        "order_id_nk",
        "date_key",
        "customer_key",
        "branch_key",
        (F.col("_qty") * F.col("_copies")).cast("long").alias("total_items"),
        "total_distinct_items",
        F.col("days_since_prior").cast("int").alias("days_since_prior"),
    )
