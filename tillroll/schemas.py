"""Explicit schemas and the column contract of every layer.

Bronze sources are read with these schemas (no inference).  The contract
dictionaries are what the quality checks (Q8/Q9) compare against.
"""

from __future__ import annotations

from pyspark.sql import types as T

BRONZE_ORDERS = T.StructType(
    [
        T.StructField("order_id", T.LongType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("eval_set", T.StringType()),
        T.StructField("order_number", T.IntegerType()),
        T.StructField("order_dow", T.IntegerType()),
        T.StructField("order_hour_of_day", T.IntegerType()),
        T.StructField("days_since_prior_order", T.DoubleType()),
    ]
)

BRONZE_ORDER_PRODUCTS = T.StructType(
    [
        T.StructField("order_id", T.LongType()),
        T.StructField("product_id", T.LongType()),
        T.StructField("add_to_cart_order", T.IntegerType()),
        T.StructField("reordered", T.IntegerType()),
    ]
)

BRONZE_PRODUCTS = T.StructType(
    [
        T.StructField("product_id", T.LongType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("aisle_id", T.IntegerType()),
        T.StructField("department_id", T.IntegerType()),
    ]
)

BRONZE_AISLES = T.StructType(
    [T.StructField("aisle_id", T.IntegerType()), T.StructField("aisle", T.StringType())]
)

BRONZE_DEPARTMENTS = T.StructType(
    [T.StructField("department_id", T.IntegerType()), T.StructField("department", T.StringType())]
)

BRANCH_SEED = T.StructType(
    [
        T.StructField("branch_id_nk", T.StringType()),
        T.StructField("branch_name", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("region", T.StringType()),
    ]
)

ETL_LOG = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("stage", T.StringType()),
        T.StructField("started_at", T.TimestampNTZType()),
        T.StructField("finished_at", T.TimestampNTZType()),
        T.StructField("status", T.StringType()),
        T.StructField("rows_loaded", T.LongType()),
        T.StructField("watermark_order_id", T.LongType()),
        T.StructField("message", T.StringType()),
    ]
)

RULES = T.StructType(
    [
        T.StructField("antecedents", T.StringType()),
        T.StructField("consequents", T.StringType()),
        T.StructField("rule_text", T.StringType()),
        T.StructField("business_meaning", T.StringType()),
        T.StructField("support", T.DoubleType()),
        T.StructField("confidence", T.DoubleType()),
        T.StructField("lift", T.DoubleType()),
        T.StructField("antecedent_support", T.DoubleType()),
        T.StructField("consequent_support", T.DoubleType()),
    ]
)

BUNDLES = T.StructType(
    [
        T.StructField("bundle_products", T.StringType()),
        T.StructField("recommended_product", T.StringType()),
        T.StructField("support", T.DoubleType()),
        T.StructField("confidence", T.DoubleType()),
        T.StructField("lift", T.DoubleType()),
        T.StructField("recommendation", T.StringType()),
    ]
)

# Raw source names and the column contract of each layer.
BRONZE_TABLES = {
    "bronze_orders": BRONZE_ORDERS,
    "bronze_order_products_prior": BRONZE_ORDER_PRODUCTS,
    "bronze_order_products_train": BRONZE_ORDER_PRODUCTS,
    "bronze_products": BRONZE_PRODUCTS,
    "bronze_aisles": BRONZE_AISLES,
    "bronze_departments": BRONZE_DEPARTMENTS,
}

GOLD_CONTRACT = {
    "dim_date": [
        "date_key", "full_date", "day_of_month", "month", "quarter", "year",
        "day_of_week", "is_weekend",
    ],
    "dim_product": [
        "product_key", "product_id_nk", "product_name", "aisle_name",
        "department_name", "is_organic",
    ],
    "dim_customer": ["customer_key", "user_id_nk", "membership_tier", "total_orders"],
    "dim_branch": ["branch_key", "branch_id_nk", "branch_name", "city", "region"],
    "fact_order_line": [
        "order_line_key", "order_id_nk", "date_key", "product_key", "customer_key",
        "branch_key", "add_to_cart_order", "reordered", "quantity",
    ],
    "fact_order_summary": [
        "order_summary_key", "order_id_nk", "date_key", "customer_key", "branch_key",
        "total_items", "total_distinct_items", "days_since_prior",
    ],
}

SILVER_CONTRACT = {
    "stg_orders": [
        "order_id", "user_id", "order_number", "order_dow", "order_hour_of_day",
        "days_since_prior_order", "synthetic_order_date",
    ],
    "stg_order_products": ["order_id", "product_id", "add_to_cart_order", "reordered"],
    "stg_products": ["product_id", "product_name", "aisle_id", "department_id"],
    "stg_users": ["user_id", "total_orders"],
}

# Fixed value: natural key of the branch every order line is attributed to.
DEFAULT_BRANCH_ID = "DEFAULT_BRANCH"
