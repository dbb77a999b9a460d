"""Registered Silver, Gold and dashboard queries (T, G, A rows of §2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillroll.functions.dates import DOW_ORDER
from tillroll.operators import gold as gold_ops
from tillroll.operators import marts, silver
from tillroll.plans.oracle import with_warehouse
from tillroll.plans.registry import register, warehouse

# The non-empty A1 selection used by the "_filtered" variants.
SAMPLE_FILTER = marts.Filters(
    branches=("ASIA",),
    dows=("Monday", "Saturday", "Sunday"),
    departments=("ECONOMY", "PROMO", "SMALL"),
)
SCALED_PLATINUM, SCALED_GOLD = 20, 10


def _in(col: str, values) -> str:
    return f"{col} IN (" + ", ".join(f"'{v}'" for v in values) + ")"


SAMPLE_WHERE = "WHERE " + " AND ".join(
    [
        _in("branch_name", SAMPLE_FILTER.branches),
        _in("day_of_week", SAMPLE_FILTER.dows),
        _in("department_name", SAMPLE_FILTER.departments),
    ]
)
WEEKDAYS_SQL = "(VALUES " + ", ".join(f"('{d}', {i + 1})" for i, d in enumerate(DOW_ORDER)) + ") AS w(day_of_week, day_index)"


# ---- Silver -------------------------------------------------------------

@register("t1_typed_orders", with_warehouse("SELECT * FROM s_gaps"))
def t1(spark, sf):
    return silver.typed_orders(warehouse(spark, sf).raw.orders)


@register("t2_synthetic_date", with_warehouse("SELECT * FROM stg_orders"))
def t2(spark, sf):
    return warehouse(spark, sf).silver.stg_orders


@register("t3_union_dedup", with_warehouse("SELECT * FROM stg_order_products"))
def t3(spark, sf):
    return warehouse(spark, sf).silver.stg_order_products


@register("t4_trim_products", with_warehouse("SELECT * FROM stg_products"))
def t4(spark, sf):
    return warehouse(spark, sf).silver.stg_products


@register("t5_orders_per_user", with_warehouse("SELECT * FROM stg_users"))
def t5(spark, sf):
    return warehouse(spark, sf).silver.stg_users


# ---- Gold ---------------------------------------------------------------

@register(
    "g1_surrogate_key",
    with_warehouse(
        """
SELECT 'date' AS dimension, CAST(full_date AS VARCHAR) AS natural_key, date_key AS surrogate_key FROM dim_date
UNION ALL SELECT 'product', product_id_nk, product_key FROM dim_product
UNION ALL SELECT 'customer', user_id_nk, customer_key FROM dim_customer
UNION ALL SELECT 'branch', branch_id_nk, branch_key FROM dim_branch
"""
    ),
)
def g1(spark, sf):
    g = warehouse(spark, sf).gold

    def keys(df, name, nk, key):
        return df.select(
            F.lit(name).alias("dimension"),
            F.col(nk).cast("string").alias("natural_key"),
            F.col(key).alias("surrogate_key"),
        )

    return (
        keys(g.dim_date, "date", "full_date", "date_key")
        .unionByName(keys(g.dim_product, "product", "product_id_nk", "product_key"))
        .unionByName(keys(g.dim_customer, "customer", "user_id_nk", "customer_key"))
        .unionByName(keys(g.dim_branch, "branch", "branch_id_nk", "branch_key"))
    )


@register(
    "g2_line_key",
    with_warehouse("SELECT order_line_key, order_id_nk, product_key, add_to_cart_order FROM fact_order_line"),
)
def g2(spark, sf):
    return warehouse(spark, sf).gold.fact_order_line.select(
        "order_line_key", "order_id_nk", "product_key", "add_to_cart_order"
    )


@register("g3_dim_date", with_warehouse("SELECT * FROM dim_date"))
def g3(spark, sf):
    return warehouse(spark, sf).gold.dim_date


@register("g4_dim_product", with_warehouse("SELECT * FROM dim_product"))
def g4(spark, sf):
    return warehouse(spark, sf).gold.dim_product


@register("g5_dim_customer", with_warehouse("SELECT * FROM dim_customer"))
def g5(spark, sf):
    return warehouse(spark, sf).gold.dim_customer


@register(
    "g5_tier_scaled",
    with_warehouse("SELECT * FROM dim_customer", platinum_min=SCALED_PLATINUM, gold_min=SCALED_GOLD),
)
def g5_scaled(spark, sf):
    return gold_ops.dim_customer(warehouse(spark, sf).silver.stg_users, SCALED_PLATINUM, SCALED_GOLD)


@register("g6_dim_branch", with_warehouse("SELECT * FROM dim_branch"))
def g6(spark, sf):
    return warehouse(spark, sf).gold.dim_branch


@register("g7_fact_order_line", with_warehouse("SELECT * FROM fact_order_line"))
def g7(spark, sf):
    return warehouse(spark, sf).gold.fact_order_line


@register("g7_fact_order_line_joined", with_warehouse("SELECT * FROM fact_order_line"))
def g7_joined(spark, sf):
    """The fact through its joins with all four dimensions."""
    w = warehouse(spark, sf)
    return gold_ops.fact_order_line(
        w.silver.stg_order_products, w.silver.stg_orders, w.gold.dim_date, w.gold.dim_product, w.gold.dim_customer, w.gold.dim_branch
    )


@register("g8_fact_order_summary", with_warehouse("SELECT * FROM fact_order_summary"))
def g8(spark, sf):
    return warehouse(spark, sf).gold.fact_order_summary


# ---- Dashboard marts ----------------------------------------------------

@register("a1_filtered_star", with_warehouse(f"SELECT * FROM star {SAMPLE_WHERE}"))
def a1(spark, sf):
    return marts.filtered_star(warehouse(spark, sf).star, SAMPLE_FILTER)


def _kpi_sql(where: str) -> str:
    return with_warehouse(
        f"""
SELECT count(DISTINCT order_id_nk) AS orders, count(*) AS order_lines,
       count(DISTINCT product_key) AS products, count(DISTINCT customer_key) AS customers,
       round(coalesce(avg(CASE WHEN reordered THEN 1.0 ELSE 0.0 END), 0.0), 6) AS reorder_rate,
       CAST(sum(quantity) AS BIGINT) AS total_items
FROM star {where}"""
    )


@register("a2_kpis", _kpi_sql(""))
def a2(spark, sf):
    return marts.kpis(warehouse(spark, sf).star)


@register("a2_kpis_filtered", _kpi_sql(SAMPLE_WHERE))
def a2f(spark, sf):
    return marts.kpis(warehouse(spark, sf).star, SAMPLE_FILTER)


def _weekday_sql(where: str) -> str:
    return with_warehouse(
        f"""
SELECT w.day_of_week, CAST(coalesce(c.orders, 0) AS BIGINT) AS orders
FROM {WEEKDAYS_SQL}
LEFT JOIN (SELECT day_of_week, count(DISTINCT order_id_nk) AS orders FROM star {where} GROUP BY day_of_week) c
  ON c.day_of_week = w.day_of_week
ORDER BY w.day_index"""
    )


@register("a3_orders_by_weekday", _weekday_sql(""))
def a3(spark, sf):
    return marts.orders_by_weekday(warehouse(spark, sf).star)


@register("a3_orders_by_weekday_filtered", _weekday_sql(SAMPLE_WHERE))
def a3f(spark, sf):
    return marts.orders_by_weekday(warehouse(spark, sf).star, SAMPLE_FILTER)


def _top_dept_sql(where: str) -> str:
    return with_warehouse(
        f"""
SELECT department_name, count(*) AS lines FROM star {where}
GROUP BY department_name ORDER BY lines DESC, department_name ASC NULLS LAST LIMIT 10"""
    )


@register("a4_top_departments", _top_dept_sql(""))
def a4(spark, sf):
    return marts.top_departments(warehouse(spark, sf).star)


@register("a4_top_departments_filtered", _top_dept_sql(SAMPLE_WHERE))
def a4f(spark, sf):
    return marts.top_departments(warehouse(spark, sf).star, SAMPLE_FILTER)


def _daily_sql(where: str) -> str:
    return with_warehouse(
        f"""
SELECT full_date, CAST(sum(quantity) AS BIGINT) AS items, count(DISTINCT order_id_nk) AS orders
FROM star {where} GROUP BY full_date ORDER BY full_date"""
    )


@register("a5_daily_trend", _daily_sql(""))
def a5(spark, sf):
    return marts.daily_trend(warehouse(spark, sf).star)


@register("a5_daily_trend_filtered", _daily_sql(SAMPLE_WHERE))
def a5f(spark, sf):
    return marts.daily_trend(warehouse(spark, sf).star, SAMPLE_FILTER)


def _heatmap_sql(where: str) -> str:
    cols = ", ".join(
        f"count(*) FILTER (WHERE day_of_week = '{d}') AS \"{d}\"" for d in DOW_ORDER
    )
    return with_warehouse(
        f"""
SELECT department_name, {cols} FROM star {where}
GROUP BY department_name ORDER BY count(*) DESC, department_name ASC NULLS LAST"""
    )


@register("a6_heatmap", _heatmap_sql(""))
def a6(spark, sf):
    return marts.department_weekday_heatmap(warehouse(spark, sf).star)


@register("a6_heatmap_filtered", _heatmap_sql(SAMPLE_WHERE))
def a6f(spark, sf):
    return marts.department_weekday_heatmap(warehouse(spark, sf).star, SAMPLE_FILTER)


def _top_products_sql(where: str, n: int = 20, pct: bool = False) -> str:
    extra = ", round(round(avg(CASE WHEN reordered THEN 1.0 ELSE 0.0 END), 6) * 100, 1) AS reorder_rate_pct" if pct else ""
    return with_warehouse(
        f"""
SELECT product_name, aisle_name, department_name, count(*) AS lines,
       CAST(sum(quantity) AS BIGINT) AS quantity,
       round(avg(CASE WHEN reordered THEN 1.0 ELSE 0.0 END), 6) AS reorder_rate{extra}
FROM star {where}
GROUP BY product_name, aisle_name, department_name
ORDER BY quantity DESC, lines DESC, product_name ASC NULLS LAST, aisle_name ASC NULLS LAST,
         department_name ASC NULLS LAST
LIMIT {n}"""
    )


@register("a7_top_products", _top_products_sql(""))
def a7(spark, sf):
    return marts.top_products(warehouse(spark, sf).star)


@register("a7_top_products_filtered", _top_products_sql(SAMPLE_WHERE))
def a7f(spark, sf):
    return marts.top_products(warehouse(spark, sf).star, SAMPLE_FILTER)


@register("a8_reorder_pct", _top_products_sql("", pct=True))
def a8(spark, sf):
    return marts.reorder_rate_percent(marts.top_products(warehouse(spark, sf).star))


def _aisles_sql(where: str) -> str:
    return with_warehouse(
        f"""
SELECT aisle_name, count(*) AS lines, round(avg(CASE WHEN reordered THEN 1.0 ELSE 0.0 END), 6) AS reorder_rate
FROM star {where} GROUP BY aisle_name
ORDER BY reorder_rate DESC, lines DESC, aisle_name ASC NULLS LAST LIMIT 20"""
    )


@register("a9_aisles_by_reorder", _aisles_sql(""))
def a9(spark, sf):
    return marts.aisles_by_reorder_rate(warehouse(spark, sf).star)


@register("a9_aisles_by_reorder_filtered", _aisles_sql(SAMPLE_WHERE))
def a9f(spark, sf):
    return marts.aisles_by_reorder_rate(warehouse(spark, sf).star, SAMPLE_FILTER)


def _rollup_sql(where: str) -> str:
    return with_warehouse(
        f"""
SELECT department_name, aisle_name, count(*) AS lines,
       CAST(GROUPING(department_name, aisle_name) AS INTEGER) AS level
FROM star {where} GROUP BY ROLLUP (department_name, aisle_name)"""
    )


@register("a10_dept_aisle_rollup", _rollup_sql(""))
def a10(spark, sf):
    return marts.department_aisle_rollup(warehouse(spark, sf).star)


@register("a10_dept_aisle_rollup_filtered", _rollup_sql(SAMPLE_WHERE))
def a10f(spark, sf):
    return marts.department_aisle_rollup(warehouse(spark, sf).star, SAMPLE_FILTER)


@register(
    "a11_tier_distribution",
    with_warehouse(
        """
SELECT membership_tier, count(*) AS customers, round(avg(total_orders), 6) AS avg_orders,
       round(count(*) / sum(count(*)) OVER (), 6) AS share
FROM dim_customer GROUP BY membership_tier ORDER BY customers DESC, membership_tier"""
    ),
)
def a11(spark, sf):
    return marts.tier_distribution(warehouse(spark, sf).gold.dim_customer)


@register(
    "a12_total_orders_histogram",
    with_warehouse(
        """
SELECT bin, round(min(mn) + bin * min(w), 6) AS bin_start, round(min(mn) + (bin + 1) * min(w), 6) AS bin_end,
       count(*) AS customers
FROM (
  SELECT CAST(CASE WHEN mx = mn THEN 0
                   ELSE least(floor(CAST(total_orders - mn AS DOUBLE) / w), 19) END AS INTEGER) AS bin, mn, w
  FROM dim_customer,
       (SELECT min(total_orders) AS mn, max(total_orders) AS mx,
               CAST(max(total_orders) - min(total_orders) AS DOUBLE) / CAST(20 AS DOUBLE) AS w
        FROM dim_customer) mm
) GROUP BY bin ORDER BY bin"""
    ),
)
def a12(spark, sf):
    return marts.total_orders_histogram(warehouse(spark, sf).gold.dim_customer)


def _top_customers_sql(where: str) -> str:
    return with_warehouse(
        f"""
SELECT c.user_id_nk, c.membership_tier, count(DISTINCT s.order_id_nk) AS orders, count(*) AS lines,
       CAST(sum(s.quantity) AS BIGINT) AS quantity
FROM star s JOIN dim_customer c ON s.customer_key = c.customer_key {where}
GROUP BY c.user_id_nk, c.membership_tier
ORDER BY lines DESC, orders DESC, c.user_id_nk ASC NULLS LAST LIMIT 20"""
    )


@register("a13_top_customers", _top_customers_sql(""))
def a13(spark, sf):
    w = warehouse(spark, sf)
    return marts.top_customers(w.star, w.stored_gold.dim_customer)


@register("a13_top_customers_filtered", _top_customers_sql(SAMPLE_WHERE))
def a13f(spark, sf):
    w = warehouse(spark, sf)
    return marts.top_customers(w.star, w.stored_gold.dim_customer, SAMPLE_FILTER)


@register(
    "a14_headline_stats",
    with_warehouse(
        """
SELECT count(DISTINCT order_id_nk) AS orders, count(*) AS lines,
       count(DISTINCT customer_key) AS customers, count(DISTINCT product_key) AS products,
       (SELECT count(DISTINCT department_name) FROM dim_product) AS departments,
       strftime((SELECT max(finished_at) FROM etl_log WHERE status = 'SUCCESS'), '%Y-%m-%d %H:%M') AS last_success
FROM fact_order_line"""
    ),
)
def a14(spark, sf):
    w = warehouse(spark, sf)
    return marts.headline_stats(w.star.fact, w.star.product, w.log, w.star)


@register(
    "a15_filter_values",
    with_warehouse(
        f"""
SELECT filter_name, value FROM (
  SELECT DISTINCT 'branch' AS filter_name, branch_name AS value, 0 AS day_index FROM dim_branch
  UNION ALL
  SELECT 'day_of_week', d.day_of_week, w.day_index
  FROM (SELECT DISTINCT day_of_week FROM dim_date) d JOIN {WEEKDAYS_SQL} ON w.day_of_week = d.day_of_week
  UNION ALL
  SELECT DISTINCT 'department', department_name, 0 FROM dim_product
) ORDER BY filter_name, day_index, value"""
    ),
)
def a15(spark, sf):
    g = warehouse(spark, sf).gold
    return marts.filter_values(g.dim_branch, g.dim_date, g.dim_product)
