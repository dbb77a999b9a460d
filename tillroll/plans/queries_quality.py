"""Registered data-quality queries (Q rows of §2)."""

from __future__ import annotations

from tillroll.operators import quality as q
from tillroll.plans.etl import recomputed_dates
from tillroll.plans.oracle import with_warehouse
from tillroll.plans.registry import register, warehouse
from tillroll.plans.queries_sources import _target, _watermark
from tillroll.sources import incremental as inc

@register(
    "q1_unique_line_grain",
    with_warehouse(
        """
SELECT order_id_nk, product_key, add_to_cart_order, count(*) AS copies FROM fact_order_line
GROUP BY order_id_nk, product_key, add_to_cart_order HAVING count(*) > 1"""
    ),
)
def q1(spark, sf):
    return q.duplicate_grain(
        warehouse(spark, sf).gold.fact_order_line, ["order_id_nk", "product_key", "add_to_cart_order"]
    )


@register(
    "q2_unique_summary_grain",
    with_warehouse(
        "SELECT order_id_nk, count(*) AS copies FROM fact_order_summary GROUP BY order_id_nk HAVING count(*) > 1"
    ),
)
def q2(spark, sf):
    return q.duplicate_grain(warehouse(spark, sf).gold.fact_order_summary, ["order_id_nk"])


def _fk_sql(pairs) -> str:
    parts = [
        f"SELECT '{name}' AS fk, count(*) AS orphan_rows FROM fact_order_line f "
        f"WHERE NOT EXISTS (SELECT 1 FROM {dim} d WHERE d.{key} = f.{key})"
        for name, dim, key in pairs
    ]
    return with_warehouse("\nUNION ALL ".join(parts))


@register(
    "q3_fk_product_customer",
    _fk_sql([("product", "dim_product", "product_key"), ("customer", "dim_customer", "customer_key")]),
)
def q3(spark, sf):
    g = warehouse(spark, sf).gold
    return q.fk_orphans(
        g.fact_order_line,
        {"product": (g.dim_product, "product_key"), "customer": (g.dim_customer, "customer_key")},
    )


@register(
    "q4_fk_date_branch",
    _fk_sql([("date", "dim_date", "date_key"), ("branch", "dim_branch", "branch_key")]),
)
def q4(spark, sf):
    g = warehouse(spark, sf).gold
    return q.fk_orphans(
        g.fact_order_line, {"date": (g.dim_date, "date_key"), "branch": (g.dim_branch, "branch_key")}
    )


# Dimensions that have lost members, so that every kind of orphan is there.
_KEPT = {
    "product": ("dim_product", "product_key", "department_name NOT LIKE 'S%'"),
    "customer": ("dim_customer", "customer_key", "customer_key % 5 <> 0"),
    "date": ("dim_date", "date_key", "is_weekend = false"),
    "branch": ("dim_branch", "branch_key", "branch_id_nk <> 'DEFAULT_BRANCH'"),
}


@register(
    "q3_q4_fk_lost_members",
    _fk_sql([(name, f"(SELECT * FROM {dim} WHERE {kept})", key) for name, (dim, key, kept) in _KEPT.items()]),
)
def q3_q4_lost(spark, sf):
    g = warehouse(spark, sf).gold
    return q.fk_orphans(g.fact_order_line, {name: (getattr(g, dim).where(kept), key) for name, (dim, key, kept) in _KEPT.items()})


@register(
    "q5_row_count_match",
    with_warehouse(
        """
SELECT (SELECT count(*) FROM fact_order_line) AS fact_rows, (SELECT count(*) FROM stg_order_products) AS staged_rows,
       (SELECT count(*) FROM fact_order_line) = (SELECT count(*) FROM stg_order_products) AS matches"""
    ),
)
def q5(spark, sf):
    w = warehouse(spark, sf)
    return q.row_count_match(w.gold.fact_order_line, w.silver.stg_order_products)


@register(
    "q6_non_null_date",
    with_warehouse(
        "SELECT count(*) FILTER (WHERE synthetic_order_date IS NULL) AS null_synthetic_order_date FROM stg_orders"
    ),
)
def q6(spark, sf):
    return q.null_count(warehouse(spark, sf).silver.stg_orders, "synthetic_order_date")


@register(
    "q7_recompute_date",
    with_warehouse(
        """
SELECT count(*) AS checked_rows,
       count(*) FILTER (WHERE s.synthetic_order_date IS DISTINCT FROM e.expected_date) AS mismatches
FROM stg_orders s JOIN (
  SELECT CAST(order_id AS BIGINT) AS order_id,
         DATE '2024-01-01' + CAST(sum(coalesce(CAST(days_since_prior_order AS INTEGER), 0)) OVER (
             PARTITION BY CAST(user_id AS BIGINT) ORDER BY CAST(order_number AS INTEGER)) AS INTEGER) AS expected_date
  FROM b_orders) e ON e.order_id = s.order_id"""
    ),
)
def q7(spark, sf):
    w = warehouse(spark, sf)
    expected = recomputed_dates(w.raw.orders)
    return q.recompute_mismatches(w.silver.stg_orders, expected, "order_id", "synthetic_order_date")


@register(
    "q10_default_branch",
    with_warehouse(
        """
SELECT count(*) FILTER (WHERE branch_id_nk = 'DEFAULT_BRANCH') AS default_branch_rows,
       count(*) FILTER (WHERE branch_id_nk = 'DEFAULT_BRANCH') = 1 AS ok
FROM dim_branch"""
    ),
)
def q10(spark, sf):
    return q.default_member(warehouse(spark, sf).gold.dim_branch)


@register(
    "q11_idempotent_rerun",
    with_warehouse(
        f"""
SELECT (SELECT count(*) FROM b_new) AS first_run_rows, CAST(0 AS BIGINT) AS second_run_rows,
       (SELECT count(*) FROM b_orders s
        WHERE CAST(s.order_id AS BIGINT) > (SELECT coalesce(max(watermark_order_id), 0) FROM etl_log WHERE status = 'SUCCESS')
          AND NOT EXISTS (SELECT 1 FROM (SELECT * FROM b_target UNION ALL SELECT * FROM b_new) t
                          WHERE CAST(t.order_id AS BIGINT) = CAST(s.order_id AS BIGINT))) = 0 AS idempotent""",
        """b_target AS (SELECT * FROM b_orders WHERE order_dow IN (1, 2, 3, 4, 5)),
b_new AS (
  SELECT s.* FROM b_orders s
  WHERE CAST(s.order_id AS BIGINT) > (SELECT coalesce(max(watermark_order_id), 0) FROM etl_log WHERE status = 'SUCCESS')
    AND NOT EXISTS (SELECT 1 FROM b_target t WHERE CAST(t.order_id AS BIGINT) = CAST(s.order_id AS BIGINT))
)""",
    ),
)
def q11(spark, sf):
    w = warehouse(spark, sf)
    target, wm = _target(w), _watermark(w)
    first = inc.incremental_rows(w.raw.orders, target, wm)
    second = inc.incremental_rows(w.raw.orders, target.unionByName(first), wm)
    return q.rerun_is_idempotent(first, second)


@register(
    "q12_key_overlap",
    with_warehouse(
        "SELECT count(DISTINCT o.order_id) AS orders_with_lines FROM stg_orders o "
        "WHERE EXISTS (SELECT 1 FROM stg_order_products l WHERE l.order_id = o.order_id)"
    ),
)
def q12(spark, sf):
    s = warehouse(spark, sf).silver
    return q.key_overlap(s.stg_orders, s.stg_order_products)


@register(
    "q13_reconciliation",
    with_warehouse(
        """
SELECT (SELECT count(*) FROM fact_order_summary) AS summary_rows,
       (SELECT count(DISTINCT order_id_nk) FROM fact_order_line) AS fact_orders,
       (SELECT count(*) FROM fact_order_summary) = (SELECT count(DISTINCT order_id_nk) FROM fact_order_line) AS summary_matches,
       (SELECT count(*) FROM b_orders) + (SELECT count(*) FROM stg_order_products) + (SELECT count(*) FROM fact_order_line) AS rows_loaded"""
    ),
)
def q13(spark, sf):
    w = warehouse(spark, sf)
    return q.reconciliation(
        w.gold.fact_order_summary, w.gold.fact_order_line, w.silver.stg_order_products, w.raw.orders
    )


_LAYERS_SQL = [
    ("bronze", "bronze_orders", "b_orders"),
    ("bronze", "bronze_order_products_prior", "b_prior"),
    ("bronze", "bronze_order_products_train", "b_train"),
    ("bronze", "bronze_products", "b_products"),
    ("bronze", "bronze_aisles", "b_aisles"),
    ("bronze", "bronze_departments", "b_departments"),
    ("silver", "stg_orders", "stg_orders"),
    ("silver", "stg_order_products", "stg_order_products"),
    ("silver", "stg_products", "stg_products"),
    ("silver", "stg_users", "stg_users"),
    ("gold", "dim_date", "dim_date"),
    ("gold", "dim_product", "dim_product"),
    ("gold", "dim_customer", "dim_customer"),
    ("gold", "dim_branch", "dim_branch"),
    ("gold", "fact_order_line", "fact_order_line"),
    ("gold", "fact_order_summary", "fact_order_summary"),
]


@register(
    "q14_control_totals",
    with_warehouse(
        "\nUNION ALL ".join(
            f"SELECT '{layer}' AS layer, '{name}' AS table_name, count(*) AS row_count FROM {cte}"
            for layer, name, cte in _LAYERS_SQL
        )
    ),
)
def q14(spark, sf):
    w = warehouse(spark, sf)
    r, s, g = w.raw, w.silver, w.gold
    return q.control_totals(
        {
            "bronze": {
                "bronze_orders": r.orders,
                "bronze_order_products_prior": r.order_products_prior,
                "bronze_order_products_train": r.order_products_train,
                "bronze_products": r.products,
                "bronze_aisles": r.aisles,
                "bronze_departments": r.departments,
            },
            "silver": {
                "stg_orders": s.stg_orders,
                "stg_order_products": s.stg_order_products,
                "stg_products": s.stg_products,
                "stg_users": s.stg_users,
            },
            "gold": {
                "dim_date": g.dim_date,
                "dim_product": g.dim_product,
                "dim_customer": g.dim_customer,
                "dim_branch": g.dim_branch,
                "fact_order_line": g.fact_order_line,
                "fact_order_summary": g.fact_order_summary,
            },
        }
    )


@register(
    "q15_distribution_profile",
    with_warehouse(
        """
SELECT 'distinct_orders' AS metric, 'all' AS label, count(DISTINCT order_id_nk) AS value FROM fact_order_line
UNION ALL SELECT 'distinct_products', 'all', count(DISTINCT product_key) FROM fact_order_line
UNION ALL SELECT 'reordered_true', 'all', count(*) FILTER (WHERE reordered) FROM fact_order_line
UNION ALL SELECT 'reordered_false', 'all', count(*) FILTER (WHERE NOT reordered) FROM fact_order_line
UNION ALL SELECT 'customers_per_tier', t.label, coalesce(c.n, 0)
FROM (VALUES ('Platinum'), ('Gold'), ('Silver')) t(label)
LEFT JOIN (SELECT membership_tier, count(*) AS n FROM dim_customer GROUP BY 1) c ON c.membership_tier = t.label"""
    ),
)
def q15(spark, sf):
    g = warehouse(spark, sf).gold
    return q.distribution_profile(g.fact_order_line, g.dim_customer)


@register(
    "q16_value_ranges",
    with_warehouse(
        """
SELECT (SELECT min(full_date) FROM dim_date) AS min_date, (SELECT max(full_date) FROM dim_date) AS max_date,
       min(days_since_prior) AS min_days_since_prior, max(days_since_prior) AS max_days_since_prior,
       min(total_items) AS min_total_items, max(total_items) AS max_total_items
FROM fact_order_summary"""
    ),
)
def q16(spark, sf):
    g = warehouse(spark, sf).gold
    return q.value_ranges(g.dim_date, g.fact_order_summary)


@register(
    "q17_successful_run",
    with_warehouse(
        "SELECT count(*) FILTER (WHERE status = 'SUCCESS') AS success_runs, "
        "count(*) FILTER (WHERE status = 'SUCCESS') >= 1 AS ok FROM etl_log"
    ),
)
def q17(spark, sf):
    return q.successful_run_exists(warehouse(spark, sf).log)
