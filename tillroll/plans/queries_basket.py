"""Registered market-basket queries (M rows of §2).

On the test tables the basket items are the part brand (``aisle_name``, 25
values) and the part type (``department_name``, 6 values), per SURVEY §7.2;
the product name drives the summary.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tillroll.operators import baskets as bk
from tillroll.operators import rules
from tillroll.plans import oracle_mining as om
from tillroll.plans.etl import RULE_TABLE, WarehousePaths, _write, register_views
from tillroll.plans.oracle import with_warehouse
from tillroll.plans.registry import register, warehouse
from tillroll.session import ensure_checkpoint_dir

# Mining parameters of the registered queries.
BRAND, TYPE = "aisle_name", "department_name"
BRAND_SUPPORT, TYPE_SUPPORT = 0.005, 0.1
EXPLORER_MINS = dict(min_support=0.0052, min_confidence=0.12, min_lift=1.1)


def _items(spark, sf):
    g = warehouse(spark, sf).stored_gold
    return bk.order_items(g.fact_order_line, g.dim_product)


def _baskets(spark, sf, item_col):
    return bk.baskets(_items(spark, sf), item_col=item_col)


def _ranked(spark, sf, top_n=rules.DEFAULT_TOP_N):
    sets = rules.frequent_itemsets(_baskets(spark, sf, BRAND), BRAND_SUPPORT)
    return rules.rank_rules(rules.association_rules(sets), rules.DEFAULT_MIN_LIFT, top_n)


def _w(select_sql: str, ctes: str) -> str:
    return with_warehouse(select_sql, ctes)


@register(
    "m1_order_items",
    _w("SELECT * FROM m_lines", om.item_ctes(BRAND)),
)
def m1(spark, sf):
    return _items(spark, sf)


@register(
    "m2_clean_items",
    with_warehouse(
        f"""
SELECT order_id_nk, {om.STRIP.format(c='aisle_name')} AS aisle_name, product_name, department_name, reordered
FROM m_lines WHERE order_id_nk IS NOT NULL AND aisle_name IS NOT NULL
  AND {om.STRIP.format(c='aisle_name')} <> ''""",
        om.item_ctes(BRAND),
    ),
)
def m2(spark, sf):
    return bk.clean_items(_items(spark, sf), item_col=BRAND)


@register(
    "m3_baskets",
    _w(
        "SELECT o AS order_id_nk, string_agg(item, ', ' ORDER BY item) AS items_text, CAST(count(*) AS INTEGER) AS n_items FROM m_bk GROUP BY o",
        om.item_ctes(BRAND),
    ),
)
def m3(spark, sf):
    return bk.basket_text(_baskets(spark, sf, BRAND))


@register(
    "m4_itemsets",
    _w(
        "SELECT txt AS itemset, size, freq, round(CAST(freq AS DOUBLE) / n, 6) AS support FROM m_sets",
        om.itemset_ctes(BRAND, BRAND_SUPPORT),
    ),
)
def m4(spark, sf):
    sets = rules.frequent_itemsets(_baskets(spark, sf, BRAND), BRAND_SUPPORT)
    return rules.itemsets_report(sets)


@register(
    "m4_itemsets_type",
    _w(
        "SELECT txt AS itemset, size, freq, round(CAST(freq AS DOUBLE) / n, 6) AS support FROM m_sets",
        om.itemset_ctes(TYPE, TYPE_SUPPORT),
    ),
)
def m4t(spark, sf):
    sets = rules.frequent_itemsets(_baskets(spark, sf, TYPE), TYPE_SUPPORT)
    return rules.itemsets_report(sets)


@register(
    "m4_itemsets_up_to_2",
    _w(
        "SELECT txt AS itemset, size, freq, round(CAST(freq AS DOUBLE) / n, 6) AS support FROM m_sets WHERE size <= 2",
        om.itemset_ctes(BRAND, BRAND_SUPPORT),
    ),
)
def m4_short(spark, sf):
    """By levels: no longer set is built."""
    return rules.itemsets_report(rules.frequent_itemsets(_baskets(spark, sf, BRAND), BRAND_SUPPORT, max_len=2))


def _summary_sql(top_n: int = bk.DEFAULT_TOP_N) -> str:
    name = om.STRIP.format(c="product_name")

    def top(col: str, section: str) -> str:
        lab = om.STRIP.format(c=col)
        return f"""
  SELECT * FROM (SELECT '{section}' AS section, 'line_count' AS metric, {lab} AS label,
                        CAST(count(*) AS DOUBLE) AS value
                 FROM s_clean WHERE {col} IS NOT NULL AND {lab} <> ''
                 GROUP BY label ORDER BY count(*) DESC, label LIMIT {top_n})"""

    ctes = om.item_ctes(TYPE) + f""",
s_clean AS (
  SELECT order_id_nk, {name} AS product_name, aisle_name, department_name, reordered FROM m_lines
  WHERE order_id_nk IS NOT NULL AND product_name IS NOT NULL AND {name} <> ''
),
s_sizes AS (SELECT order_id_nk, count(DISTINCT product_name) AS size FROM s_clean GROUP BY order_id_nk)"""
    select = f"""
SELECT 'overall' AS section, metric, 'all' AS label, value FROM (
  SELECT 'order_product_rows' AS metric, CAST(count(*) AS DOUBLE) AS value FROM s_clean
  UNION ALL SELECT 'basket_count', CAST(count(*) AS DOUBLE) FROM s_sizes
  UNION ALL SELECT 'unique_products', CAST(count(DISTINCT product_name) AS DOUBLE) FROM s_clean
  UNION ALL SELECT 'avg_basket_size', round(avg(size), 4) FROM s_sizes
  UNION ALL SELECT 'median_basket_size', round(median(size), 4) FROM s_sizes
  UNION ALL SELECT 'max_basket_size', CAST(max(size) AS DOUBLE) FROM s_sizes
  UNION ALL SELECT 'reordered_rate', round(avg(CASE WHEN coalesce(reordered, false) THEN 1.0 ELSE 0.0 END), 4) FROM s_clean
)
UNION ALL {top('product_name', 'top_product')}
UNION ALL {top('department_name', 'top_department')}
UNION ALL {top('aisle_name', 'top_aisle')}"""
    return with_warehouse(select, ctes)


@register("m5_summary", _summary_sql())
def m5(spark, sf):
    return bk.summarize_baskets(_items(spark, sf))


@register(
    "m6_top_counts",
    with_warehouse(
        f"""
SELECT 'top_aisle' AS section, 'line_count' AS metric, label, CAST(n AS DOUBLE) AS value FROM (
  SELECT {om.STRIP.format(c='aisle_name')} AS label, count(*) AS n FROM m_lines
  WHERE aisle_name IS NOT NULL AND {om.STRIP.format(c='aisle_name')} <> ''
  GROUP BY label ORDER BY n DESC, label LIMIT 10)""",
        om.item_ctes(BRAND),
    ),
)
def m6(spark, sf):
    return bk.top_counts(_items(spark, sf), "aisle_name", "top_aisle", 10)


@register(
    "m7_rules",
    _w(
        f"SELECT antecedents, consequents, {om.rounded()} FROM m_rules",
        om.rule_ctes(TYPE, TYPE_SUPPORT, rules.DEFAULT_MIN_CONFIDENCE),
    ),
)
def m7(spark, sf):
    sets = rules.frequent_itemsets(_baskets(spark, sf, TYPE), TYPE_SUPPORT)
    r = rules.rule_text(rules.association_rules(sets))
    return r.select(
        "antecedents",
        "consequents",
        *[F.round(m, 6).alias(m) for m in ("support", "confidence", "lift", "antecedent_support", "consequent_support")],
    )


_BRAND_RULES = om.rule_ctes(BRAND, BRAND_SUPPORT, rules.DEFAULT_MIN_CONFIDENCE)


@register(
    "m8_ranked_rules",
    _w(
        f"SELECT antecedents, consequents, {om.rounded()} FROM m_ranked",
        _BRAND_RULES + "," + om.ranked_cte(rules.DEFAULT_MIN_LIFT, rules.DEFAULT_TOP_N),
    ),
)
def m8(spark, sf):
    return rules.rules_table(_ranked(spark, sf)).drop("rule_text", "business_meaning")


@register(
    "m9_rule_text",
    _w(
        f"SELECT antecedents, consequents, rule_text, business_meaning, {om.rounded()} FROM m_ranked",
        _BRAND_RULES + "," + om.ranked_cte(rules.DEFAULT_MIN_LIFT, rules.DEFAULT_TOP_N),
    ),
)
def m9(spark, sf):
    return rules.rules_table(_ranked(spark, sf))


@register(
    "m10_bundles",
    _w(
        """
SELECT antecedents AS bundle_products, consequents AS recommended_product,
       round(support, 6) AS support, round(confidence, 6) AS confidence, round(lift, 6) AS lift,
       'Bundle ' || antecedents || ' with ' || consequents || ' for cross-sell.' AS recommendation
FROM m_ranked WHERE NOT contains(consequents, ',')""",
        _BRAND_RULES + "," + om.ranked_cte(rules.DEFAULT_MIN_LIFT, rules.DEFAULT_TOP_N),
    ),
)
def m10(spark, sf):
    return rules.bundle_recommendations(_ranked(spark, sf))


@register(
    "s12_rule_table",
    _w(
        f"SELECT antecedents, consequents, rule_text, business_meaning, {om.rounded()} FROM m_ranked",
        _BRAND_RULES + "," + om.ranked_cte(rules.DEFAULT_MIN_LIFT, rules.DEFAULT_TOP_N),
    ),
)
def s12(spark, sf):
    """The rules as the warehouse table dm_association_rules, read by its name."""
    paths = WarehousePaths(f"{ensure_checkpoint_dir(spark)}/query-{uuid.uuid4().hex}")
    _write(rules.rules_table(_ranked(spark, sf)), paths, RULE_TABLE)
    register_views(spark, paths)
    return spark.table(RULE_TABLE)


def _threshold_sql() -> str:
    rows = []
    for t in rules.DEFAULT_THRESHOLDS:
        rows.append(
            f"""SELECT CAST({t!r} AS DOUBLE) AS min_support,
       CAST({rules.DEFAULT_MIN_CONFIDENCE!r} AS DOUBLE) AS min_confidence,
       CAST({rules.DEFAULT_MIN_LIFT!r} AS DOUBLE) AS min_lift,
       count(*) FILTER (WHERE support >= {t!r}) AS rule_count,
       coalesce(round(max(lift) FILTER (WHERE support >= {t!r}), 6), 0.0) AS max_lift,
       coalesce(round(avg(lift) FILTER (WHERE support >= {t!r}), 6), 0.0) AS avg_lift
FROM m_rules WHERE lift >= {rules.DEFAULT_MIN_LIFT!r}"""
        )
    return "\nUNION ALL\n".join(rows)


_THRESHOLD_CTES = om.rule_ctes(
    BRAND, min(rules.DEFAULT_THRESHOLDS), rules.DEFAULT_MIN_CONFIDENCE
)


def _thresholds(spark, sf):
    return rules.compare_thresholds(
        _baskets(spark, sf, BRAND),
        rules.DEFAULT_THRESHOLDS,
        rules.DEFAULT_MIN_CONFIDENCE,
        rules.DEFAULT_MIN_LIFT,
    )


@register("m11_thresholds", _w(_threshold_sql(), _THRESHOLD_CTES))
def m11(spark, sf):
    return _thresholds(spark, sf)


@register(
    "m12_rule_filter",
    _w(
        f"""
SELECT antecedents, consequents, {om.rounded()} FROM m_ranked
WHERE support >= {EXPLORER_MINS['min_support']!r} AND confidence >= {EXPLORER_MINS['min_confidence']!r}
  AND lift >= {EXPLORER_MINS['min_lift']!r} AND isfinite(support) AND isfinite(confidence) AND isfinite(lift)
ORDER BY lift DESC, antecedents, consequents""",
        _BRAND_RULES + "," + om.ranked_cte(rules.DEFAULT_MIN_LIFT, rules.DEFAULT_TOP_N),
    ),
)
def m12(spark, sf):
    picked = rules.filter_rules(_ranked(spark, sf), **EXPLORER_MINS)
    return rules.rules_table(picked).drop("rule_text", "business_meaning")


@register(
    "m13_metric_range",
    _w(
        """
SELECT 'support' AS metric, min(support) AS min_value, max(support) AS max_value FROM m_ranked
UNION ALL SELECT 'confidence', min(confidence), max(confidence) FROM m_ranked
UNION ALL SELECT 'lift', min(lift), max(lift) FROM m_ranked""",
        _BRAND_RULES + "," + om.ranked_cte(rules.DEFAULT_MIN_LIFT, rules.DEFAULT_TOP_N),
    ),
)
def m13(spark, sf):
    return rules.metric_range(_ranked(spark, sf))


@register(
    "m14_melt",
    _w(
        f"""
UNPIVOT (SELECT min_support, CAST(min_confidence AS DOUBLE) AS min_confidence,
                CAST(min_lift AS DOUBLE) AS min_lift, CAST(rule_count AS DOUBLE) AS rule_count,
                CAST(max_lift AS DOUBLE) AS max_lift, CAST(avg_lift AS DOUBLE) AS avg_lift
         FROM ({_threshold_sql()}))
ON min_confidence, min_lift, rule_count, max_lift, avg_lift INTO NAME metric VALUE value""",
        _THRESHOLD_CTES,
    ),
)
def m14(spark, sf):
    return rules.melt_thresholds(_thresholds(spark, sf))
