"""DuckDB oracle SQL for the mining queries: every subset of every basket is
counted, and every split of every frequent itemset is priced."""

from __future__ import annotations

STRIP = r"regexp_replace(CAST({c} AS VARCHAR), '^\s+|\s+$', '', 'g')"


def item_ctes(item_col: str) -> str:
    item = STRIP.format(c=f"p.{item_col}")
    return f"""
m_lines AS (
  SELECT f.order_id_nk, p.product_name, p.aisle_name, p.department_name, f.reordered
  FROM fact_order_line f JOIN dim_product p ON p.product_key = f.product_key
  WHERE p.product_name IS NOT NULL
),
m_items AS (
  SELECT DISTINCT order_id_nk AS o, item FROM (
    SELECT p.order_id_nk, {item} AS item FROM m_lines p
    WHERE p.order_id_nk IS NOT NULL AND p.{item_col} IS NOT NULL)
  WHERE item <> ''
),
m_bk AS (
  SELECT o, item FROM m_items WHERE o IN (SELECT o FROM m_items GROUP BY o HAVING count(*) >= 2)
),
m_n AS (SELECT count(DISTINCT o) AS n FROM m_bk)"""


_PICK = "list_filter({items}, lambda x, i: (mask // CAST(pow(2, i - 1) AS BIGINT)) % 2 = {bit})"


def itemset_ctes(item_col: str, min_support: float) -> str:
    return item_ctes(item_col) + f""",
m_lists AS (SELECT o, list(item ORDER BY item) AS items FROM m_bk GROUP BY o),
m_subsets AS (
  SELECT {_PICK.format(items="items", bit=1)} AS items
  FROM (SELECT items, unnest(range(1, CAST(pow(2, len(items)) AS BIGINT))) AS mask FROM m_lists)
),
m_sets AS (
  SELECT items, CAST(len(items) AS INTEGER) AS size, count(*) AS freq, any_value(m_n.n) AS n,
         array_to_string(items, ', ') AS txt
  FROM m_subsets, m_n GROUP BY items
  HAVING CAST(count(*) AS DOUBLE) / any_value(m_n.n) >= {min_support!r}
)"""


def rule_ctes(item_col: str, min_support: float, min_confidence: float) -> str:
    return itemset_ctes(item_col, min_support) + f""",
m_splits AS (
  SELECT array_to_string({_PICK.format(items="items", bit=1)}, ', ') AS a,
         array_to_string({_PICK.format(items="items", bit=0)}, ', ') AS c, freq, n
  FROM (SELECT *, unnest(range(1, CAST(pow(2, size) AS BIGINT) - 1)) AS mask FROM m_sets WHERE size >= 2)
),
m_rules AS (
  SELECT * FROM (
    SELECT s.a AS antecedents, s.c AS consequents,
           CAST(s.freq AS DOUBLE) / s.n AS support,
           CAST(s.freq AS DOUBLE) / fa.freq AS confidence,
           (CAST(s.freq AS DOUBLE) / fa.freq) / (CAST(fc.freq AS DOUBLE) / s.n) AS lift,
           CAST(fa.freq AS DOUBLE) / s.n AS antecedent_support,
           CAST(fc.freq AS DOUBLE) / s.n AS consequent_support
    FROM m_splits s
    JOIN m_sets fa ON fa.txt = s.a
    JOIN m_sets fc ON fc.txt = s.c)
  WHERE confidence >= {min_confidence!r}
)"""


RANK = "ORDER BY lift DESC, confidence DESC, support DESC, antecedents, consequents"


def ranked_cte(min_lift: float, top_n: int | None) -> str:
    limit = f"LIMIT {top_n}" if top_n is not None else ""
    return f"""
m_ranked AS (
  SELECT *, antecedents || ' => ' || consequents AS rule_text,
         printf('Recommend %s when a basket contains %s (confidence=%.2f%%, lift=%.2f).',
                consequents, antecedents, round(confidence * 100, 2), round(lift, 2)) AS business_meaning
  FROM m_rules WHERE lift >= {min_lift!r} {RANK} {limit}
)"""


def rounded(cols=("support", "confidence", "lift", "antecedent_support", "consequent_support")) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" for c in cols)
