"""Order items, baskets and the basket summary (M1-M3, M5, M6).

A basket is the *set* of item names of one order.  It is built with a
``collect_set`` aggregate, which dedups map-side, so an order's array never
holds more than the distinct item count -- bounded by the product catalog,
not by the order's line count.  The summary needs no arrays at all: basket
sizes come from a two-step distinct count, and the exact median keeps one
counter per distinct size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.text import itemset_text, strip_ws

ORDER_COL = "order_id_nk"
ITEM_COL = "product_name"
# Summary rounding and the default top-N of the count lists.
SUMMARY_SCALE = 4
DEFAULT_TOP_N = 10


def order_items(fact_order_line: DataFrame, dim_product: DataFrame) -> DataFrame:
    """M1: order lines with product attributes, products with a name only."""
    p = dim_product.where(F.col("product_name").isNotNull()).select(
        "product_key", "product_name", "aisle_name", "department_name"
    )
    return fact_order_line.join(p, "product_key").select(
        "order_id_nk", "product_name", "aisle_name", "department_name", "reordered"
    )


def require_columns(df: DataFrame, required: Sequence[str]) -> None:
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"the frame lacks {missing}")


def clean_items(items: DataFrame, item_col: str = ITEM_COL, order_col: str = ORDER_COL) -> DataFrame:
    """M2: drop null order/item, strip whitespace, drop blank items."""
    require_columns(items, [order_col, item_col])
    stripped = strip_ws(F.col(item_col).cast("string"))
    return (
        items.where(F.col(order_col).isNotNull() & F.col(item_col).isNotNull())
        .withColumn(item_col, stripped)
        .where(F.col(item_col) != "")
    )


def baskets(
    items: DataFrame,
    item_col: str = ITEM_COL,
    order_col: str = ORDER_COL,
    min_items: int = 2,
) -> DataFrame:
    """M3: per order the sorted distinct items; keep baskets of >= 2 items.

    Output columns: ``order_col``, ``items`` (sorted array), ``n_items``.
    """
    cleaned = clean_items(items, item_col, order_col)
    grouped = cleaned.groupBy(order_col).agg(F.array_sort(F.collect_set(item_col)).alias("items"))
    return grouped.withColumn("n_items", F.size("items")).where(F.col("n_items") >= min_items)


def basket_text(b: DataFrame, order_col: str = ORDER_COL) -> DataFrame:
    """Printable baskets: ``", "``-joined sorted items."""
    return b.select(order_col, itemset_text(F.col("items")).alias("items_text"), "n_items")


def _long_rows(section: str, metric_values: Sequence[tuple[str, Column]]) -> Column:
    """An array of (section, metric, label, value) structs, one per metric."""
    return F.array(
        *[
            F.struct(
                F.lit(section).alias("section"),
                F.lit(metric).alias("metric"),
                F.lit("all").alias("label"),
                value.cast("double").alias("value"),
            )
            for metric, value in metric_values
        ]
    )


def top_counts(
    items: DataFrame,
    column: str,
    section: str,
    top_n: int = DEFAULT_TOP_N,
    weight: str | None = None,
) -> DataFrame:
    """M6: line counts per value of ``column`` (null/blank removed, stripped),
    most frequent first (ties by label), first ``top_n`` as long rows.
    ``weight`` names a pre-aggregated line-count column to sum instead of
    counting rows."""
    label = strip_ws(F.col(column).cast("string"))
    n = F.count(F.lit(1)) if weight is None else F.sum(weight)
    return (
        items.where(F.col(column).isNotNull())
        .select(label.alias("label"), *([weight] if weight else []))
        .where(F.col("label") != "")
        .groupBy("label")
        .agg(n.alias("_n"))
        .orderBy(F.desc("_n"), F.asc("label"))
        .limit(top_n)
        .select(
            F.lit(section).alias("section"),
            F.lit("line_count").alias("metric"),
            "label",
            F.col("_n").cast("double").alias("value"),
        )
    )


def summarize_baskets(
    items: DataFrame,
    item_col: str = ITEM_COL,
    order_col: str = ORDER_COL,
    top_n: int = DEFAULT_TOP_N,
) -> DataFrame:
    """M5: overall basket statistics (all baskets, size 1 included) plus the
    top-N item, department and aisle counts, as (section, metric, label,
    value) rows."""
    cleaned = clean_items(items, item_col, order_col)
    sizes = cleaned.groupBy(order_col).agg(F.countDistinct(item_col).alias("size"))
    # Two independent one-row aggregates, each unpivoted to long rows and
    # unioned -- no scalar subqueries re-running the size aggregation.
    size_rows = sizes.agg(
        F.count(F.lit(1)).alias("basket_count"),
        F.round(F.avg("size"), SUMMARY_SCALE).alias("avg_basket_size"),
        F.round(F.median("size"), SUMMARY_SCALE).alias("median_basket_size"),
        F.max("size").alias("max_basket_size"),
    ).select(
        F.inline(
            _long_rows(
                "overall",
                [(m, F.col(m)) for m in ("basket_count", "avg_basket_size", "median_basket_size", "max_basket_size")],
            )
        )
    )
    # All line-level metrics come from one pre-aggregate per (item,
    # department, aisle): every branch below reads the same (reused)
    # shuffle instead of re-scanning the lines.
    dims = [c for c in ("department_name", "aisle_name") if c in cleaned.columns and c != item_col]
    has_reordered = "reordered" in cleaned.columns
    pre_aggs = [F.count(F.lit(1)).alias("_lines")]
    if has_reordered:
        reordered = F.coalesce(F.col("reordered").cast("boolean"), F.lit(False))
        pre_aggs.append(F.sum(F.when(reordered, 1).otherwise(0)).alias("_reordered"))
    pre = cleaned.groupBy(item_col, *dims).agg(*pre_aggs)
    line_aggs = [
        F.coalesce(F.sum("_lines"), F.lit(0)).alias("order_product_rows"),
        F.countDistinct(item_col).alias("unique_products"),
    ]
    line_metrics = ["order_product_rows", "unique_products"]
    if has_reordered:
        line_aggs.append(
            F.round(F.sum("_reordered") / F.sum("_lines"), SUMMARY_SCALE).alias("reordered_rate")
        )
        line_metrics.append("reordered_rate")
    line_rows = pre.agg(*line_aggs).select(
        F.inline(_long_rows("overall", [(m, F.col(m)) for m in line_metrics]))
    )
    out = line_rows.unionByName(size_rows)
    out = out.unionByName(top_counts(pre, item_col, "top_product", top_n, weight="_lines"))
    if "department_name" in cleaned.columns:
        out = out.unionByName(top_counts(pre, "department_name", "top_department", top_n, weight="_lines"))
    if "aisle_name" in cleaned.columns:
        out = out.unionByName(top_counts(pre, "aisle_name", "top_aisle", top_n, weight="_lines"))
    return out
