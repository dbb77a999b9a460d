"""Data-quality and reconciliation checks (Q1-Q17).

Each check is a query: either the violating rows (empty = pass) or one
metrics row.  Counts that feed a single output row are scalar subqueries
(each a small job whose value is inlined), never a cross join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.schemas import DEFAULT_BRANCH_ID

# The membership tiers, in report order.
TIERS = ("Platinum", "Gold", "Silver")


def _count(df: DataFrame) -> Column:
    return df.select(F.count(F.lit(1))).scalar()


def duplicate_grain(df: DataFrame, grain: Sequence[str]) -> DataFrame:
    """Q1/Q2: groups of the grain that occur more than once."""
    return (
        df.groupBy(*grain)
        .agg(F.count(F.lit(1)).alias("copies"))
        .where(F.col("copies") > 1)
    )


def fk_orphans(fact: DataFrame, dims: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Q3/Q4: fact rows whose key is missing from the dimension, per FK.

    The fact is first counted per key (map-side combined), so the anti-join
    meets one row per distinct key instead of every fact row; null keys
    never match and count as orphans.  One (fk, orphan_rows) row per FK.
    """
    parts = []
    for name, (dim, key) in dims.items():
        keys = dim.select(F.col(key).alias("_k")).distinct()
        per_key = fact.groupBy(F.col(key).alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
        orphans = per_key.join(keys, "_k", "left_anti")
        parts.append(orphans.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("orphan_rows")).select(
            F.lit(name).alias("fk"), "orphan_rows"
        ))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def row_count_match(fact: DataFrame, staged: DataFrame) -> DataFrame:
    """Q5: fact line count equals staged line count."""
    f, s = _count(fact), _count(staged)
    return fact.sparkSession.range(1).select(
        f.alias("fact_rows"), s.alias("staged_rows"), (f == s).alias("matches")
    )


def null_count(df: DataFrame, column: str) -> DataFrame:
    """Q6: nulls in a column that must be filled."""
    return df.agg(F.count_if(F.col(column).isNull()).alias(f"null_{column}"))


def recompute_mismatches(actual: DataFrame, expected: DataFrame, key: str, column: str) -> DataFrame:
    """Q7: rows whose stored value differs from an independent recomputation
    (joined on the key; both sides carry one row per key)."""
    e = expected.select(F.col(key).alias("_k"), F.col(column).alias("_expected"))
    j = actual.select(F.col(key).alias("_k"), F.col(column).alias("_actual")).join(e, "_k")
    return j.agg(
        F.count(F.lit(1)).alias("checked_rows"),
        F.count_if(~F.col("_actual").eqNullSafe(F.col("_expected"))).alias("mismatches"),
    )


def missing_columns(tables: Mapping[str, DataFrame], contract: Mapping[str, Sequence[str]]) -> list[tuple[str, str]]:
    """Q8: (table, column) pairs required by the contract but absent.
    A schema check: it reads metadata only."""
    missing = []
    for table, cols in contract.items():
        present = set(tables[table].columns) if table in tables else set()
        missing += [(table, c) for c in cols if c not in present]
    return missing


def source_drift(headers: Mapping[str, Sequence[str]], contract: Mapping[str, Sequence[str]]) -> list[tuple[str, str, str]]:
    """Q8 on raw sources: (source, column, finding) where a header lacks a
    contract column ("missing") or has one beyond it ("unexpected")."""
    found = []
    for source, wanted in contract.items():
        have = list(headers.get(source, ()))
        found += [(source, c, "missing") for c in wanted if c not in have]
        found += [(source, c, "unexpected") for c in have if c not in wanted]
    return found


def missing_tables(spark: SparkSession, names: Sequence[str], root: str | None = None) -> list[str]:
    """Q9: required tables absent from the catalog (or from ``root`` when the
    warehouse is path-based)."""
    from tillroll.sources.files import _exists
    from tillroll.sources.versions import read_version

    if root is None:
        return [n for n in names if not spark.catalog.tableExists(n)]
    known = read_version(spark, root).tables
    return [n for n in names if n not in known and not _exists(spark, f"{root.rstrip('/')}/{n}")]


def default_member(dim_branch: DataFrame, branch_id: str = DEFAULT_BRANCH_ID) -> DataFrame:
    """Q10: exactly one DEFAULT_BRANCH row."""
    n = F.count_if(F.col("branch_id_nk") == branch_id)
    return dim_branch.agg(n.alias("default_branch_rows"), (n == 1).alias("ok"))


def rerun_is_idempotent(first_run_rows: DataFrame, second_run_rows: DataFrame) -> DataFrame:
    """Q11: the second load of the same source adds nothing."""
    a, b = _count(first_run_rows), _count(second_run_rows)
    return first_run_rows.sparkSession.range(1).select(
        a.alias("first_run_rows"), b.alias("second_run_rows"), (b == 0).alias("idempotent")
    )


def key_overlap(orders: DataFrame, lines: DataFrame, key: str = "order_id") -> DataFrame:
    """Q12: distinct orders that have at least one line (line keys are
    deduplicated map-side before the semi-join)."""
    return orders.select(key).join(lines.select(key).distinct(), key, "left_semi").agg(
        F.countDistinct(key).alias("orders_with_lines")
    )


def reconciliation(
    fact_summary: DataFrame, fact_line: DataFrame, staged_lines: DataFrame, bronze_rows: DataFrame
) -> DataFrame:
    """Q13: one summary row per fact order, and rows_loaded of a clean full
    run = bronze orders + staged lines + fact lines."""
    summary = _count(fact_summary)
    orders = fact_line.select(F.countDistinct("order_id_nk")).scalar()
    b, s, f = _count(bronze_rows), _count(staged_lines), _count(fact_line)
    return fact_line.sparkSession.range(1).select(
        summary.alias("summary_rows"),
        orders.alias("fact_orders"),
        (summary == orders).alias("summary_matches"),
        (b + s + f).alias("rows_loaded"),
    )


def control_totals(layers: Mapping[str, Mapping[str, DataFrame]]) -> DataFrame:
    """Q14: (layer, table_name, row_count) for every table."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), "row_count"
        )
        for layer, tables in layers.items()
        for name, df in tables.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def distribution_profile(fact: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Q15: distinct orders/products, reordered true/false lines and
    customers per tier (tiers without customers listed with 0)."""
    spark = fact.sparkSession
    # One group-by per distinct key instead of two distinct counts over the lines, which
    # would expand every line twice; the line counts ride along with the products.
    per_product = fact.groupBy("product_key").agg(
        F.count_if(F.col("reordered")).alias("yes"), F.count_if(~F.col("reordered")).alias("no")
    )
    orders = fact.select("order_id_nk").distinct().select(F.count("order_id_nk"))
    facts = per_product.agg(
        F.count("product_key").alias("distinct_products"),
        F.coalesce(F.sum("yes"), F.lit(0)).alias("reordered_true"),
        F.coalesce(F.sum("no"), F.lit(0)).alias("reordered_false"),
    ).withColumn("distinct_orders", orders.scalar())
    fact_rows = facts.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(m).alias("metric"), F.lit("all").alias("label"), F.col(m).alias("value"))
                    for m in ("distinct_orders", "distinct_products", "reordered_true", "reordered_false")
                ]
            )
        )
    )
    tiers = spark.createDataFrame([(t,) for t in TIERS], "label string")
    # One row per tier value (a 3-way CASE): the broadcast build side.
    per_tier = F.broadcast(
        dim_customer.groupBy(F.col("membership_tier").alias("label")).agg(F.count(F.lit(1)).alias("value"))
    )
    tier_rows = tiers.join(per_tier, "label", "left").select(
        F.lit("customers_per_tier").alias("metric"), "label", F.coalesce("value", F.lit(0)).alias("value")
    )
    return fact_rows.unionByName(tier_rows.select("metric", "label", F.col("value").cast("long")))


def value_ranges(dim_date: DataFrame, fact_summary: DataFrame) -> DataFrame:
    """Q16: min/max of the order dates, days since prior order and items."""
    dates = dim_date.agg(F.min("full_date").alias("min_date"), F.max("full_date").alias("max_date"))
    return fact_summary.agg(
        F.min("days_since_prior").alias("min_days_since_prior"),
        F.max("days_since_prior").alias("max_days_since_prior"),
        F.min("total_items").alias("min_total_items"),
        F.max("total_items").alias("max_total_items"),
    ).select(
        dates.select("min_date").scalar().alias("min_date"),
        dates.select("max_date").scalar().alias("max_date"),
        "*",
    )


def successful_run_exists(log: DataFrame) -> DataFrame:
    """Q17: at least one SUCCESS row in the run log."""
    n = F.count_if(F.col("status") == "SUCCESS")
    return log.agg(n.alias("success_runs"), (n >= 1).alias("ok"))
