"""Analytic queries over the star schema.

``Star`` holds the fact and its dimensions; ``Filters`` is the multi-select
filter (A1).  Dimension filters are written above the join and Catalyst pushes
them into the dimension side, so the fact is only probed with the surviving
keys.  Queries that count lines read ``Star.counted``: the fact is aggregated
per (product, date, branch) key, map-side combined, before it meets the
dimensions, so a hot product is one row per date and not every line.

Distinct counts come from the stored bitmaps (:mod:`tillroll.operators.cubes`)
if the star has them, and else from a group-by on the distinct key followed by
a count.  Two of them in one aggregate would expand every line once per count.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.dates import DOW_ORDER
from tillroll.functions.filters import in_filters
from tillroll.operators import cubes

METRIC_SCALE = 6  # doubles are reported rounded to 6 decimals


@dataclass(frozen=True)
class Filters:
    """A1: optional multi-selects on branch name, weekday and department."""

    branches: Sequence[str] = ()
    dows: Sequence[str] = ()
    departments: Sequence[str] = ()

    def predicate(self) -> Column:
        return in_filters(
            {
                "branch_name": self.branches,
                "day_of_week": self.dows,
                "department_name": self.departments,
            }
        )


NO_FILTER = Filters()


def _r(c: Column) -> Column:
    return F.round(c, METRIC_SCALE)


# The branch dimension is a hand-kept seed; up to this many rows it is broadcast.
BROADCAST_BRANCHES = 10_000

Stored = DataFrame | Callable[[], DataFrame] | None


@dataclass(frozen=True)
class Star:
    """The fact and the dimensions it joins on their keys."""

    fact: DataFrame
    product: DataFrame
    branch: DataFrame
    date: DataFrame
    customer: DataFrame | None = None
    # Stored beside the fact: cubes.line_counts and cubes.distinct_cube of it, or
    # what stores them, called when a query first reads them.
    stored_counts: Stored = None
    stored_cube: Stored = None

    @cached_property
    def counts(self) -> DataFrame | None:
        return self.stored_counts() if callable(self.stored_counts) else self.stored_counts

    @cached_property
    def cube(self) -> DataFrame | None:
        return self.stored_cube() if callable(self.stored_cube) else self.stored_cube

    def _with_dimensions(self, fact: DataFrame) -> DataFrame:
        joined = (
            fact.join(self.product, "product_key").join(self.branch, "branch_key").join(self.date, "date_key")
        )
        if self.customer is not None and "customer_key" in fact.columns:
            joined = joined.join(self.customer, "customer_key")
        return joined

    @property
    def joined(self) -> DataFrame:
        """fact ⋈ product ⋈ branch ⋈ date (⋈ customer), a row per line."""
        return self._with_dimensions(self.fact)

    def counted(self, filters: Filters = NO_FILTER) -> DataFrame:
        """The joined rows per (product, date, branch) key instead of per line,
        with ``_lines``, ``_quantity`` and ``_reordered`` to add up."""
        if self.customer is not None:
            per_key = cubes.line_counts(self.fact, [*cubes.KEYS, "customer_key"])
        else:
            per_key = cubes.line_counts(self.fact) if self.counts is None else self.counts
        return self._with_dimensions(per_key).where(filters.predicate())

    def selected(self, filters: Filters = NO_FILTER) -> DataFrame:
        """The stored bitmaps under the filters."""
        placed = self.cube.where("known").join(self.branch, "branch_key").join(self.date, "date_key")
        return placed.where(filters.predicate())

    def lines(self, filters: Filters, *columns: str) -> DataFrame:
        """The selected lines with ``columns`` of the fact and the dates; each
        dimension comes with its key and the columns asked for alone."""
        products = self.product.where(in_filters({"department_name": filters.departments})).select("product_key")
        placed = self.fact.join(products, "product_key")
        placed = placed.join(self.branch.where(in_filters({"branch_name": filters.branches})).select("branch_key"), "branch_key")
        dates = self.date.where(in_filters({"day_of_week": filters.dows})).select("date_key", "full_date", "day_of_week")
        return placed.join(dates, "date_key").select(*columns)


def star(
    fact: DataFrame,
    dim_product: DataFrame,
    dim_branch: DataFrame,
    dim_date: DataFrame,
    dim_customer: DataFrame | None = None,
    counts: Stored = None,
    cube: Stored = None,
) -> Star:
    """The star over a fact.  Every line has the same branch, so a shuffle on
    its key would send the whole fact to one task: the branch side is broadcast
    once a look at its rows shows that it is small."""
    small = len(dim_branch.select("branch_key").take(BROADCAST_BRANCHES + 1)) <= BROADCAST_BRANCHES
    branch = F.broadcast(dim_branch) if small else dim_branch
    return Star(fact, dim_product.drop("product_id_nk"), branch, dim_date, dim_customer, counts, cube)


def filtered_star(star: Star, filters: Filters = NO_FILTER) -> DataFrame:
    """A1 applied to the joined lines."""
    return star.joined.where(filters.predicate())


def _lines() -> Column:
    return F.sum("_lines").cast("long").alias("lines")


def _rate() -> Column:
    return F.sum("_reordered") / F.sum("_lines")


def _distinct(df: DataFrame, column: str) -> Column:
    """The number of distinct values as a scalar subquery."""
    return df.select(column).distinct().select(F.count(column)).scalar()


def kpis(star: Star, filters: Filters = NO_FILTER) -> DataFrame:
    """A2: one-row KPI block (null rate shown as 0).

    Lines, items, rate and products come from the counted star; orders and
    customers from the bitmaps, or from one pass that keeps a row per order and
    customer.
    """
    if star.cube is not None:
        selected = star.selected(filters)
        orders, customers = cubes.distinct_total(selected, cubes.ORDER), cubes.distinct_total(selected, cubes.CUSTOMER)
    else:
        per_order = filtered_star(star, filters).select("order_id_nk", "customer_key").distinct()
        orders, customers = _distinct(per_order, "order_id_nk"), _distinct(per_order, "customer_key")
    per_product = star.counted(filters).groupBy("product_key").agg(
        F.sum("_lines").alias("_lines"), F.sum("_quantity").alias("_quantity"), F.sum("_reordered").alias("_reordered")
    )
    return per_product.agg(
        F.coalesce(F.sum("_lines"), F.lit(0)).cast("long").alias("order_lines"),
        F.count("product_key").alias("products"),
        _r(F.coalesce(_rate(), F.lit(0.0))).alias("reorder_rate"),
        F.sum("_quantity").cast("long").alias("total_items"),
    ).select(
        orders.alias("orders"),
        "order_lines",
        "products",
        customers.alias("customers"),
        "reorder_rate",
        "total_items",
    )


def weekday_frame(spark: SparkSession) -> DataFrame:
    """The 7 weekdays with their display position (a fixed 7-row table)."""
    return spark.createDataFrame(
        [(name, i + 1) for i, name in enumerate(DOW_ORDER)], "day_of_week string, day_index int"
    )


def orders_by_weekday(star: Star, filters: Filters = NO_FILTER) -> DataFrame:
    """A3: distinct orders per weekday, completed to Monday..Sunday with 0."""
    if star.cube is not None:
        counts = cubes.distinct_counts(star.selected(filters), ["day_of_week"], cubes.ORDER)
    else:
        counts = star.lines(filters, "day_of_week", "order_id_nk").groupBy("day_of_week").agg(F.countDistinct("order_id_nk").alias("orders"))
    # The aggregated side has at most one row per weekday (a proven bound),
    # so it is the broadcast build side of the outer join.
    week = weekday_frame(star.fact.sparkSession)
    return (
        week.join(F.broadcast(counts), "day_of_week", "left")
        .select("day_of_week", F.coalesce("orders", F.lit(0)).cast("long").alias("orders"), "day_index")
        .orderBy("day_index")
        .drop("day_index")
    )


def top_departments(star: Star, filters: Filters = NO_FILTER, n: int = 10) -> DataFrame:
    """A4: departments by line count, top n (ties by name)."""
    return (
        star.counted(filters)
        .groupBy("department_name")
        .agg(_lines())
        .orderBy(F.desc("lines"), F.asc_nulls_last("department_name"))
        .limit(n)
    )


def daily_trend(star: Star, filters: Filters = NO_FILTER) -> DataFrame:
    """A5: items and distinct orders per date."""
    if star.cube is not None:
        items = star.counted(filters).groupBy("full_date").agg(F.sum("_quantity").cast("long").alias("items"))
        orders = cubes.distinct_counts(star.selected(filters), ["full_date"], cubes.ORDER)
        per_date = items.join(orders, items["full_date"].eqNullSafe(orders["full_date"]), "left").select(
            items["full_date"], "items", F.coalesce("orders", F.lit(0).cast("long")).alias("orders")
        )
    else:
        lines = star.lines(filters, "full_date", "quantity", "order_id_nk")
        per_date = lines.groupBy("full_date").agg(F.sum("quantity").cast("long").alias("items"), F.countDistinct("order_id_nk").alias("orders"))
    return per_date.orderBy("full_date")


def department_weekday_heatmap(star: Star, filters: Filters = NO_FILTER) -> DataFrame:
    """Line counts pivoted to Monday..Sunday columns (0-filled), rows by
    total desc.  The pivot values are given, so no extra pass finds them."""
    pivot = (
        star.counted(filters)
        .groupBy("department_name")
        .pivot("day_of_week", DOW_ORDER)
        .agg(F.sum("_lines"))
        .fillna(0, subset=DOW_ORDER)
    )
    total = sum((F.col(d) for d in DOW_ORDER), F.lit(0))
    return pivot.select(
        "department_name", *[F.col(d).cast("long").alias(d) for d in DOW_ORDER]
    ).orderBy(total.desc(), F.asc_nulls_last("department_name"))


def top_products(star: Star, filters: Filters = NO_FILTER, n: int = 20) -> DataFrame:
    """Top n (product, aisle, department) by quantity."""
    if not 1 <= n:
        raise ValueError("n must be >= 1")
    return (
        star.counted(filters)
        .groupBy("product_name", "aisle_name", "department_name")
        .agg(
            _lines(),
            F.sum("_quantity").cast("long").alias("quantity"),
            _r(_rate()).alias("reorder_rate"),
        )
        .orderBy(
            F.desc("quantity"),
            F.desc("lines"),
            F.asc_nulls_last("product_name"),
            F.asc_nulls_last("aisle_name"),
            F.asc_nulls_last("department_name"),
        )
        .limit(n)
    )


def reorder_rate_percent(top: DataFrame) -> DataFrame:
    """Reorder rate in percent, one decimal."""
    return top.withColumn("reorder_rate_pct", F.round(F.col("reorder_rate") * 100, 1))


def aisles_by_reorder_rate(star: Star, filters: Filters = NO_FILTER, n: int = 20) -> DataFrame:
    """Aisles by reorder rate, top n."""
    return (
        star.counted(filters)
        .groupBy("aisle_name")
        .agg(_lines(), _r(_rate()).alias("reorder_rate"))
        .orderBy(F.desc("reorder_rate"), F.desc("lines"), F.asc_nulls_last("aisle_name"))
        .limit(n)
    )


def department_aisle_rollup(star: Star, filters: Filters = NO_FILTER) -> DataFrame:
    """A10: department > aisle line counts with department totals and the
    grand total (``level`` 0 = leaf, 1 = department, 3 = all)."""
    return (
        star.counted(filters)
        .rollup("department_name", "aisle_name")
        .agg(_lines(), F.grouping_id().cast("int").alias("level"))
        .orderBy("level", F.desc("lines"), F.asc_nulls_last("department_name"), F.asc_nulls_last("aisle_name"))
    )


def tier_distribution(dim_customer: DataFrame) -> DataFrame:
    """Customers and average orders per tier, with each tier's share of
    all customers (the total is a scalar subquery)."""
    total = dim_customer.select(F.count(F.lit(1))).scalar()
    per_tier = dim_customer.groupBy("membership_tier").agg(
        F.count(F.lit(1)).alias("customers"),
        _r(F.avg("total_orders")).alias("avg_orders"),
    )
    return per_tier.withColumn("share", _r(F.col("customers") / total)).orderBy(
        F.desc("customers"), "membership_tier"
    )


# Fixed value: bins of the total-orders histogram.
HISTOGRAM_BINS = 20


def total_orders_histogram(dim_customer: DataFrame, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Equal-width histogram of total_orders in ``bins`` bins.  The
    min/max are scalar subqueries (one tiny job, value inlined)."""
    x = F.col("total_orders")
    stats = dim_customer.agg(F.min(x).alias("mn"), F.max(x).alias("mx"))
    mn = stats.select("mn").scalar()
    mx = stats.select("mx").scalar()
    width = F.try_divide((mx - mn).cast("double"), F.lit(float(bins)))
    raw_bin = F.floor(F.try_divide((x - mn).cast("double"), width))
    b = F.when(mx == mn, F.lit(0)).otherwise(F.least(raw_bin, F.lit(bins - 1))).cast("int")
    return (
        dim_customer.select(b.alias("bin"))
        .groupBy("bin")
        .agg(F.count(F.lit(1)).alias("customers"))
        .select(
            "bin",
            _r(mn + F.col("bin") * width).alias("bin_start"),
            _r(mn + (F.col("bin") + 1) * width).alias("bin_end"),
            "customers",
        )
        .orderBy("bin")
    )


def top_customers(
    star: Star,
    dim_customer: DataFrame,
    filters: Filters = NO_FILTER,
    n: int = 20,
) -> DataFrame:
    """Top n customers by lines.

    The (filtered) fact is aggregated per customer key *before* meeting the
    user-sized customer dimension, so the big join sees one row per
    customer instead of every line.  Dimension rows are counted as copies
    per (key, user, tier): joining k copies multiplies lines and quantity by
    k and leaves the distinct orders alone, as the join-first query does;
    different keys of one user hold disjoint orders, so their counts add.
    """
    per_key = (
        star.lines(filters, "customer_key", "order_id_nk", "quantity")
        .groupBy("customer_key")
        .agg(
            F.countDistinct("order_id_nk").alias("_orders"),
            F.count(F.lit(1)).alias("_lines"),
            F.sum("quantity").alias("_qty"),
        )
    )
    members = dim_customer.groupBy("customer_key", "user_id_nk", "membership_tier").agg(
        F.count(F.lit(1)).alias("_copies")
    )
    return (
        per_key.join(members, "customer_key")
        .groupBy("user_id_nk", "membership_tier")
        .agg(
            F.sum("_orders").cast("long").alias("orders"),
            F.sum(F.col("_lines") * F.col("_copies")).cast("long").alias("lines"),
            F.sum(F.col("_qty") * F.col("_copies")).cast("long").alias("quantity"),
        )
        .orderBy(F.desc("lines"), F.desc("orders"), F.asc_nulls_last("user_id_nk"))
        .limit(n)
    )


def headline_stats(fact: DataFrame, dim_product: DataFrame, log: DataFrame, star: Star | None = None) -> DataFrame:
    """Fact distinct counts, department count and the last successful
    finish time (minute precision), as one row; from ``star``'s stored counts
    and bitmaps if it has them."""
    departments = dim_product.agg(F.countDistinct("department_name")).scalar()
    last_run = log.where(F.col("status") == "SUCCESS").agg(F.max("finished_at")).scalar()
    if star is not None and star.cube is not None:
        per_product = star.counts.groupBy("product_key").agg(F.sum("_lines").alias("_lines"))
        orders, customers = cubes.distinct_total(star.cube, cubes.ORDER), cubes.distinct_total(star.cube, cubes.CUSTOMER)
    else:
        per_order = fact.select("order_id_nk", "customer_key").distinct()
        per_product = fact.groupBy("product_key").agg(F.count(F.lit(1)).alias("_lines"))
        orders, customers = _distinct(per_order, "order_id_nk"), _distinct(per_order, "customer_key")
    return per_product.agg(
        F.coalesce(F.sum("_lines"), F.lit(0)).cast("long").alias("lines"), F.count("product_key").alias("products")
    ).select(
        orders.alias("orders"),
        "lines",
        customers.alias("customers"),
        "products",
        departments.alias("departments"),
        F.date_format(last_run, "yyyy-MM-dd HH:mm").alias("last_success"),
    )


def filter_values(dim_branch: DataFrame, dim_date: DataFrame, dim_product: DataFrame) -> DataFrame:
    """The values offered by each multi-select, in display order."""
    week = F.broadcast(weekday_frame(dim_date.sparkSession))
    branches = dim_branch.select(
        F.lit("branch").alias("filter_name"), F.col("branch_name").alias("value")
    ).distinct()
    days = (
        dim_date.select(F.col("day_of_week").alias("value"))
        .distinct()
        .join(week.withColumnRenamed("day_of_week", "value"), "value")
        .select(F.lit("day_of_week").alias("filter_name"), "value", "day_index")
    )
    depts = dim_product.select(
        F.lit("department").alias("filter_name"), F.col("department_name").alias("value")
    ).distinct()
    return (
        branches.withColumn("day_index", F.lit(0))
        .unionByName(days)
        .unionByName(depts.withColumn("day_index", F.lit(0)))
        .orderBy("filter_name", "day_index", F.asc_nulls_last("value"))
        .drop("day_index")
    )
