"""the literal warehouse fixture through Silver and Gold."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.fixtures import raw_f1
from tillroll.operators import marts, silver
from tillroll.plans.layers import build_gold, build_silver


@pytest.fixture(scope="module")
def layers(spark):
    raw = raw_f1(spark)
    s = build_silver(raw)
    g = build_gold(raw, s)
    return raw, s, g


def test_synthetic_dates(layers):
    _, s, _ = layers
    got = {r.order_id: r.synthetic_order_date for r in s.stg_orders.collect()}
    assert got == {1: dt.date(2024, 1, 1), 2: dt.date(2024, 1, 6), 3: dt.date(2024, 1, 1)}


def test_dim_date(layers):
    _, _, g = layers
    got = sorted((r.full_date, r.day_of_week, r.is_weekend) for r in g.dim_date.collect())
    assert got == [(dt.date(2024, 1, 1), "Monday", False), (dt.date(2024, 1, 6), "Saturday", True)]


def test_dim_product_and_customer(layers):
    _, _, g = layers
    prods = {r.product_id_nk: r.is_organic for r in g.dim_product.collect()}
    assert prods == {"101": True, "102": False, "103": False}
    cust = {r.user_id_nk: (r.total_orders, r.membership_tier) for r in g.dim_customer.collect()}
    assert cust == {"10": (2, "Silver"), "11": (1, "Silver")}


def test_facts(layers):
    _, _, g = layers
    assert g.fact_order_line.count() == 4
    summ = {
        r.order_id_nk: (r.total_items, r.total_distinct_items, r.days_since_prior)
        for r in g.fact_order_summary.collect()
    }
    assert summ == {"1": (1, 1, 0), "2": (2, 2, 5), "3": (1, 1, 0)}


def test_marts_on_fixture(layers):
    _, _, g = layers
    star = marts.star(g.fact_order_line, g.dim_product, g.dim_branch, g.dim_date)
    depts = [(r.department_name, r.lines) for r in marts.top_departments(star).collect()]
    assert depts == [("Produce", 3), ("Dairy Eggs", 1)]
    k = marts.kpis(star).first()
    assert (k.orders, k.order_lines, k.reorder_rate, k.total_items) == (3, 4, 0.25, 4)
    week = [(r.day_of_week, r.orders) for r in marts.orders_by_weekday(star).collect()]
    assert week[0] == ("Monday", 2) and week[5] == ("Saturday", 1) and len(week) == 7
    filt = marts.kpis(star, marts.Filters(departments=["Dairy Eggs"])).first()
    assert (filt.orders, filt.order_lines) == (1, 1)
    empty = marts.kpis(star, marts.Filters(dows=["Tuesday"])).first()
    assert empty.order_lines == 0 and empty.reorder_rate == 0.0


def test_rollup_totals_equal_children(layers):
    _, _, g = layers
    star = marts.star(g.fact_order_line, g.dim_product, g.dim_branch, g.dim_date)
    rows = marts.department_aisle_rollup(star).collect()
    total = [r.lines for r in rows if r.level == 3]
    leaves = [r.lines for r in rows if r.level == 0]
    assert total == [sum(leaves)] == [4]


def test_histogram_single_value_goes_to_bin_zero(spark):
    dc = spark.createDataFrame([(1,), (1,)], "total_orders long")
    rows = marts.total_orders_histogram(dc).collect()
    assert [(r.bin, r.customers) for r in rows] == [(0, 2)]


@pytest.mark.parametrize("width", [1, 2, 3, 4096])
def test_running_sum_equals_plain_window(spark, width):
    rnd = random.Random(width)
    rows = []
    for user in range(6):
        n = 1 if user == 0 else rnd.randint(1, 40) * (10 if user == 5 else 1)
        for i in range(n):
            num = rnd.choice([None, rnd.randint(1, 12)]) if user == 3 else rnd.randint(1, 60)
            rows.append((i + 1000 * user, user, num, rnd.randint(0, 30)))
    df = spark.createDataFrame(rows, "id long, user long, num int, days int")
    w = Window.partitionBy("user").orderBy(F.asc_nulls_last("num")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    expected = {r.id: r.s for r in df.select("id", F.sum("days").over(w).alias("s")).collect()}
    got = {r.id: r.s for r in silver.running_sum(df, "user", "num", "days", "s", width).select("id", "s").collect()}
    assert got == expected


def test_duplicate_staged_orders_double_total_items(spark):
    from tillroll.operators import gold

    fact = spark.createDataFrame(
        [("1", 1, 1, 1, 11, 1), ("1", 1, 1, 1, 12, 1)],
        "order_id_nk string, date_key long, customer_key long, branch_key long, product_key long, quantity int",
    )
    stg = spark.createDataFrame([(1, 3), (1, 4)], "order_id long, days_since_prior_order int")
    r = gold.fact_order_summary(fact, stg).first()
    assert (r.total_items, r.total_distinct_items, r.days_since_prior) == (4, 2, 4)


def test_derived_dimension_keys_equal_the_joins(spark):
    from pyspark.sql import functions as F

    from tests.fixtures import raw_f1
    from tillroll.operators import gold

    raw = raw_f1(spark)
    s = build_silver(raw)
    g = build_gold(raw, s)
    args = (s.stg_order_products, s.stg_orders, g.dim_date, g.dim_product, g.dim_customer, g.dim_branch)
    joined = gold.fact_order_line(*args, derived_dims=False)
    derived = gold.fact_order_line(*args, derived_dims=True)
    assert joined.exceptAll(derived).count() == 0 and derived.exceptAll(joined).count() == 0
    assert joined.count() == 4


@pytest.mark.parametrize("members, expected", [(0, 0), (1, 4), (2, 8)])
def test_default_branch_members_behave_like_the_inner_join(spark, members, expected):
    from tests.fixtures import raw_f1
    from tillroll import schemas as S
    from tillroll.operators import gold

    raw = raw_f1(spark)
    s = build_silver(raw)
    g = build_gold(raw, s)
    seed = [(f"B{i}" if i >= members else "DEFAULT_BRANCH", f"n{i}", "c", "r") for i in range(3)]
    branches = gold.dim_branch(spark.createDataFrame(seed, S.BRANCH_SEED))
    fact = gold.fact_order_line(
        s.stg_order_products, s.stg_orders, g.dim_date, g.dim_product, g.dim_customer, branches,
        derived_dims=True,
    )
    assert fact.count() == expected


@pytest.mark.parametrize("duplicate", [False, True])
def test_top_customers_aggregate_first_equals_join_first(layers, duplicate):
    _, _, g = layers
    dc = g.dim_customer.unionByName(g.dim_customer.limit(1)) if duplicate else g.dim_customer
    star = marts.star(g.fact_order_line, g.dim_product, g.dim_branch, g.dim_date)
    got = {tuple(r) for r in marts.top_customers(star, dc).collect()}
    joined = marts.star(g.fact_order_line, g.dim_product, g.dim_branch, g.dim_date, dc).joined
    expected = {
        tuple(r)
        for r in joined.groupBy("user_id_nk", "membership_tier")
        .agg(
            F.countDistinct("order_id_nk").alias("orders"),
            F.count(F.lit(1)).alias("lines"),
            F.sum("quantity").cast("long").alias("quantity"),
        )
        .collect()
    }
    assert got == expected
