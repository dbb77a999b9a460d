"""Properties from the test strategy: threshold monotonicity of the rule
count, and cross-query consistency of the dashboard marts."""

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tillroll.functions.dates import DOW_ORDER
from tillroll.operators import baskets as bk
from tillroll.operators import marts
from tillroll.operators import rules as rl
from tillroll.plans.registry import warehouse

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("seed", [7, 8])
def test_rule_count_is_monotone_in_support(spark, seed):
    rnd = random.Random(seed)
    items = list("ABCDEFGH")
    rows = [(str(i), x) for i in range(120) for x in rnd.sample(items, rnd.randint(2, 5))]
    b = bk.baskets(spark.createDataFrame(rows, "order_id_nk string, product_name string"))
    supports = [0.02, 0.05, 0.1, 0.2, 0.4]
    t = rl.compare_thresholds(b, supports, min_confidence=0.2, min_lift=0.5)
    counts = [r.rule_count for r in t.orderBy("min_support").collect()]
    assert counts == sorted(counts, reverse=True) and counts[0] > 0


@pytest.mark.skipif(not Path(SF).exists(), reason="driver test data not present")
def test_marts_agree_with_each_other(spark):
    w = warehouse(spark, SF)
    star = w.star
    k = marts.kpis(star).first()
    heat = marts.department_weekday_heatmap(star).agg(*[F.sum(d).alias(d) for d in DOW_ORDER]).first()
    assert sum(heat) == k.order_lines
    rollup = {r.level: r.lines for r in marts.department_aisle_rollup(star).where("level = 3").collect()}
    assert rollup[3] == k.order_lines
    items = marts.daily_trend(star).agg(F.sum("items")).first()[0]
    assert items == k.total_items
    depts = marts.top_departments(star, n=100).agg(F.sum("lines")).first()[0]
    assert depts == k.order_lines
    summary_rows = w.gold.fact_order_summary.count()
    assert summary_rows == k.orders
    tiers = marts.tier_distribution(w.gold.dim_customer).agg(F.sum("customers"), F.sum("share")).first()
    assert tiers[0] == w.gold.dim_customer.count() and abs(tiers[1] - 1.0) < 1e-5
    hist = marts.total_orders_histogram(w.gold.dim_customer).agg(F.sum("customers")).first()[0]
    assert hist == tiers[0]
