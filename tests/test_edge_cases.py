"""edge cases not covered by the reference's own fixture."""

import datetime as dt

from pyspark.sql import functions as F

from tests.fixtures import AISLES, BRANCHES, DEPARTMENTS
from tillroll import schemas as S
from tillroll.operators import baskets as bk
from tillroll.operators import quality as q
from tillroll.operators import rules as rl
from tillroll.plans.layers import build_gold, build_silver
from tillroll.sources.adapter import RawSources


def _raw(spark, orders, prior, train, products):
    return RawSources(
        orders=spark.createDataFrame(orders, S.BRONZE_ORDERS),
        order_products_prior=spark.createDataFrame(prior, S.BRONZE_ORDER_PRODUCTS),
        order_products_train=spark.createDataFrame(train, S.BRONZE_ORDER_PRODUCTS),
        products=spark.createDataFrame(products, S.BRONZE_PRODUCTS),
        aisles=spark.createDataFrame(AISLES, S.BRONZE_AISLES),
        departments=spark.createDataFrame(DEPARTMENTS, S.BRONZE_DEPARTMENTS),
        branches=spark.createDataFrame(BRANCHES, S.BRANCH_SEED),
    )


ORDERS = [
    (1, 10, "prior", 1, 1, 10, None),
    (2, 10, "prior", 2, 2, 10, 4.0),
    (3, 10, "prior", 2, 3, 10, 2.5),   # tied order_number; 2.5 rounds half-even to 2
    (4, 10, "prior", 3, 3, 10, 3.5),   # 3.5 rounds to 4
    (None, 10, "prior", 4, 3, 10, 1.0),  # null key: dropped
    (5, None, "prior", 1, 3, 10, 1.0),   # null user: dropped
]
PRODUCTS = [
    (101, "  Organic Banana  ", 1, 1),
    (102, "Milk, 1L", 2, 2),
    (103, "Fresh Apple", 9, 1),  # unknown aisle: dropped from dim_product
    (None, "Ghost", 1, 1),
]
PRIOR = [(1, 101, 1, 0), (2, 101, 1, 1), (2, 102, 2, 0), (None, 101, 1, 0)]
TRAIN = [(2, 101, 1, 1), (4, 103, 1, 0), (3, 102, 1, 1)]  # first row duplicates a prior line


def test_silver_edge_cases(spark):
    s = build_silver(_raw(spark, ORDERS, PRIOR, TRAIN, PRODUCTS))
    dates = {r.order_id: r.synthetic_order_date for r in s.stg_orders.collect()}
    # gaps 0, 4, 2 (tie with order 2 -> both get 0+4+2), 4
    assert dates == {
        1: dt.date(2024, 1, 1),
        2: dt.date(2024, 1, 7),
        3: dt.date(2024, 1, 7),
        4: dt.date(2024, 1, 11),
    }
    lines = sorted(tuple(r) for r in s.stg_order_products.collect())
    assert lines == [(1, 101, 1, 0), (2, 101, 1, 1), (2, 102, 2, 0), (3, 102, 1, 1), (4, 103, 1, 0)]
    names = {r.product_id: r.product_name for r in s.stg_products.collect()}
    assert names == {101: "Organic Banana", 102: "Milk, 1L", 103: "Fresh Apple"}


def test_unknown_aisle_drops_lines_and_q5_reports_it(spark):
    raw = _raw(spark, ORDERS, PRIOR, TRAIN, PRODUCTS)
    s = build_silver(raw)
    g = build_gold(raw, s)
    assert sorted(r.product_id_nk for r in g.dim_product.collect()) == ["101", "102"]
    r = q.row_count_match(g.fact_order_line, s.stg_order_products).first()
    assert (r.fact_rows, r.staged_rows, r.matches) == (4, 5, False)


def test_comma_in_name_is_not_a_bundle_by_text_rule(spark):
    items = spark.createDataFrame(
        [(str(i), n) for i in range(4) for n in ("Bread", "Milk, 1L")] + [("9", "Solo")],
        "order_id_nk string, product_name string",
    )
    ranked = rl.mine_rules(bk.baskets(items), min_support=0.5, min_confidence=0.5, min_lift=0.5, top_n=None)
    got = {(r.antecedents, r.consequents) for r in ranked.collect()}
    assert got == {("Bread", "Milk, 1L"), ("Milk, 1L", "Bread")}
    by_text = {r.recommended_product for r in rl.bundle_recommendations(ranked).collect()}
    by_size = {r.recommended_product for r in rl.bundle_recommendations(ranked, text_rule=False).collect()}
    assert by_text == {"Bread"} and by_size == {"Bread", "Milk, 1L"}


def test_one_item_baskets_count_in_summary_not_in_mining(spark):
    items = spark.createDataFrame(
        [("1", "A"), ("1", "B"), ("2", "A"), ("3", " A "), ("3", "")], "order_id_nk string, product_name string"
    )
    s = {r.metric: r.value for r in bk.summarize_baskets(items).where(F.col("section") == "overall").collect()}
    assert s["basket_count"] == 3 and s["order_product_rows"] == 4 and s["median_basket_size"] == 1.0
    assert bk.baskets(items).count() == 1
