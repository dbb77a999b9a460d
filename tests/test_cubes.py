"""Distinct counts from stored bitmaps against plain ones."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tests.fixtures import write_f1_csv
from tillroll.operators import cubes, marts
from tillroll.plans.etl import WarehousePaths, _read, _write, read_star, run_aggregates, run_stage
from tillroll.sources.files import csv_sources


@pytest.fixture(scope="module")
def star(spark):
    rng = random.Random(5)
    lines = [
        (str(o) if o % 97 else None, o % 1000 + 10**12, rng.randint(1, 41), o % 13, rng.choice([1, 2]), True, 1)
        for o in range(3000)
        for _ in range(rng.randint(1, 4))
    ]
    fact = spark.createDataFrame(lines, "order_id_nk string, customer_key long, product_key long, date_key long, branch_key long, reordered boolean, quantity int")
    product = spark.createDataFrame(
        [(p, str(p), f"p{p}", f"a{p % 7}", None if p % 9 == 0 else f"d{p % 5}", False) for p in range(1, 40)],
        "product_key long, product_id_nk string, product_name string, aisle_name string, department_name string, is_organic boolean",
    )
    branch = spark.createDataFrame([(1, "A"), (2, "B")], "branch_key long, branch_name string")
    date = spark.createDataFrame([(d, f"2024-01-{d + 1:02d}", ["Monday", "Friday", "Sunday"][d % 3]) for d in range(12)], "date_key long, full_date string, day_of_week string")
    plain = marts.star(fact, product, branch, date)
    cube = cubes.distinct_cube(fact, product).cache()
    return plain, marts.star(fact, product, branch, date, counts=cubes.line_counts(fact), cube=cube)


@pytest.mark.parametrize(
    "filters",
    [marts.NO_FILTER, marts.Filters(departments=("d1", "d2")), marts.Filters(dows=("Monday",), branches=("B",)), marts.Filters(departments=("none",))],
)
def test_marts_agree(star, filters):
    for mart in (marts.kpis, marts.orders_by_weekday, marts.daily_trend):
        plain, stored = ([tuple(r) for r in mart(s, filters).collect()] for s in star)
        assert plain == stored


def test_headline_agrees(spark, star):
    log = spark.createDataFrame([("SUCCESS", None)], "status string, finished_at timestamp")
    plain, stored = star
    want = marts.headline_stats(plain.fact, plain.product, log).first()
    assert marts.headline_stats(plain.fact, plain.product, log, stored).first() == want



def test_numbers_are_dense_and_ordered(spark):
    rows = [(f"v{n}", n % 17) for n in range(2000)] + [(None, 1), ("v3", 3)]
    out = cubes.dense_numbers(spark.createDataFrame(rows, "v string, d int").repartition(9), "v", ["d"]).orderBy("number").collect()
    assert [r.number for r in out] == list(range(2000))
    days = [int(r.v[1:]) % 17 for r in out]
    assert days == sorted(days)
    assert cubes.dense_numbers(spark.createDataFrame([], "v string"), "v", []).count() == 0


def test_aggregates_hold_for_their_fact_only(spark, scratch):
    raw_dir, seed = write_f1_csv(scratch)
    paths = WarehousePaths(str(scratch / "wh"))
    run_stage(spark, csv_sources(spark, raw_dir, seed), paths, "all", with_quality=False)
    assert read_star(spark, paths).cube is None
    run_aggregates(spark, paths)
    star = read_star(spark, paths)
    assert star.cube is not None
    assert marts.kpis(star).first() == marts.kpis(marts.star(star.fact, star.product, star.branch, star.date)).first()
    _write(_read(spark, paths, "fact_order_line").where(F.lit(True)), paths, "fact_order_line")
    assert read_star(spark, paths).cube is None  # another fact


def test_bitmaps_are_made_once_numbers_are_together(star):
    """A bitmap is 4 KB even of one number: none is made before the last shuffle."""
    plain, _ = star
    cube = cubes.distinct_cube(plain.fact, plain.product)
    steps = cube._jdf.queryExecution().executedPlan().toString().splitlines()
    first = [n for n, line in enumerate(steps) if "partial_bitmap_construct_agg" in line]
    assert len(first) == 2
    for n in first:
        last = max(k for k in range(n) if "bitmap_construct_agg" in steps[k])
        assert not any("Exchange" in line for line in steps[last:n])


def test_stored_aggregates_are_built_when_first_read(star):
    plain, stored = star
    built = []

    def once(name, df):
        return lambda: built.append(name) or df

    lazy = marts.star(plain.fact, plain.product, plain.branch, plain.date, counts=once("counts", stored.counts), cube=once("cube", stored.cube))
    assert marts.top_departments(lazy).collect() == marts.top_departments(stored).collect()
    assert built == ["counts"]
    assert marts.kpis(lazy).first() == marts.kpis(stored).first()
    assert built == ["counts", "cube"]


def test_cube_of_odd_rows(spark):
    """Null keys, one order under two customers and dates, lines twice."""
    lines = [("a", 1, 1, 1, 1), ("a", 1, 1, 1, 1), ("a", 2, 1, 2, 1), (None, 2, 2, 1, 1), ("b", None, 9, 1, 1), ("c", 3, 2, None, 1)]
    fact = spark.createDataFrame(lines, "order_id_nk string, customer_key long, product_key long, date_key long, branch_key long")
    product = spark.createDataFrame([(1, "d"), (1, "d"), (2, None)], "product_key long, department_name string")
    cube = cubes.distinct_cube(fact, product)
    places = ["department_name", "known", "date_key"]
    found = {k: {tuple(r) for r in cubes.distinct_counts(cube, places, k).collect()} for k in ("order", "customer")}
    assert found["order"] == {("d", True, 1, 1), ("d", True, 2, 1), (None, False, 1, 1), (None, True, None, 1)}
    assert found["customer"] == {("d", True, 1, 1), ("d", True, 2, 1), (None, True, 1, 1), (None, True, None, 1)}
    totals = spark.range(1).select(*[cubes.distinct_total(cube, k) for k in ("order", "customer")]).first()
    assert tuple(totals) == (3, 3)
