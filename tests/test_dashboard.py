"""The dashboard pages over a persisted fixture warehouse."""

from tests.fixtures import write_f1_csv
from tillroll.plans import mining
from tillroll.plans.dashboard import Dashboard
from tillroll.plans.etl import WarehousePaths, run_stage
from tillroll.sources.files import csv_sources


def test_pages(spark, scratch):
    raw_dir, seed = write_f1_csv(scratch)
    paths = WarehousePaths(str(scratch / "wh"))
    run_stage(spark, csv_sources(spark, raw_dir, seed), paths, "all")
    out = str(scratch / "dm")
    rd = lambda t: spark.read.parquet(paths.table(t))
    mining.run_mining_job(
        rd("fact_order_line"), rd("dim_product"), out,
        mining.MiningParams(min_support=0.3, min_confidence=0.1, min_lift=0.1),
    )
    d = Dashboard(spark, paths, out)

    ov = d.overview(dows=["Monday", "Saturday"])
    assert ov["kpis"].first().order_lines == 4
    assert [r.orders for r in ov["orders_by_weekday"].collect()] == [2, 0, 0, 0, 0, 1, 0]
    assert d.overview(departments=["Dairy Eggs"])["kpis"].first().order_lines == 1
    assert d.products()["top_products"].count() == 3
    assert d.customers()["top_customers"].count() == 2
    mb = d.market_basket()
    assert mb["rules"].count() == 2 and mb["thresholds"].count() == 3
    assert {r.metric for r in mb["metric_ranges"].collect()} == {"support", "confidence", "lift"}
    log = d.etl_log(statuses=["SUCCESS"])
    assert log["kpis"].first().success_runs == 1 and log["detail"].count() == 1
    assert d.headline().first().lines == 4
    assert Dashboard(spark, paths, str(scratch / "missing")).market_basket()["rules"].count() == 0
