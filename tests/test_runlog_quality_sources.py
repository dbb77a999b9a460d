"""Run-log views (A16-A19, S7), quality checks with planted faults, and
file sources/sinks (S2, S11, S13)."""

import pytest
from pyspark.sql import functions as F

from tests.fixtures import log_f6, raw_f1
from tillroll import schemas as S
from tillroll.operators import quality as q
from tillroll.operators import runlog as rl
from tillroll.plans.layers import build_gold, build_silver
from tillroll.sources import files
from tillroll.sources import incremental as inc


def test_watermark_ignores_failed_runs(spark):
    assert inc.read_watermark(log_f6(spark)).first().watermark == 120
    empty = spark.createDataFrame([], S.ETL_LOG)
    assert inc.read_watermark(empty).first().watermark == 0


def test_recent_runs_nulls_last_and_kpis(spark):
    runs = rl.recent_runs(log_f6(spark))
    assert [r.run_id for r in runs.collect()] == ["r5", "r4", "r2", "r1", "r3"]
    k = rl.run_kpis(runs).first()
    assert (k.total_runs, k.success_runs, k.failed_runs, k.success_rate_pct) == (5, 3, 2, 60.0)
    empty = rl.run_kpis(spark.createDataFrame([], S.ETL_LOG)).first()
    assert (empty.total_runs, empty.success_rate_pct) == (0, 0.0)


def test_timeline_and_filter(spark):
    runs = rl.recent_runs(log_f6(spark))
    t = rl.run_timeline(runs).collect()
    assert [r.run_id for r in t] == ["r1", "r2", "r4", "r5"]
    assert t[1].finished_at == t[1].started_at
    f = rl.filter_runs(runs, stages=["bronze"], statuses=["FAILED"]).collect()
    assert [r.run_id for r in f] == ["r4"]
    assert rl.filter_runs(runs).count() == 5


def test_quality_checks_find_planted_faults(spark):
    raw = raw_f1(spark)
    g = build_gold(raw, build_silver(raw))
    extra = g.fact_order_line.limit(1).withColumn("product_key", F.lit(42).cast("long"))
    fact = g.fact_order_line.unionByName(extra)
    orphans = {r.fk: r.orphan_rows for r in q.fk_orphans(fact, {"product": (g.dim_product, "product_key")}).collect()}
    assert orphans == {"product": 1}
    dup = g.fact_order_line.unionByName(g.fact_order_line.limit(1))
    assert q.duplicate_grain(dup, ["order_id_nk", "product_key", "add_to_cart_order"]).count() == 1
    assert q.default_member(g.dim_branch).first().ok is True
    two = g.dim_branch.unionByName(g.dim_branch)
    assert q.default_member(two).first().ok is False
    prof = {(r.metric, r.label): r.value for r in q.distribution_profile(g.fact_order_line, g.dim_customer).collect()}
    assert prof[("customers_per_tier", "Platinum")] == 0 and prof[("customers_per_tier", "Silver")] == 2
    assert prof[("reordered_true", "all")] == 1 and prof[("reordered_false", "all")] == 3


def test_missing_columns_detects_drift(spark):
    tables = {"dim_branch": spark.createDataFrame([("x",)], "branch_id_nk string")}
    missing = q.missing_columns(tables, {"dim_branch": ["branch_key", "branch_id_nk"]})
    assert missing == [("dim_branch", "branch_key")]


def test_sample_rows_rejects_non_positive(spark):
    with pytest.raises(ValueError):
        inc.sample_rows(spark.range(3), 0, ["id"])
    assert [r.id for r in inc.sample_rows(spark.range(10), 3, ["id"]).collect()] == [0, 1, 2]


def test_key_consistent_sample_keeps_joins_non_empty(spark):
    orders = spark.range(2000).withColumnRenamed("id", "order_id")
    lines = orders.select("order_id", (F.col("order_id") % 50).alias("product_id"))
    products = spark.range(50).withColumnRenamed("id", "product_id")
    so, sl, sp = inc.key_consistent_sample(orders, lines, products, 0.1)
    assert 100 < so.count() < 300
    assert sl.join(so, "order_id", "left_anti").count() == 0
    assert sl.join(sp, "product_id", "left_anti").count() == 0


def test_result_csv_roundtrip_and_missing(spark, scratch):
    path = str(scratch / "bundles")
    missing = files.read_result_csv(spark, path, S.BUNDLES)
    assert missing.count() == 0 and missing.columns == [f.name for f in S.BUNDLES]
    df = spark.createDataFrame([("A", "B", 0.5, 0.6, 1.2, "Bundle A with B for cross-sell.")], S.BUNDLES)
    files.write_result_csv(df, path)
    back = files.read_result_csv(spark, path, S.BUNDLES).collect()
    assert back[0].recommended_product == "B" and back[0].lift == 1.2


def test_csv_reads_quotes_and_columns_by_name(spark, scratch):
    import pytest
    from tillroll import schemas as S
    from tillroll.sources.files import _exists, header_columns, read_csv_source

    path = scratch / "products.csv"
    path.write_text(
        'department_id,note,product_name,product_id,aisle_id\n3,x,"Say ""Cheese"", Mild",1,40\n4,,Plain,2,41\n'
    )
    rows = read_csv_source(spark, str(path), S.BRONZE_PRODUCTS).orderBy("product_id").collect()
    assert [(r.product_id, r.product_name, r.aisle_id, r.department_id) for r in rows] == [
        (1, 'Say "Cheese", Mild', 40, 3), (2, "Plain", 41, 4)
    ]
    assert q.source_drift({"products": header_columns(spark, str(path))}, {"products": S.BRONZE_PRODUCTS.names}) == [
        ("products", "note", "unexpected")
    ]
    path.write_text("product_id,product_name,aisle_id\n1,a,2\n")
    with pytest.raises(ValueError, match="department_id"):
        read_csv_source(spark, str(path), S.BRONZE_PRODUCTS)
    path.write_text("product_id,product_name,aisle_id,department_id\nx9,a,2,3\n")
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|Malformed"):
        read_csv_source(spark, str(path), S.BRONZE_PRODUCTS).collect()
    assert _exists(spark, str(path)) and _exists(spark, f"file:{path}") and _exists(spark, f"file://{path}")
    assert not _exists(spark, f"file:{path}-not")
