"""Persisted Bronze -> Silver -> Gold run with the run log."""

from pyspark.sql import functions as F

from tests.fixtures import ORDERS, write_f1_csv
from tillroll import schemas as S
from tillroll.operators import quality as q
from tillroll.plans.etl import WarehousePaths, read_bronze_orders, run_stage
from tillroll.sources.files import csv_sources
from tillroll.sources.runlog import read_log


def test_clean_run_then_rerun(spark, scratch):
    raw_dir, seed = write_f1_csv(scratch)
    raw = csv_sources(spark, raw_dir, seed)
    paths = WarehousePaths(str(scratch / "wh"))

    first = run_stage(spark, raw, paths, "all")
    assert first["watermark"] == 3
    assert first["rows_loaded"] == 3 + 4 + 4  # bronze orders + staged lines + fact lines
    fact_rows = spark.read.parquet(paths.table("fact_order_line")).count()
    assert fact_rows == 4

    second = run_stage(spark, raw, paths, "all")
    assert second["rows_loaded"] == 0 + 4 + 4
    assert read_bronze_orders(spark, paths).count() == 3
    assert spark.read.parquet(paths.table("fact_order_line")).count() == fact_rows

    log = read_log(spark, paths.log)
    assert log.where(F.col("status") == "SUCCESS").count() == 2
    assert q.missing_tables(spark, list(S.GOLD_CONTRACT) + list(S.BRONZE_TABLES), paths.root) == []
    tables = {n: spark.read.parquet(paths.table(n)) for n in S.GOLD_CONTRACT}
    assert q.missing_columns(tables, S.GOLD_CONTRACT) == []


def test_late_ids_below_watermark_are_ignored(spark, scratch):
    raw_dir, seed = write_f1_csv(scratch)
    paths = WarehousePaths(str(scratch / "wh"))
    run_stage(spark, csv_sources(spark, raw_dir, seed), paths, "bronze")
    # a late order (id 2.5 -> 0 < wm) and a new one arrive
    more = ORDERS + [(0, 12, "prior", 1, 1, 9, None), (4, 12, "prior", 1, 3, 8, None)]
    raw_dir2, seed2 = write_f1_csv(scratch / "again", more)
    res = run_stage(spark, csv_sources(spark, raw_dir2, seed2), paths, "bronze")
    ids = sorted(r.order_id for r in read_bronze_orders(spark, paths).collect())
    assert ids == [1, 2, 3, 4] and res["rows_loaded"] == 1 and res["watermark"] == 4


def test_failed_run_is_logged_and_reraised(spark, scratch):
    raw_dir, seed = write_f1_csv(scratch)
    paths = WarehousePaths(str(scratch / "wh"))
    raw = csv_sources(spark, raw_dir, seed)
    try:
        run_stage(spark, raw, paths, "all", sample_rows=0)
    except ValueError as exc:
        assert "sample_rows must be > 0" in str(exc)
    else:
        raise AssertionError("expected ValueError")
    row = read_log(spark, paths.log).first()
    assert row.status == "FAILED" and row.message.startswith("sample_rows")


def test_sample_rows_limits_each_source(spark, scratch):
    raw_dir, seed = write_f1_csv(scratch)
    paths = WarehousePaths(str(scratch / "wh"))
    run_stage(spark, csv_sources(spark, raw_dir, seed), paths, "bronze", sample_rows=1)
    assert read_bronze_orders(spark, paths).count() == 1
    assert spark.read.parquet(paths.table("bronze_products")).count() == 1


def test_retried_load_rewrites_its_own_folder(spark, scratch):
    from tillroll.plans.etl import run_bronze

    raw_dir, seed = write_f1_csv(scratch)
    raw = csv_sources(spark, raw_dir, seed)
    paths = WarehousePaths(str(scratch / "wh"))
    run_bronze(spark, raw, paths, "run-a")  # wrote its folder, then "failed" before logging
    rows, wm = run_bronze(spark, raw, paths, "run-a")  # the retry under the same load id
    ids = sorted(r.order_id for r in read_bronze_orders(spark, paths).collect())
    assert ids == [1, 2, 3] and (rows, wm) == (3, 3)
    # a new run sees run-a's rows as already loaded
    run_bronze(spark, raw, paths, "run-b")
    assert read_bronze_orders(spark, paths).count() == 3


def test_register_views_for_sql(spark, scratch):
    from tillroll.plans.etl import register_views

    raw_dir, seed = write_f1_csv(scratch)
    paths = WarehousePaths(str(scratch / "wh"))
    run_stage(spark, csv_sources(spark, raw_dir, seed), paths, "all")
    names = register_views(spark, paths)
    assert {"fact_order_line", "dim_product", "etl_log", "bronze_orders"} <= set(names)
    loaded = spark.sql("select sum(rows_loaded) as n from etl_log").first().n
    joined = spark.sql(
        "select count(distinct l.order_id_nk) as orders, sum(s.total_items) as items "
        "from fact_order_line l left join fact_order_summary s using (order_id_nk)"
    ).first()
    assert loaded == 11 and joined.orders == spark.table("fact_order_summary").count() and joined.items >= 4


def test_bucketed_layout_same_rows_no_shuffle_in_line_join(spark, scratch):
    import uuid

    from tillroll.operators import gold
    from tillroll.plans.etl import _read

    raw_dir, seed = write_f1_csv(scratch)
    raw = csv_sources(spark, raw_dir, seed)
    db = "tillroll_t_" + uuid.uuid4().hex[:8]
    plain = WarehousePaths(str(scratch / "plain"))
    bucketed = WarehousePaths(str(scratch / "bucketed"), bucket_count=8, database=db)
    run_stage(spark, raw, plain, "all")
    run_stage(spark, raw, bucketed, "all")
    assert spark.catalog.tableExists(f"{db}.fact_order_line")
    for name in ("stg_orders", "stg_order_products", "fact_order_line", "fact_order_summary"):
        a, b = _read(spark, plain, name), _read(spark, bucketed, name)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0

    rd = lambda n: _read(spark, bucketed, n)
    fact = gold.fact_order_line(
        rd("stg_order_products"), rd("stg_orders"), rd("dim_date"), rd("dim_product"),
        rd("dim_customer"), rd("dim_branch"), derived_dims=True,
    )
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        import contextlib
        import io

        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            fact.explain("simple")
        plan = buf.getvalue()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert not any("order_id" in line for line in exchanges), exchanges


def test_first_load_takes_every_key(spark, scratch):
    early = ORDERS + [(0, 12, "prior", 1, 1, 9, None), (-4, 13, "prior", 1, 2, 9, None)]
    raw_dir, seed = write_f1_csv(scratch, early)
    paths = WarehousePaths(str(scratch / "wh"))
    res = run_stage(spark, csv_sources(spark, raw_dir, seed), paths, "bronze", run_id="r1")
    assert sorted(r.order_id for r in read_bronze_orders(spark, paths).collect()) == [-4, 0, 1, 2, 3]
    assert (res["rows_loaded"], res["watermark"]) == (5, 3)
    # The same run again, by its id: one log row, the same rows.
    again = run_stage(spark, csv_sources(spark, raw_dir, seed), paths, "bronze", run_id="r1")
    assert again["rows_loaded"] == 5 and read_log(spark, paths.log).count() == 1
    assert read_bronze_orders(spark, paths).count() == 5


def test_late_keys_can_be_accepted(spark):
    from tillroll.sources.incremental import incremental_rows

    source = spark.createDataFrame([(1,), (2,), (5,), (9,), (None,)], "order_id long")
    target = spark.createDataFrame([(2,), (9,)], "order_id long")
    ids = lambda **kw: sorted(r.order_id for r in incremental_rows(source, target, 4, **kw).collect())
    assert ids() == [5] and ids(late="accept") == [1, 5]


def test_quality_gate_flags_planted_faults(spark, scratch):
    from tillroll.plans.etl import _read, _write, run_quality_gate

    raw_dir, seed = write_f1_csv(scratch)
    paths = WarehousePaths(str(scratch / "wh"))
    run_stage(spark, csv_sources(spark, raw_dir, seed), paths, "all")
    assert run_quality_gate(spark, paths) == []
    branch = _read(spark, paths, "dim_branch")
    _write(spark.createDataFrame(branch.collect() * 2, branch.schema), paths, "dim_branch")
    fact = _read(spark, paths, "fact_order_line")
    rows = fact.collect()
    _write(spark.createDataFrame(rows + [rows[0].asDict() | {"product_key": 42}], fact.schema), paths, "fact_order_line")
    assert sorted(run_quality_gate(spark, paths)) == [
        "5 fact lines for 4 staged lines",
        "dim_branch must hold exactly one DEFAULT_BRANCH row",
        "orphan product keys: 1",
    ]


def test_a_failed_write_leaves_the_table(spark, scratch):
    import pytest

    from tillroll.sources.files import write_table

    path = str(scratch / "t" / "load_id=a")
    write_table(spark.range(3).toDF("v"), path)
    with pytest.raises(Exception, match="broken"):
        write_table(spark.range(5).selectExpr("IF(id = 4, raise_error('broken'), id) AS v"), path)
    assert spark.read.parquet(path).count() == 3
    write_table(spark.range(7).toDF("v"), path)
    assert spark.read.parquet(path).count() == 7
    assert spark.read.parquet(str(scratch / "t")).count() == 7  # nothing else is listed
