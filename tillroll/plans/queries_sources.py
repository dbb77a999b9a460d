"""Registered source, incremental-load and run-log queries (S, A16-A19)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tillroll import schemas as S
from tillroll.operators import marts, quality
from tillroll.operators import runlog as rl
from tillroll.plans.etl import WarehousePaths, _read, _write, published, read_bronze_orders, write_load
from tillroll.plans.oracle import k1, with_warehouse
from tillroll.plans.registry import register, warehouse
from tillroll.session import ensure_checkpoint_dir
from tillroll.sources import checked, files
from tillroll.sources import incremental as inc
from tillroll.sources.adapter import read_table
from tillroll.sources.runlog import append_log, log_row, read_log

# Fixed values of the registered scenarios.
SAMPLE_N = 1000
SAMPLE_FRACTION = 0.1
LOADED_DOWS = (1, 2, 3, 4, 5)  # the target already holds the weekday orders
RUN_STAGES = ("error", "purchase", "view")
RUN_STATUSES = ("SUCCESS",)


def _target(w):
    return w.raw.orders.where(F.col("order_dow").isin(list(LOADED_DOWS)))


def _watermark(w):
    return inc.read_watermark(w.log).select("watermark").scalar()


_TARGET_SQL = f"b_target AS (SELECT * FROM b_orders WHERE order_dow IN {LOADED_DOWS})"
_WM_SQL = "(SELECT coalesce(max(watermark_order_id), 0) FROM etl_log WHERE status = 'SUCCESS')"
_NEW_ROWS_SQL = f"""b_new AS (
  SELECT s.* FROM b_orders s
  WHERE CAST(s.order_id AS BIGINT) > {_WM_SQL}
    AND NOT EXISTS (SELECT 1 FROM b_target t WHERE CAST(t.order_id AS BIGINT) = CAST(s.order_id AS BIGINT))
)"""


def _scratch(spark) -> str:
    """A new folder on shared storage for results that a query writes and reads back."""
    return f"{ensure_checkpoint_dir(spark)}/query-{uuid.uuid4().hex}"


@register("s1_scan_lines", with_warehouse("SELECT * FROM b_prior UNION ALL SELECT * FROM b_train"))
def s1(spark, sf):
    """Every line as a header CSV, columns in another order, scanned by name."""
    raw = warehouse(spark, sf).raw
    path = f"{_scratch(spark)}/lines"
    lines = raw.order_products_prior.unionByName(raw.order_products_train)
    files.write_result_csv(lines.select(*reversed(lines.columns)), path)
    return files.read_csv_source(spark, path, S.BRONZE_ORDER_PRODUCTS)


# Role sources as text files; types by form in the SQL, by the masks in Spark.
_TYPED_ROLES = {"b_orders": "orders", "b_prior": "order_products_prior", "b_products": "products", "b_departments": "departments"}
_FORMS = [("boolean", "(true|false)"), ("bigint", "-?[0-9]+"), ("double", r"-?[0-9]+(\.[0-9]+)?"), ("date", "[0-9]{4}-[0-9]{2}-[0-9]{2}")]


def _types_sql(role: str) -> str:
    cases = " ".join(f"WHEN bool_and(regexp_full_match(value, '{form}')) THEN '{kind}'" for kind, form in _FORMS)
    texts = f"SELECT COLUMNS(*)::VARCHAR FROM {role}"
    return (
        f"SELECT '{_TYPED_ROLES[role]}' AS source, name AS column_name, CASE {cases} ELSE 'string' END AS type "
        f"FROM (UNPIVOT ({texts}) ON COLUMNS(*) INTO NAME name VALUE value) GROUP BY name"
    )


@register("s1_inferred_types", with_warehouse("\nUNION ALL ".join(_types_sql(role) for role in _TYPED_ROLES)))
def s1_types(spark, sf):
    """The types of four sources' columns, found from all their rows."""
    raw, path, found = warehouse(spark, sf).raw, _scratch(spark), []
    for name in _TYPED_ROLES.values():
        files.write_result_csv(getattr(raw, name), f"{path}/{name}")
        inferred = checked.infer_schema(spark, f"{path}/{name}")
        found += [(name, field.name, field.dataType.simpleString()) for field in inferred]
    return spark.createDataFrame(found, "source string, column_name string, type string")


# Faults planted into the lines: a number in words, and one with its unit.
_FAULTY = "order_id % 13 = 0"
_WITH_UNIT = "order_id % 39 = 0"


def _checked_lines(spark, sf):
    raw, path = warehouse(spark, sf).raw, f"{_scratch(spark)}/lines"
    lines = raw.order_products_prior.unionByName(raw.order_products_train)
    product, place = F.col("product_id").cast("string"), F.col("add_to_cart_order").cast("string")
    faulty = lines.select(
        F.when(F.expr(_WITH_UNIT), F.concat(product, F.lit(" pc"))).otherwise(product).alias("product_id"),
        F.when(F.expr(_FAULTY), 'some, "few').otherwise(place).alias("add_to_cart_order"),
        "order_id",
        "reordered",
    )
    files.write_result_csv(faulty, path)
    return checked.read_csv_checked(spark, path, S.BRONZE_ORDER_PRODUCTS)


@register(
    "s1_checked_rows",
    with_warehouse(f"SELECT * FROM (SELECT * FROM b_prior UNION ALL SELECT * FROM b_train) WHERE NOT ({_FAULTY})"),
)
def s1_rows(spark, sf):
    """The lines of a file with bad fields: those that fit their types."""
    return _checked_lines(spark, sf).rows


@register(
    "s1_rejected_rows",
    with_warehouse(
        f"""
SELECT product_id || CASE WHEN {_WITH_UNIT} THEN ' pc' ELSE '' END || ',"some, ""few",' || order_id || ',' || reordered AS row_text,
       CASE WHEN {_WITH_UNIT} THEN 'product_id: ''' || product_id || ' pc'' is not bigint; ' ELSE '' END
         || 'add_to_cart_order: ''some, "few'' is not int' AS reason
FROM (SELECT * FROM b_prior UNION ALL SELECT * FROM b_train) WHERE {_FAULTY}"""
    ),
)
def s1_rejects(spark, sf):
    """The others, with their text and what is wrong with them."""
    return _checked_lines(spark, sf).rejects.drop("source")


@register(
    "s2_sample_rows",
    with_warehouse(
        "SELECT * FROM (SELECT * FROM b_prior UNION ALL SELECT * FROM b_train) "
        f"ORDER BY order_id, add_to_cart_order, product_id LIMIT {SAMPLE_N}"
    ),
)
def s2(spark, sf):
    raw = warehouse(spark, sf).raw
    lines = raw.order_products_prior.unionByName(raw.order_products_train)
    return inc.sample_rows(lines, SAMPLE_N, ["order_id", "add_to_cart_order", "product_id"])


@register(
    "s3_key_consistent_sample",
    with_warehouse(
        f"""
SELECT l.* FROM (SELECT * FROM b_prior UNION ALL SELECT * FROM b_train) l
WHERE {k1("CAST(l.order_id AS VARCHAR)")} % {inc.SAMPLE_BUCKETS} < {int(SAMPLE_FRACTION * inc.SAMPLE_BUCKETS)}
  AND l.order_id IN (SELECT order_id FROM b_orders
                     WHERE {k1("CAST(order_id AS VARCHAR)")} % {inc.SAMPLE_BUCKETS} < {int(SAMPLE_FRACTION * inc.SAMPLE_BUCKETS)})"""
    ),
)
def s3(spark, sf):
    raw = warehouse(spark, sf).raw
    lines = raw.order_products_prior.unionByName(raw.order_products_train)
    _, s_lines, _ = inc.key_consistent_sample(raw.orders, lines, raw.products, SAMPLE_FRACTION)
    return s_lines


def _sampled_sql(select: str) -> str:
    kept = f"{{}} % {inc.SAMPLE_BUCKETS} < {int(SAMPLE_FRACTION * inc.SAMPLE_BUCKETS)}"
    return with_warehouse(
        select,
        f"""c_orders AS (SELECT * FROM b_orders WHERE {kept.format(k1("CAST(order_id AS VARCHAR)"))}),
c_lines AS (SELECT l.* FROM (SELECT * FROM b_prior UNION ALL SELECT * FROM b_train) l WHERE l.order_id IN (SELECT order_id FROM c_orders))""",
    )


def _sample(spark, sf):
    raw = warehouse(spark, sf).raw
    lines = raw.order_products_prior.unionByName(raw.order_products_train)
    return inc.key_consistent_sample(raw.orders, lines, raw.products, SAMPLE_FRACTION)


@register("s3_sampled_orders", _sampled_sql("SELECT * FROM c_orders"))
def s3_orders(spark, sf):
    return _sample(spark, sf)[0]


@register(
    "s3_sampled_products",
    _sampled_sql("SELECT p.* FROM b_products p WHERE p.product_id IN (SELECT product_id FROM c_lines)"),
)
def s3_products(spark, sf):
    return _sample(spark, sf)[2]


@register("s4_branch_seed", with_warehouse("SELECT * FROM b_branches"))
def s4(spark, sf):
    """The branch list as a hand-kept seed file, read from it."""
    path = f"{_scratch(spark)}/branches"
    files.write_result_csv(warehouse(spark, sf).raw.branches, path, single_file=True)
    return files.read_seed(spark, path, S.BRANCH_SEED)


@register("s5_incremental_append", with_warehouse("SELECT * FROM b_new", _TARGET_SQL + ",\n" + _NEW_ROWS_SQL))
def s5(spark, sf):
    w = warehouse(spark, sf)
    return inc.incremental_rows(w.raw.orders, _target(w), _watermark(w))


@register("s6_snapshot", with_warehouse("SELECT * FROM b_products"))
def s6(spark, sf):
    """A snapshot written twice: the second one replaces the first."""
    paths, products = WarehousePaths(_scratch(spark)), warehouse(spark, sf).raw.products
    for snapshot in (products.union(products), products):
        _write(snapshot, paths, "bronze_products")
    return _read(spark, paths, "bronze_products")


@register(
    "s5_concurrent_loads",
    with_warehouse("SELECT * FROM b_orders WHERE order_dow IN (0, 1, 2, 3) UNION SELECT * FROM b_orders WHERE order_dow IN (2, 3, 4)"),
)
def s5_concurrent(spark, sf):
    """Two loads that share two weekdays and started from the same version: the
    one that publishes last compares its keys again."""
    paths, orders = WarehousePaths(_scratch(spark)), warehouse(spark, sf).raw.orders

    def load(run_id, dows, meanwhile=lambda: None):
        def run(draft):
            target = read_bronze_orders(spark, draft, exclude_load=run_id)
            write_load(inc.incremental_rows(orders.where(F.col("order_dow").isin(dows)), target, None), draft)
            if not draft.base.number:
                meanwhile()

        published(run, spark, paths, run_id)

    load("slow", [0, 1, 2, 3], meanwhile=lambda: load("quick", [2, 3, 4]))
    return read_bronze_orders(spark, paths)


@register(
    "s5_late_accepted",
    with_warehouse(
        """
SELECT s.* FROM b_orders s
WHERE NOT EXISTS (SELECT 1 FROM b_target t WHERE CAST(t.order_id AS BIGINT) = CAST(s.order_id AS BIGINT))""",
        _TARGET_SQL,
    ),
)
def s5_late(spark, sf):
    w = warehouse(spark, sf)
    return inc.incremental_rows(w.raw.orders, _target(w), _watermark(w), late="accept")


@register("s7_watermark", with_warehouse(f"SELECT CAST({_WM_SQL} AS BIGINT) AS watermark"))
def s7(spark, sf):
    return inc.read_watermark(warehouse(spark, sf).log)


@register(
    "s9_load_counters",
    with_warehouse(
        f"""
SELECT CAST(count(*) FILTER (WHERE CAST(order_id AS BIGINT) > {_WM_SQL}) AS BIGINT) AS rows_loaded,
       CAST(coalesce(max(CAST(order_id AS BIGINT)), 0) AS BIGINT) AS watermark
FROM (SELECT * FROM b_target UNION ALL SELECT * FROM b_new)""",
        _TARGET_SQL + ",\n" + _NEW_ROWS_SQL,
    ),
)
def s9(spark, sf):
    w = warehouse(spark, sf)
    target = _target(w)
    wm = _watermark(w)
    after = target.unionByName(inc.incremental_rows(w.raw.orders, target, wm))
    return inc.load_counters(after, wm)


_LOG_COLUMNS = "run_id, stage, status, rows_loaded, watermark_order_id, message"


@register(
    "s8_run_log_append",
    with_warehouse(
        f"""
SELECT {_LOG_COLUMNS} FROM etl_log
UNION ALL SELECT 'run-a', 'bronze', 'SUCCESS', CAST(7 AS BIGINT), CAST(9 AS BIGINT), 'OK'
UNION ALL SELECT 'run-b', 'silver', 'FAILED', CAST(0 AS BIGINT), CAST(9 AS BIGINT), repeat('x', 500)"""
    ),
)
def s8(spark, sf):
    """The log and two runs' rows, one of them written twice, without the time
    stamps (which are of now)."""
    path = _scratch(spark)
    warehouse(spark, sf).log.write.parquet(f"{path}/run=before")
    for rows in (3, 7):
        append_log(log_row(spark, "run-a", "bronze", "SUCCESS", rows, 9, "OK"), path, "run-a")
    append_log(log_row(spark, "run-b", "silver", "FAILED", 0, 9, "x" * 900), path, "run-b")
    return read_log(spark, path).select(*_LOG_COLUMNS.split(", "))


@register("s10_layer_overwrite", with_warehouse("SELECT * FROM stg_products"))
def s10(spark, sf):
    """A layer table written twice: the second write replaces the first."""
    path = _scratch(spark)
    products = warehouse(spark, sf).silver.stg_products
    files.write_table(products.union(products), path)
    files.write_table(products, path)
    return spark.read.parquet(path)


@register(
    "s10_versions",
    with_warehouse(
        """
SELECT 1 AS version, s.* FROM stg_products s UNION ALL SELECT 1, s.* FROM stg_products s
UNION ALL SELECT 2, s.* FROM stg_products s"""
    ),
)
def s10_versions(spark, sf):
    """A layer table published twice, both versions read."""
    paths, products = WarehousePaths(_scratch(spark)), warehouse(spark, sf).silver.stg_products
    for rows in (products.union(products), products):
        _write(rows, paths, "stg_products")
    both = [_read(spark, paths.at(n), "stg_products").select(F.lit(n).alias("version"), "*") for n in (1, 2)]
    return both[0].unionByName(both[1])


@register(
    "s11_result_csv",
    with_warehouse(
        "SELECT department_name, aisle_name, count(*) AS lines FROM star GROUP BY department_name, aisle_name"
    ),
)
def s11(spark, sf):
    """A result written as header CSV and scanned back."""
    path = f"{_scratch(spark)}/lines_by_aisle"
    counts = marts.department_aisle_rollup(warehouse(spark, sf).star).where("level = 0").drop("level")
    files.write_result_csv(counts, path)
    return files.read_result_csv(spark, path, counts.schema)


@register(
    "s13_result_scan",
    with_warehouse("SELECT membership_tier, count(*) AS customers FROM dim_customer GROUP BY membership_tier"),
)
def s13(spark, sf):
    """A written result scanned back, with one that was never written (an empty
    frame of the same schema)."""
    path = _scratch(spark)
    tiers = marts.tier_distribution(warehouse(spark, sf).gold.dim_customer).select("membership_tier", "customers")
    files.write_result_csv(tiers, f"{path}/tiers", single_file=True)
    found = files.read_result_csv(spark, f"{path}/tiers", tiers.schema)
    return found.unionByName(files.read_result_csv(spark, f"{path}/none", tiers.schema))


# Columns the adapter reads, and two that no table has.
_NEEDED = {
    "orders": ["o_orderkey", "o_custkey", "o_orderdate", "o_channel"],
    "lineitem": ["l_orderkey", "l_partkey", "l_linenumber", "l_returnflag", "l_linestatus"],
    "part": ["p_partkey", "p_name", "p_brand", "p_type", "p_aisle"],
}
_NEEDED_SQL = ", ".join(f"('{t}', '{c}')" for t, cs in _NEEDED.items() for c in cs)
_HEADERS_SQL = "SELECT table_name, column_name FROM duckdb_columns() WHERE table_name IN ('orders', 'lineitem', 'part')"


@register(
    "q8_contract_drift",
    f"""
WITH needed(table_name, column_name) AS (VALUES {_NEEDED_SQL}), have AS ({_HEADERS_SQL})
SELECT table_name, column_name, 'missing' AS finding FROM (SELECT * FROM needed EXCEPT SELECT * FROM have)
UNION ALL SELECT table_name, column_name, 'unexpected' FROM (SELECT * FROM have EXCEPT SELECT * FROM needed)""",
)
def q8(spark, sf):
    w = warehouse(spark, sf)
    headers = {t: read_table(spark, w.sf_dir, t).columns for t in _NEEDED}
    found = quality.source_drift(headers, _NEEDED)
    return spark.createDataFrame(found, "table_name string, column_name string, finding string")


_TABLES = ("orders", "lineitem", "part", "region", "events", "promotions")


@register(
    "q9_required_tables",
    f"""
SELECT t.name AS table_name FROM (VALUES {", ".join(f"('{t}')" for t in _TABLES)}) t(name)
WHERE name NOT IN (SELECT table_name FROM duckdb_columns())""",
)
def q9(spark, sf):
    found = quality.missing_tables(spark, [f"{t}.parquet" for t in _TABLES], sf)
    return spark.createDataFrame([(t.removesuffix(".parquet"),) for t in found], "table_name string")


_RECENT = f"""recent AS (
  SELECT * FROM etl_log ORDER BY started_at DESC NULLS LAST, watermark_order_id DESC NULLS LAST, run_id
  LIMIT {rl.RECENT_RUNS}
)"""


@register("a16_recent_runs", with_warehouse("SELECT * FROM recent", _RECENT))
def a16(spark, sf):
    return rl.recent_runs(warehouse(spark, sf).log)


@register(
    "a17_run_kpis",
    with_warehouse(
        """
SELECT count(*) AS total_runs, count(*) FILTER (WHERE status = 'SUCCESS') AS success_runs,
       count(*) FILTER (WHERE status = 'FAILED') AS failed_runs,
       round(CASE WHEN count(*) > 0 THEN count(*) FILTER (WHERE status = 'SUCCESS') * 100.0 / count(*)
                  ELSE 0.0 END, 6)::DOUBLE AS success_rate_pct
FROM recent""",
        _RECENT,
    ),
)
def a17(spark, sf):
    return rl.run_kpis(rl.recent_runs(warehouse(spark, sf).log))


@register(
    "a18_timeline",
    with_warehouse(
        """
SELECT run_id, stage, started_at, coalesce(finished_at, started_at) AS finished_at, status,
       rows_loaded, watermark_order_id, message
FROM recent WHERE started_at IS NOT NULL ORDER BY started_at, run_id""",
        _RECENT,
    ),
)
def a18(spark, sf):
    return rl.run_timeline(rl.recent_runs(warehouse(spark, sf).log))


@register(
    "a19_run_filter",
    with_warehouse(
        "SELECT * FROM recent WHERE stage IN ("
        + ", ".join(f"'{s}'" for s in RUN_STAGES)
        + ") AND status IN ("
        + ", ".join(f"'{s}'" for s in RUN_STATUSES)
        + ")",
        _RECENT,
    ),
)
def a19(spark, sf):
    return rl.filter_runs(rl.recent_runs(warehouse(spark, sf).log), RUN_STAGES, RUN_STATUSES)


