"""The persisted Bronze -> Silver -> Gold run with its run log.

Layout under ``root`` (any Hadoop-compatible path; on a cluster a shared
store): immutable data folders ``<table>/<tag>`` published by numbered
manifests (:mod:`tillroll.sources.versions`), and ``etl_log/`` (append-only).

* Bronze: ``bronze_orders`` is incremental -- rows above the last
  successful watermark (every row before the first success) that the table
  does not already hold; each run publishes its own load, so a run repeated
  under the same run id replaces its own partial output, and one under a new
  id skips what the table holds.  Two loads at the same time: the second to
  publish finds the first one's, and compares its keys again.  The other five
  sources are snapshots (replaced).
* Silver and Gold are rebuilt in full from the *written* layer below, so
  every join sees real file sizes: Spark broadcasts a dimension only when
  it is under ``spark.sql.autoBroadcastJoinThreshold`` and sort-merges it
  otherwise, and a lost executor recomputes from files, not from the raw
  scan.  All tables a stage writes are published in one step: readers see the
  old set or the new one.
* A SUCCESS or FAILED row (message cut to 500 characters) is appended per
  run; failures are re-raised.
"""

from __future__ import annotations

import datetime as dt
import threading
import uuid
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll import schemas as S
from tillroll.functions.keys import surrogate_key
from tillroll.operators import cubes, marts
from tillroll.operators import gold as gold_ops
from tillroll.operators import quality as q
from tillroll.operators import silver as silver_ops
from tillroll.operators.keymap import assign_keys, with_mapped_key
from tillroll.operators.prefix import running_sums
from tillroll.plans.jobs import run_concurrently
from tillroll.sources import incremental as inc
from tillroll.sources.adapter import RawSources
from tillroll.sources.files import _exists
from tillroll.sources.runlog import append_log, log_row, new_run_id, read_log
from tillroll.sources.versions import Stored, Version, VersionConflict, numbers, publish, read_version

STAGES = ("bronze", "silver", "gold", "all")


# Tables keyed by order: with ``bucket_count`` set they are written bucketed
# on these columns, so the order-line join (G7) and the per-order summary
# (G8) read co-partitioned inputs and shuffle neither side.
BUCKET_KEYS = {
    "stg_orders": "order_id",
    "stg_order_products": "order_id",
    "fact_order_line": "order_id_nk",
}


@dataclass(frozen=True)
class WarehousePaths:
    """Where the warehouse lives.

    ``root`` holds the published versions.  With ``bucket_count`` and
    ``database``, the order-keyed tables are also registered as external
    catalog tables bucketed by order (``bucketBy`` needs a catalog to keep
    the bucket spec), one per version, with a view of the table's name over the
    newest; readers in a session that knows them get the
    co-partitioned plan, others read the same files by path.  Use at least
    ``spark.sql.shuffle.partitions`` buckets: with fewer, Spark re-shuffles
    the bucketed side to the default partition count when it meets a
    shuffled one.
    """

    root: str
    bucket_count: int | None = None
    database: str | None = None

    # A version to read from; None reads whatever is newest at each call.
    version: int | None = None

    def at(self, version: int) -> WarehousePaths:
        """The same warehouse as it was published in ``version``."""
        return replace(self, version=version)

    def published(self, spark: SparkSession) -> Version:
        return read_version(spark, self.root, self.version)

    def table(self, name: str) -> str:
        """The published folder of a table, or its plain place below the root."""
        spark = SparkSession.getActiveSession()
        stored = self.published(spark).tables.get(name) if spark and name != "etl_log" else None
        return f"{self.root.rstrip('/')}/{stored.folder if stored else name}"

    def catalog_name(self, name: str) -> str | None:
        if self.bucket_count and self.database and name in BUCKET_KEYS:
            return f"{self.database}.{name}"
        return None

    @property
    def log(self) -> str:
        return self.table("etl_log")


class Draft:
    """What a run has written and not yet published, over the version it began
    with.  Written folders are read back by the run itself only."""

    def __init__(self, spark: SparkSession, paths: WarehousePaths, run_id: str):
        self.spark, self.paths, self.run_id = spark, paths, run_id
        self.base = read_version(spark, paths.root)
        self.tables: dict[str, Stored] = {}
        self.loads: dict[str, Stored] = {}

    @property
    def root(self) -> str:
        return self.paths.root

    @property
    def log(self) -> str:
        return self.paths.log

    def published(self, spark: SparkSession) -> Version:
        return replace(self.base, tables={**self.base.tables, **self.tables}, loads={**self.base.loads, **self.loads})

    def catalog_name(self, name: str) -> str | None:
        return self.paths.catalog_name(name)

    def folder(self, name: str) -> tuple[str, str]:
        """A new folder for a table: below the root, and as a path."""
        own = f"{name}/{self.run_id}-{uuid.uuid4().hex[:8]}"
        return own, f"{self.root.rstrip('/')}/{own}"

    def publish(self) -> Version:
        version = publish(self.spark, self.root, self.base, self.tables, self.loads)
        for name, stored in self.tables.items():
            if stored.ident:  # the table's own name follows the newest version
                self.spark.sql(f"CREATE OR REPLACE VIEW {self.catalog_name(name)} AS SELECT * FROM {stored.ident}")
        return version


Place = WarehousePaths | Draft


def _read(spark: SparkSession, paths: Place, name: str) -> DataFrame:
    stored = paths.published(spark).tables.get(name)
    if stored is None:
        return spark.read.parquet(f"{paths.root.rstrip('/')}/{name}")
    if stored.ident and spark.catalog.tableExists(stored.ident):
        return spark.table(stored.ident)
    return spark.read.parquet(f"{paths.root.rstrip('/')}/{stored.folder}")


_CATALOG_LOCK = threading.Lock()


def _write(df: DataFrame, paths: Place, name: str) -> None:
    """Write a table into a draft, or publish it by itself."""
    if isinstance(paths, WarehousePaths):
        draft = Draft(df.sparkSession, paths, "single")
        _write(df, draft, name)
        draft.publish()
        return
    own, path = paths.folder(name)
    target, spark = paths.catalog_name(name), df.sparkSession
    if target is None:
        df.write.parquet(path)
        paths.tables[name] = Stored(own)
        return
    database = paths.paths.database
    with _CATALOG_LOCK:  # layer writes run concurrently; create the database once
        if not spark.catalog.databaseExists(database):
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    ident, key = f"{target}_{own[-8:]}", BUCKET_KEYS[name]
    (
        df.write.format("parquet")
        .option("path", path)
        .bucketBy(paths.paths.bucket_count, key)
        .sortBy(key)
        .saveAsTable(ident)
    )
    paths.tables[name] = Stored(own, ident)


def _write_all(tables: dict[str, DataFrame], paths: Place) -> None:
    """Write independent tables as concurrent Spark jobs."""
    run_concurrently({name: (lambda df=df, name=name: _write(df, paths, name)) for name, df in tables.items()})


def write_load(fresh: DataFrame, draft: Draft) -> None:
    """A draft's load of ``bronze_orders`` under the run's id.  A load that has
    been compacted with others is settled: its rows stay as they are."""
    known = draft.base.loads.get(draft.run_id)
    if known and sum(s.folder == known.folder for s in draft.base.loads.values()) > 1:
        return
    own, path = draft.folder(BRONZE_ORDERS)
    fresh.write.parquet(path)
    key = F.col("order_id").cast("long")
    ends = draft.spark.read.schema(S.BRONZE_ORDERS).parquet(path).agg(F.min(key).alias("low"), F.max(key).alias("high")).first()
    draft.loads[draft.run_id] = Stored(own, None, ends.low, ends.high)
    draft.tables[BRONZE_ORDERS] = Stored(BRONZE_ORDERS)


def compact_loads(spark: SparkSession, paths: WarehousePaths) -> Version:
    """One folder for all loads, published like any write.  The load ids stay
    known, so a load that is run again after it adds nothing."""
    draft = Draft(spark, paths, "compacted")
    own, path = draft.folder(BRONZE_ORDERS)
    read_bronze_orders(spark, draft).write.parquet(path)
    low = min((s.low for s in draft.base.loads.values() if s.low is not None), default=None)
    high = max((s.high for s in draft.base.loads.values() if s.high is not None), default=None)
    draft.loads = {name: Stored(own, None, low, high) for name in draft.base.loads}
    return publish(spark, paths.root, draft.base, {}, draft.loads)


BRONZE_ORDERS = "bronze_orders"
# The raw rows of the last load that did not fit their types (text and reason).
REJECTS = "bronze_rejects"


def read_bronze_orders(
    spark: SparkSession, paths: Place, exclude_load: str | None = None, between: tuple[int, int] | None = None
) -> DataFrame:
    """All loaded orders; ``exclude_load`` leaves out one load's folder, and
    ``between`` those without a key in that range (neither is even listed).

    A load compares itself only with the *other* loads: if a run or a
    stream batch is retried under the same load id, its earlier partial
    output must not hide the rows it is about to rewrite.
    """
    loads = paths.published(spark).loads
    wanted = [s for name, s in loads.items() if name != exclude_load]
    if between is not None:
        low, high = between
        wanted = [s for s in wanted if s.low is not None and s.low <= high and s.high >= low]
    folders = sorted({f"{paths.root.rstrip('/')}/{s.folder}" for s in wanted})
    if not folders:
        return spark.createDataFrame([], S.BRONZE_ORDERS)
    return spark.read.schema(S.BRONZE_ORDERS).parquet(*folders)


def current_watermark(spark: SparkSession, paths: Place, exclude_run: str | None = None) -> int | None:
    """S7 as a number (a one-row aggregate; the value filters the scans), None
    before the first successful run."""
    log = read_log(spark, paths.log, exclude_run).where(F.col("status") == "SUCCESS")
    row = log.agg(F.max("watermark_order_id").alias("watermark")).first()
    return None if row["watermark"] is None else int(row["watermark"])


def published(run: Callable[[Draft], object], spark: SparkSession, paths: WarehousePaths, run_id: str, attempts: int = 5):
    """Run a stage on a draft and publish it; on a conflict run it again on
    what has been published meanwhile."""
    for left in reversed(range(attempts)):
        draft = Draft(spark, paths, run_id)
        result = run(draft)
        try:
            draft.publish()
            return result
        except VersionConflict:
            if not left:
                raise


def run_bronze(
    spark: SparkSession,
    raw: RawSources,
    paths: WarehousePaths,
    run_id: str,
    sample_rows: int | None = None,
    late: str = "drop",
) -> tuple[int, int]:
    """Load Bronze and publish it; returns (rows_loaded, new watermark)."""
    watermark = current_watermark(spark, paths, exclude_run=run_id)
    published(lambda draft: _bronze(spark, raw, draft, watermark, sample_rows, late), spark, paths, run_id)
    return inc.tail_counters(read_bronze_orders(spark, paths), watermark)


def _bronze(spark, raw: RawSources, draft: Draft, watermark: int | None, sample_rows: int | None, late: str) -> None:
    sources = {
        "bronze_order_products_prior": (raw.order_products_prior, ["order_id", "add_to_cart_order", "product_id"]),
        "bronze_order_products_train": (raw.order_products_train, ["order_id", "add_to_cart_order", "product_id"]),
        "bronze_products": (raw.products, ["product_id"]),
        "bronze_aisles": (raw.aisles, ["aisle_id"]),
        "bronze_departments": (raw.departments, ["department_id"]),
    }
    orders = raw.orders
    if sample_rows is not None:
        orders = inc.sample_rows(orders, sample_rows, ["order_id"])
        sources = {k: (inc.sample_rows(df, sample_rows, keys), keys) for k, (df, keys) in sources.items()}

    between = None
    if late == "accept":  # any key may be held; loads without one in the source's range are not read
        key = F.col("order_id").cast("long")
        ends = orders.agg(F.min(key).alias("low"), F.max(key).alias("high")).first()
        between = (0, -1) if ends.low is None else (ends.low, ends.high)
    elif watermark is not None:
        between = (watermark + 1, (1 << 63) - 1)
    target = read_bronze_orders(spark, draft, exclude_load=draft.run_id, between=between)
    fresh = inc.incremental_rows(orders, target, watermark, late=late)
    # Own folder per run: a retry of this run replaces only its own rows.
    writes = {name: (lambda df=df, name=name: _write(df, draft, name)) for name, (df, _) in sources.items()}  # S6: snapshots
    if raw.rejects is not None:
        writes[REJECTS] = lambda: _write(raw.rejects, draft, REJECTS)
    run_concurrently({"load": lambda: write_load(fresh, draft), **writes})


def run_silver(spark: SparkSession, paths: Place) -> int:
    bronze = read_bronze_orders(spark, paths)
    _write_all(
        {
            "stg_orders": silver_ops.stg_orders(bronze),
            "stg_order_products": silver_ops.stg_order_products(
                _read(spark, paths, "bronze_order_products_prior"),
                _read(spark, paths, "bronze_order_products_train"),
            ),
            "stg_products": silver_ops.stg_products(_read(spark, paths, "bronze_products")),
        },
        paths,
    )
    _write(silver_ops.stg_users(_read(spark, paths, "stg_orders")), paths, "stg_users")
    return _read(spark, paths, "stg_order_products").count()


def run_gold(
    spark: SparkSession,
    paths: Place,
    branch_seed: DataFrame,
    organic_pattern: str = gold_ops.ORGANIC_PATTERN,
    platinum_min: int = gold_ops.PLATINUM_MIN_ORDERS,
    gold_min: int = gold_ops.GOLD_MIN_ORDERS,
    key_maps: bool = False,
) -> int:
    """Rebuild Gold.  With ``key_maps`` product and customer keys come from
    stored maps (``key_map_product``, ``key_map_customer``): no two members
    share a key, a member keeps its key in every later build, and the fact gets
    its keys from the dimensions.  Once there are maps they are used always."""
    rd = lambda name: _read(spark, paths, name)
    key_maps = key_maps or "key_map_product" in paths.published(spark).tables

    def keyed(dim: DataFrame, name: str, natural: str, key: str) -> DataFrame:
        if not key_maps:
            return dim
        known = rd(name) if name in paths.published(spark).tables else None
        _write(assign_keys(dim, natural, known, KEY_HASH), paths, name)
        return with_mapped_key(dim, rd(name), natural, key)

    product = gold_ops.dim_product(rd("stg_products"), rd("bronze_aisles"), rd("bronze_departments"), organic_pattern)
    customer = gold_ops.dim_customer(rd("stg_users"), platinum_min, gold_min)
    _write_all(
        {
            "dim_product": keyed(product, "key_map_product", "product_id_nk", "product_key"),
            "dim_branch": gold_ops.dim_branch(branch_seed),
            "dim_date": gold_ops.dim_date(rd("stg_orders")),
            "dim_customer": keyed(customer, "key_map_customer", "user_id_nk", "customer_key"),
        },
        paths,
    )
    # Without maps the fact computes the date and customer keys itself (those
    # dimensions derive from the same staged orders).
    fact = gold_ops.fact_order_line(
        rd("stg_order_products"), rd("stg_orders"), rd("dim_date"), rd("dim_product"), rd("dim_customer"),
        rd("dim_branch"), derived_dims=not key_maps,
    )
    _write(fact, paths, "fact_order_line")
    _write(gold_ops.fact_order_summary(rd("fact_order_line"), rd("stg_orders")), paths, "fact_order_summary")
    return rd("fact_order_line").count()


# The hash of a natural key's text, before any probe.
KEY_HASH = surrogate_key

COUNTS, CUBE = "agg_line_counts", "agg_distinct_cube"


def run_aggregates(spark: SparkSession, paths: WarehousePaths, run_id: str | None = None) -> None:
    """Write and publish the dashboard's aggregates of the current fact.  They
    carry its folder's name and hold for that fact only."""

    def run(draft: Draft) -> None:
        fact, product = _read(spark, draft, "fact_order_line"), _read(spark, draft, "dim_product")
        draft.run_id = draft.base.tables["fact_order_line"].folder.split("/")[-1]
        _write_all({COUNTS: cubes.line_counts(fact), CUBE: cubes.distinct_cube(fact, product)}, draft)

    published(run, spark, paths, run_id or new_run_id())


def read_star(spark: SparkSession, paths: Place) -> marts.Star:
    """The star over the Gold tables of one version, with the aggregates if they
    are of this fact."""
    version = paths.published(spark)
    if isinstance(paths, WarehousePaths) and version.number:
        paths = paths.at(version.number)
    rd = lambda name: _read(spark, paths, name)
    fact = version.tables.get("fact_order_line")
    of_fact = fact and all(n in version.tables and version.tables[n].folder.startswith(f"{n}/{fact.folder.split('/')[-1]}-") for n in (COUNTS, CUBE))
    extra = {"counts": rd(COUNTS), "cube": rd(CUBE)} if of_fact else {}
    return marts.star(rd("fact_order_line"), rd("dim_product"), rd("dim_branch"), rd("dim_date"), **extra)


# Fixed value: the published rule table's name (S12, written by the mining job).
RULE_TABLE = "dm_association_rules"

WAREHOUSE_TABLES = (
    list(S.BRONZE_TABLES) + list(S.SILVER_CONTRACT) + list(S.GOLD_CONTRACT) + [REJECTS, "etl_log", RULE_TABLE]
)


def register_views(spark: SparkSession, paths: WarehousePaths) -> list[str]:
    """Expose every written table as a temporary view of the same name, so
    the warehouse can be queried with ``spark.sql`` (views are lazy: each
    query reads the Parquet files with pruning and pushdown)."""
    names = []
    paths = paths.at(paths.published(spark).number) if numbers(spark, paths.root) else paths
    for name in WAREHOUSE_TABLES:
        if not _exists(spark, paths.table(name)):
            continue
        if name == "bronze_orders":
            df = read_bronze_orders(spark, paths)
        elif name == "etl_log":
            df = read_log(spark, paths.log)
        else:
            df = _read(spark, paths, name)
        df.createOrReplaceTempView(name)
        names.append(name)
    return names


class QualityGateError(RuntimeError):
    pass


def recomputed_dates(bronze_orders: DataFrame) -> DataFrame:
    """Q7's own recomputation of T2, by running sums over the loaded orders that
    need no user's orders in one task."""
    gap = F.coalesce(F.rint("days_since_prior_order").cast("int"), F.lit(0))
    orders = bronze_orders.where("order_id IS NOT NULL AND user_id IS NOT NULL").withColumn("_gap", gap)
    days = running_sums(orders, "user_id", "order_number", "_gap").withColumnsRenamed({"user_id": "_user", "order_number": "_number"})
    same = (F.col("user_id") == F.col("_user")) & F.col("order_number").eqNullSafe(F.col("_number"))
    return orders.join(days, same).select(
        F.col("order_id").cast("long").alias("order_id"),
        F.date_add(F.lit(silver_ops.SYNTHETIC_EPOCH), F.col("total").cast("int")).alias("synthetic_order_date"),
    )


def run_quality_gate(spark: SparkSession, paths: WarehousePaths) -> list[str]:
    """The Q checks that must hold after a build; returns failure messages.

    Every check of the suite runs: Q1-Q11, Q13 and, where the log has rows,
    Q17.  On data that breaks one of them (repeated line grains, lines whose
    order or product is missing) the gate says so.
    """
    rd = lambda name: _read(spark, paths, name)
    failures = []
    missing = q.missing_tables(spark, list(S.GOLD_CONTRACT) + list(S.BRONZE_TABLES), paths.root)
    if missing:
        return [f"missing tables: {missing}"]
    tables = {n: rd(n) for n in S.GOLD_CONTRACT}
    cols = q.missing_columns(tables, S.GOLD_CONTRACT)
    if cols:
        failures.append(f"missing columns: {cols}")
    fl, summary = tables["fact_order_line"], tables["fact_order_summary"]
    bronze, staged = read_bronze_orders(spark, paths), rd("stg_orders")
    orphans = q.fk_orphans(
        fl,
        {
            "product": (tables["dim_product"], "product_key"),
            "customer": (tables["dim_customer"], "customer_key"),
            "date": (tables["dim_date"], "date_key"),
            "branch": (tables["dim_branch"], "branch_key"),
        },
    ).where(F.col("orphan_rows") > 0)
    grain = ["order_id_nk", "product_key", "add_to_cart_order"]
    # An order id held twice has two dates and would meet itself in Q7's join; compare per id.
    dates = lambda df: df.groupBy("order_id").agg(F.max("synthetic_order_date").alias("synthetic_order_date"))
    rerun = inc.incremental_rows(bronze, bronze, current_watermark(spark, paths))
    # Independent checks, submitted together; each returns a few rows at most.
    results = run_concurrently(
        {
            "line_dups": lambda: q.duplicate_grain(fl, grain).count(),
            "summary_dups": lambda: q.duplicate_grain(summary, ["order_id_nk"]).count(),
            "product_keys": lambda: q.duplicate_grain(tables["dim_product"], ["product_key"]).count(),
            "customer_keys": lambda: q.duplicate_grain(tables["dim_customer"], ["customer_key"]).count(),
            "orphans": lambda: orphans.collect(),  # at most one row per foreign key
            "row_counts": lambda: q.row_count_match(fl, rd("stg_order_products")).first(),
            "default_member": lambda: q.default_member(tables["dim_branch"]).first()["ok"],
            "null_dates": lambda: q.null_count(staged, "synthetic_order_date").first()[0],
            "dates": lambda: q.recompute_mismatches(
                dates(staged), dates(recomputed_dates(bronze)), "order_id", "synthetic_order_date"
            ).first(),
            "rerun": lambda: rerun.limit(1).count(),
            "summary_rows": lambda: q.reconciliation(summary, fl, rd("stg_order_products"), bronze).first(),
        }
    )
    if results["line_dups"]:
        failures.append(f"fact_order_line: {results['line_dups']} grains are repeated")
    if results["summary_dups"]:
        failures.append("fact_order_summary grain is not unique")
    for key in ("product_keys", "customer_keys"):
        if results[key]:
            failures.append(f"{results[key]} {key.replace('_', ' ')} stand for more than one member")
    failures += [f"orphan {r['fk']} keys: {r['orphan_rows']}" for r in results["orphans"]]
    counts = results["row_counts"]
    if not counts["matches"]:
        failures.append(f"{counts['fact_rows']} fact lines for {counts['staged_rows']} staged lines")
    if results["default_member"] is not True:
        failures.append("dim_branch must hold exactly one DEFAULT_BRANCH row")
    if results["null_dates"]:
        failures.append("stg_orders has null synthetic_order_date")
    if results["dates"]["mismatches"]:
        failures.append(f"{results['dates']['mismatches']} synthetic dates differ from their recomputation")
    if results["rerun"]:
        failures.append("loading the held orders again would add rows")
    if not results["summary_rows"]["summary_matches"]:
        failures.append("fact_order_summary does not hold one row per order of the fact")
    log = read_log(spark, paths.log)
    if not log.isEmpty() and not q.successful_run_exists(log).first()["ok"]:
        failures.append("no run in the log succeeded")
    return failures


def run_stage(
    spark: SparkSession,
    raw: RawSources,
    paths: WarehousePaths,
    stage: str,
    with_quality: bool = True,
    sample_rows: int | None = None,
    run_id: str | None = None,
    **gold_params,
) -> dict[str, int | str]:
    """Run one stage (or ``all``) and write its run-log row.  A scheduler that
    retries a run passes the same ``run_id`` again: the retry replaces the
    load folder and the log row of the attempt before."""
    if stage not in STAGES:
        raise ValueError(f"unknown stage {stage!r}: one of {', '.join(STAGES)}")
    run_id = run_id or new_run_id()
    started = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    rows_loaded, watermark, message = 0, 0, "OK"
    try:
        if stage in ("bronze", "all"):
            rows_loaded, watermark = run_bronze(spark, raw, paths, run_id, sample_rows)
            if raw.rejects is not None:
                message = f"OK, {_read(spark, paths, REJECTS).count()} raw rows rejected"
        else:
            watermark = current_watermark(spark, paths, exclude_run=run_id) or 0
        if stage in ("silver", "gold", "all"):

            def layers(draft: Draft) -> int:
                staged = run_silver(spark, draft) if stage != "gold" else 0
                return staged + (run_gold(spark, draft, raw.branches, **gold_params) if stage != "silver" else 0)

            rows_loaded += published(layers, spark, paths, run_id)
        if stage == "all" and with_quality:
            failures = run_quality_gate(spark, paths)
            if failures:
                raise QualityGateError("; ".join(failures))
        append_log(
            log_row(spark, run_id, stage, "SUCCESS", rows_loaded, watermark, message, started_at=started),
            paths.log,
            run_id,
        )
    except Exception as exc:
        append_log(
            log_row(spark, run_id, stage, "FAILED", rows_loaded, watermark, str(exc), started_at=started),
            paths.log,
            run_id,
        )
        raise
    return {"run_id": run_id, "stage": stage, "rows_loaded": rows_loaded, "watermark": watermark}
