"""Named queries: each is ``(spark, sf_dir) -> DataFrame`` over the
driver's tables, paired with its DuckDB oracle SQL where one exists.

A query builds the whole chain lazily (adapter -> Silver -> Gold -> query).
``Warehouse`` keeps the lazy layer DataFrames per (session, folder), which
saves planning, not data: a query over Silver or Gold still builds what it
needs.  The star that the dashboard's queries read is written once, with its
aggregates, below the checkpoint folder.  The persisted run (``plans.etl``) is
where all layers are written and read.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from tillroll.operators import cubes, marts
from tillroll.operators import gold as gold_ops
from tillroll.operators import silver as silver_ops
from tillroll.plans.layers import Gold, Silver, build_gold, build_silver
from tillroll.session import ensure_checkpoint_dir
from tillroll.sources import adapter

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None) -> Callable[[QueryFn], QueryFn]:
    def deco(fn: QueryFn) -> QueryFn:
        if name in _QUERIES:
            raise ValueError(f"duplicate query {name}")
        _QUERIES[name] = fn
        if oracle is not None:
            _ORACLE[name] = oracle
        return fn

    return deco


def queries() -> dict[str, QueryFn]:
    _load_all()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_all()
    return dict(_ORACLE)


def _load_all() -> None:
    # Import the modules that register queries (side effect: registration).
    from tillroll.plans import queries_basket, queries_quality, queries_star, queries_sources  # noqa: F401


@dataclass
class Warehouse:
    """Lazy layers of one build over the test tables (adapter roles)."""

    spark: SparkSession
    sf_dir: str
    platinum_min: int = gold_ops.PLATINUM_MIN_ORDERS
    gold_min: int = gold_ops.GOLD_MIN_ORDERS

    @cached_property
    def raw(self) -> adapter.RawSources:
        return adapter.raw_sources(self.spark, self.sf_dir)

    @cached_property
    def silver(self) -> Silver:
        return build_silver(self.raw)

    @cached_property
    def gold(self) -> Gold:
        return self._gold(self.silver)

    def _gold(self, staged: Silver) -> Gold:
        return build_gold(
            self.raw,
            staged,
            organic_pattern=adapter.ORGANIC_PATTERN_ON_TEST_DATA,
            platinum_min=self.platinum_min,
            gold_min=self.gold_min,
        )

    @cached_property
    def log(self) -> DataFrame:
        return adapter.run_log(self.spark, self.sf_dir)

    def stored(self, name: str, df: DataFrame) -> DataFrame:
        """A derived table written once per folder and session, as a warehouse
        has it, and read by every query that needs it."""
        path = f"{self._root}/{name}"
        df.write.parquet(path)
        return self.spark.read.parquet(path)

    @cached_property
    def _root(self) -> str:
        return f"{ensure_checkpoint_dir(self.spark)}/layers-{uuid.uuid4().hex}"

    @cached_property
    def stored_gold(self) -> Gold:
        """The Gold layer over stored orders.  Their dates take the longest chain
        of shuffles: it reads its source several times, and the fact and two
        dimensions read its end."""
        source = self.stored("orders", self.raw.orders)
        orders = self.stored("stg_orders", silver_ops.stg_orders(source))
        staged = replace(self.silver, stg_orders=orders, stg_users=silver_ops.stg_users(orders))
        return self._gold(staged)

    @cached_property
    def star(self) -> marts.Star:
        """The star over the stored fact, with the aggregates beside it: each is
        written when a query first reads it."""
        g = self.stored_gold
        fact = self.stored("fact_order_line", g.fact_order_line)
        product, branch, date = (self.stored(n, getattr(g, n)) for n in ("dim_product", "dim_branch", "dim_date"))
        return marts.star(
            fact,
            product,
            branch,
            date,
            counts=lambda: self.stored("agg_line_counts", cubes.line_counts(fact)),
            cube=lambda: self.stored("agg_distinct_cube", cubes.distinct_cube(fact, product)),
        )


_WAREHOUSES: dict[tuple[str, str], Warehouse] = {}


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _WAREHOUSES:
        _WAREHOUSES[key] = Warehouse(spark, sf_dir)
    return _WAREHOUSES[key]
