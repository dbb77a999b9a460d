"""The dashboard's pages as DataFrames: each page takes the shared
multi-select filters (branch names, weekdays, departments) and returns its
panels by name.  Nothing is collected here; a UI (or a test) decides what
to materialise."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tillroll import schemas as S
from tillroll.operators import marts
from tillroll.operators import runlog as rl
from tillroll.operators import rules
from tillroll.plans.etl import WarehousePaths, _read, read_star
from tillroll.sources.files import read_result_csv
from tillroll.sources.runlog import read_log

BASKET_SUMMARY = "section string, metric string, label string, value double"
THRESHOLDS = (
    "min_support double, min_confidence double, min_lift double, rule_count long, "
    "max_lift double, avg_lift double"
)


class Dashboard:
    def __init__(self, spark: SparkSession, paths: WarehousePaths, mining_dir: str | None = None):
        self.spark, self.paths, self.mining_dir = spark, paths, mining_dir

    def _t(self, name: str) -> DataFrame:
        return _read(self.spark, self.paths, name)

    def _star(self) -> DataFrame:
        return read_star(self.spark, self.paths)

    @staticmethod
    def _filters(branches: Sequence[str], dows: Sequence[str], departments: Sequence[str]) -> marts.Filters:
        return marts.Filters(tuple(branches), tuple(dows), tuple(departments))

    def filter_values(self) -> DataFrame:
        return marts.filter_values(self._t("dim_branch"), self._t("dim_date"), self._t("dim_product"))

    def headline(self) -> DataFrame:
        star = self._star()
        return marts.headline_stats(star.fact, star.product, read_log(self.spark, self.paths.log), star)

    def overview(self, branches=(), dows=(), departments=()) -> dict[str, DataFrame]:
        f, star = self._filters(branches, dows, departments), self._star()
        return {
            "kpis": marts.kpis(star, f),
            "orders_by_weekday": marts.orders_by_weekday(star, f),
            "top_departments": marts.top_departments(star, f),
            "daily_trend": marts.daily_trend(star, f),
            "heatmap": marts.department_weekday_heatmap(star, f),
        }

    def products(self, branches=(), dows=(), departments=(), top_n: int = 20) -> dict[str, DataFrame]:
        f, star = self._filters(branches, dows, departments), self._star()
        top = marts.top_products(star, f, top_n)
        return {
            "top_products": top,
            "aisles_by_reorder_rate": marts.aisles_by_reorder_rate(star, f),
            "department_aisle": marts.department_aisle_rollup(star, f),
            "top_products_table": marts.reorder_rate_percent(top),
        }

    def customers(self, branches=(), dows=(), departments=(), top_n: int = 20) -> dict[str, DataFrame]:
        f, dc = self._filters(branches, dows, departments), self._t("dim_customer")
        return {
            "tiers": marts.tier_distribution(dc),
            "total_orders_histogram": marts.total_orders_histogram(dc),
            "top_customers": marts.top_customers(self._star(), dc, f, top_n),
        }

    def market_basket(self, min_support=None, min_confidence=None, min_lift=None) -> dict[str, DataFrame]:
        """The mining results read back from their CSV files (missing -> empty)."""
        if self.mining_dir is None:
            raise ValueError("mining_dir is not set")
        base = self.mining_dir.rstrip("/")
        rd = lambda name, schema: read_result_csv(self.spark, f"{base}/{name}", schema)
        rule_df = rd("association_rules", S.RULES)
        lo = {k: v for k, v in dict(min_support=min_support, min_confidence=min_confidence, min_lift=min_lift).items() if v is not None}
        thresholds = rd("threshold_comparison", THRESHOLDS)
        return {
            "basket_summary": rd("basket_summary", BASKET_SUMMARY),
            "rules": rules.filter_rules(rule_df, **lo),
            "metric_ranges": rules.metric_range(rule_df),
            "bundles": rd("bundle_recommendations", S.BUNDLES),
            "thresholds": thresholds,
            "thresholds_long": rules.melt_thresholds(thresholds),
        }

    def etl_log(self, stages=(), statuses=()) -> dict[str, DataFrame]:
        runs = rl.recent_runs(read_log(self.spark, self.paths.log))
        return {
            "runs": runs,
            "kpis": rl.run_kpis(runs),
            "timeline": rl.run_timeline(runs),
            "detail": rl.filter_runs(runs, stages, statuses),
        }
