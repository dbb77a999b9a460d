"""The market-basket job: summary, ranked rules, bundles and the threshold
comparison from the Gold tables, written as CSV results (S11) and
optionally as a rule table (S12).

Itemsets are mined **once** at the lowest support any output needs and
checkpointed; the rules of every output are the subset with ``support >=``
its threshold (all subsets of a frequent itemset are frequent, and
confidence/lift do not depend on the threshold).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.operators import baskets as bk
from tillroll.operators import rules as rl
from tillroll.plans.etl import RULE_TABLE, WarehousePaths, _write
from tillroll.plans.jobs import run_concurrently
from tillroll.sources.files import write_result_csv, write_table


def in_range(name: str, value):
    """``value`` if it is above zero (None: no limit); else a ValueError."""
    if value is not None and not value > 0:
        raise ValueError(f"{name} = {value} is not above zero")
    return value


@dataclass(frozen=True)
class MiningParams:
    min_support: float = rl.DEFAULT_MIN_SUPPORT
    min_confidence: float = rl.DEFAULT_MIN_CONFIDENCE
    min_lift: float = rl.DEFAULT_MIN_LIFT
    max_len: int | None = None
    top_n: int | None = rl.DEFAULT_TOP_N
    thresholds: Sequence[float] = rl.DEFAULT_THRESHOLDS
    item_col: str = bk.ITEM_COL

    def validate(self) -> None:
        checked = ("min_support", "min_confidence", "min_lift", "max_len", "top_n")
        for name in checked:
            in_range(name, getattr(self, name))
        if not self.thresholds:
            raise ValueError("thresholds is empty")
        for value in self.thresholds:
            in_range("thresholds", value)


@dataclass(frozen=True)
class MiningResult:
    summary: DataFrame
    rules: DataFrame
    bundles: DataFrame
    thresholds: DataFrame
    top_n: int | None = rl.DEFAULT_TOP_N


def run_mining(fact_order_line: DataFrame, dim_product: DataFrame, params: MiningParams = MiningParams()) -> MiningResult:
    params.validate()
    items = bk.order_items(fact_order_line, dim_product)
    if bk.clean_items(items, params.item_col).isEmpty():  # reads at most one row
        raise ValueError("the fact has no lines with an order and an item")
    baskets = bk.baskets(items, item_col=params.item_col)
    floor = min([params.min_support, *params.thresholds])
    sets = rl.frequent_itemsets(baskets, floor, params.max_len)
    # Read by the rules, the bundles, the thresholds and the rule table: mined and priced once.
    all_rules = rl.association_rules(sets, params.min_confidence).where(F.col("lift") >= F.lit(params.min_lift))
    all_rules = all_rules.checkpoint(eager=True)
    ranked = rl.rank_rules(all_rules.where(F.col("support") >= F.lit(params.min_support)), params.min_lift, params.top_n)
    thresholds = rl.threshold_table(all_rules, params.thresholds, params.min_confidence, params.min_lift)
    return MiningResult(
        summary=bk.summarize_baskets(items, top_n=params.top_n or bk.DEFAULT_TOP_N, item_col=params.item_col),
        rules=rl.rules_table(ranked),
        bundles=rl.bundle_recommendations(ranked),
        thresholds=thresholds,
        top_n=params.top_n,
    )


def write_mining(
    result: MiningResult, out_dir: str, rule_table_path: str | None = None, warehouse: WarehousePaths | None = None
) -> None:
    """S11 (+ S12): the four result files, and if asked the rule table, at a
    path of its own or published in the warehouse."""
    base = out_dir.rstrip("/")
    # The summary (7 + 3 top-N lists) and the threshold table (one row per
    # threshold) are bounded; rules and bundles are bounded only by top_n.
    bounded = result.top_n is not None
    files = {
        "basket_summary": (result.summary, True),
        "association_rules": (result.rules, bounded),
        "bundle_recommendations": (result.bundles, bounded),
        "threshold_comparison": (result.thresholds, True),
    }
    writes = {
        name: (lambda df=df, name=name, single=single: write_result_csv(df, f"{base}/{name}", single_file=single))
        for name, (df, single) in files.items()
    }
    if rule_table_path:
        writes["rule_table"] = lambda: write_table(result.rules, rule_table_path)
    if warehouse:
        writes[RULE_TABLE] = lambda: _write(result.rules, warehouse, RULE_TABLE)
    run_concurrently(writes)


def run_mining_job(
    fact_order_line: DataFrame,
    dim_product: DataFrame,
    out_dir: str,
    params: MiningParams = MiningParams(),
    rule_table_path: str | None = None,
    warehouse: WarehousePaths | None = None,
) -> None:
    """Mine, then write every result: nothing is written for an empty input,
    for which mining raises."""
    write_mining(run_mining(fact_order_line, dim_product, params), out_dir, rule_table_path, warehouse)
