"""Run-log views."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.filters import in_filters

# Fixed value: how many of the latest runs the run-log views show.
RECENT_RUNS = 200


def recent_runs(log: DataFrame, n: int = RECENT_RUNS) -> DataFrame:
    """The latest ``n`` runs by start time (unknown starts last)."""
    return log.orderBy(
        F.desc_nulls_last("started_at"), F.desc_nulls_last("watermark_order_id"), F.asc("run_id")
    ).limit(n)


def run_kpis(runs: DataFrame) -> DataFrame:
    """Total, succeeded, failed and success rate in percent (0 when
    there are no runs)."""
    total = F.count(F.lit(1))
    ok = F.count_if(F.col("status") == "SUCCESS")
    return runs.agg(
        total.alias("total_runs"),
        ok.alias("success_runs"),
        F.count_if(F.col("status") == "FAILED").alias("failed_runs"),
        F.round(F.when(total > 0, ok * 100.0 / total).otherwise(F.lit(0.0)), 6).alias(
            "success_rate_pct"
        ),
    )


def run_timeline(runs: DataFrame) -> DataFrame:
    """Runs with a start time; an unfinished run ends when it started."""
    return (
        runs.where(F.col("started_at").isNotNull())
        .withColumn("finished_at", F.coalesce("finished_at", "started_at"))
        .orderBy("started_at", "run_id")
    )


def filter_runs(
    runs: DataFrame, stages: Sequence[str] = (), statuses: Sequence[str] = ()
) -> DataFrame:
    """Optional stage / status multi-selects."""
    return runs.where(in_filters({"stage": stages, "status": statuses}))
