"""Print the physical plans of the headline operators, as Spark would run
them at scale (auto-broadcast off, so joins show their large-data form).

    python tools/show_plans.py [--sf /root/testdata/sf0.01] [--broadcast]
"""

from __future__ import annotations

import argparse
import sys
import tempfile
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--broadcast", action="store_true", help="keep auto-broadcast on")
    ap.add_argument("--bucketed", action="store_true", help="build the bucketed (co-located) layout")
    args = ap.parse_args()

    from tillroll.operators import gold, marts, silver
    from tillroll.plans.etl import WarehousePaths, _read, run_stage
    from tillroll.session import get_spark
    from tillroll.sources import adapter
    from tillroll.sources import incremental as inc

    spark = get_spark("plans", master="local[8]", shuffle_partitions=16)
    root = tempfile.mkdtemp(prefix="tillroll-plans-")
    paths = (
        WarehousePaths(root, bucket_count=16, database="tillroll_plans")
        if args.bucketed
        else WarehousePaths(root)
    )
    raw = adapter.raw_sources(spark, args.sf)
    run_stage(spark, raw, paths, "all", with_quality=False)
    if not args.broadcast:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    rd = lambda t: _read(spark, paths, t)
    star = marts.star(rd("fact_order_line"), rd("dim_product"), rd("dim_branch"), rd("dim_date"))
    plans = {
        "T2 synthetic date (bucketed running sum)": silver.stg_orders(rd("bronze_orders")),
        "G7 fact_order_line": gold.fact_order_line(
            rd("stg_order_products"), rd("stg_orders"), rd("dim_date"), rd("dim_product"),
            rd("dim_customer"), rd("dim_branch"), derived_dims=True,
        ),
        "G8 fact_order_summary": gold.fact_order_summary(rd("fact_order_line"), rd("stg_orders")),
        "A2 KPIs, weekday filter": marts.kpis(star, marts.Filters(dows=["Monday"])),
        "A3 orders by weekday": marts.orders_by_weekday(star),
        "S5 incremental rows": inc.incremental_rows(rd("bronze_orders"), rd("bronze_orders"), 1000),
    }
    for title, df in plans.items():
        print(f"\n===== {title} =====")
        df.explain("formatted")


if __name__ == "__main__":
    main()
