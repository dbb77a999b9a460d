"""Literal fixtures F1-F6 (FIXTURES.md)."""

from __future__ import annotations

import csv
import datetime as dt
from pathlib import Path

from tillroll import schemas as S
from tillroll.sources.adapter import RawSources

ORDERS = [
    (1, 10, "prior", 1, 1, 10, None),
    (2, 10, "train", 2, 2, 11, 5.0),
    (3, 11, "prior", 1, 5, 12, None),
]
PRIOR = [(1, 101, 1, 0), (3, 102, 1, 0)]
TRAIN = [(2, 101, 1, 1), (2, 103, 2, 0)]
PRODUCTS = [(101, "Organic Banana", 1, 1), (102, "Milk 1L", 2, 2), (103, "Fresh Apple", 1, 1)]
AISLES = [(1, "Fresh Fruits"), (2, "Dairy")]
DEPARTMENTS = [(1, "Produce"), (2, "Dairy Eggs")]
BRANCHES = [("DEFAULT_BRANCH", "Main Branch", "Hanoi", "North")]


def raw_f1(spark) -> RawSources:
    return RawSources(
        orders=spark.createDataFrame(ORDERS, S.BRONZE_ORDERS),
        order_products_prior=spark.createDataFrame(PRIOR, S.BRONZE_ORDER_PRODUCTS),
        order_products_train=spark.createDataFrame(TRAIN, S.BRONZE_ORDER_PRODUCTS),
        products=spark.createDataFrame(PRODUCTS, S.BRONZE_PRODUCTS),
        aisles=spark.createDataFrame(AISLES, S.BRONZE_AISLES),
        departments=spark.createDataFrame(DEPARTMENTS, S.BRONZE_DEPARTMENTS),
        branches=spark.createDataFrame(BRANCHES, S.BRANCH_SEED),
    )


def _write_csv(path: Path, header, rows) -> None:
    path.parent.mkdir(parents=True, exist_ok=True)
    with path.open("w", newline="", encoding="utf-8") as f:
        w = csv.writer(f)
        w.writerow(header)
        for r in rows:
            w.writerow(["" if v is None else v for v in r])


def write_f1_csv(root: Path, orders=ORDERS) -> tuple[str, str]:
    raw = root / "raw"
    _write_csv(raw / "orders.csv", [f.name for f in S.BRONZE_ORDERS], orders)
    _write_csv(raw / "order_products__prior.csv", [f.name for f in S.BRONZE_ORDER_PRODUCTS], PRIOR)
    _write_csv(raw / "order_products__train.csv", [f.name for f in S.BRONZE_ORDER_PRODUCTS], TRAIN)
    _write_csv(raw / "products.csv", [f.name for f in S.BRONZE_PRODUCTS], PRODUCTS)
    _write_csv(raw / "aisles.csv", ["aisle_id", "aisle"], AISLES)
    _write_csv(raw / "departments.csv", ["department_id", "department"], DEPARTMENTS)
    seed = root / "seed" / "branches.csv"
    _write_csv(seed, [f.name for f in S.BRANCH_SEED], BRANCHES)
    return str(raw), str(seed)


T0 = dt.datetime(2024, 3, 1, 8, 0, 0)


def log_f6(spark):
    """Run log with SUCCESS/FAILED rows, a null start, a null finish, and a
    FAILED row whose watermark is higher than any SUCCESS (must be ignored)."""
    rows = [
        ("r1", "bronze", T0, T0 + dt.timedelta(minutes=1), "SUCCESS", 10, 100, "OK"),
        ("r2", "silver", T0 + dt.timedelta(hours=1), None, "SUCCESS", 20, 100, "OK"),
        ("r3", "all", None, T0 + dt.timedelta(hours=2), "FAILED", 0, 0, "boom"),
        ("r4", "bronze", T0 + dt.timedelta(hours=3), T0 + dt.timedelta(hours=3, minutes=2), "FAILED", 5, 999, "late"),
        ("r5", "gold", T0 + dt.timedelta(hours=4), T0 + dt.timedelta(hours=4, minutes=5), "SUCCESS", 7, 120, "OK"),
    ]
    return spark.createDataFrame(rows, S.ETL_LOG)
