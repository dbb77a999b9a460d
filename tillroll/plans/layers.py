"""Lazy assembly of the Silver and Gold layers from raw sources."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from tillroll.operators import gold, silver
from tillroll.sources.adapter import RawSources


@dataclass(frozen=True)
class Silver:
    stg_orders: DataFrame
    stg_order_products: DataFrame
    stg_products: DataFrame
    stg_users: DataFrame


@dataclass(frozen=True)
class Gold:
    dim_date: DataFrame
    dim_product: DataFrame
    dim_customer: DataFrame
    dim_branch: DataFrame
    fact_order_line: DataFrame
    fact_order_summary: DataFrame


def build_silver(raw: RawSources) -> Silver:
    orders = silver.stg_orders(raw.orders)
    return Silver(
        stg_orders=orders,
        stg_order_products=silver.stg_order_products(
            raw.order_products_prior, raw.order_products_train
        ),
        stg_products=silver.stg_products(raw.products),
        stg_users=silver.stg_users(orders),
    )


def build_gold(
    raw: RawSources,
    s: Silver,
    organic_pattern: str = gold.ORGANIC_PATTERN,
    platinum_min: int = gold.PLATINUM_MIN_ORDERS,
    gold_min: int = gold.GOLD_MIN_ORDERS,
) -> Gold:
    d_date = gold.dim_date(s.stg_orders)
    d_product = gold.dim_product(s.stg_products, raw.aisles, raw.departments, organic_pattern)
    d_customer = gold.dim_customer(s.stg_users, platinum_min, gold_min)
    d_branch = gold.dim_branch(raw.branches)
    # dim_date / dim_customer are built from s.stg_orders just above, so the
    # fact can compute their keys directly (see gold.fact_order_line).
    f_line = gold.fact_order_line(
        s.stg_order_products, s.stg_orders, d_date, d_product, d_customer, d_branch,
        derived_dims=True,
    )
    return Gold(
        dim_date=d_date,
        dim_product=d_product,
        dim_customer=d_customer,
        dim_branch=d_branch,
        fact_order_line=f_line,
        fact_order_summary=gold.fact_order_summary(f_line, s.stg_orders),
    )
