"""Key maps under a hash that is far too short."""

import pytest
from pyspark.sql import functions as F

from tests.fixtures import write_f1_csv
from tillroll.functions.keys import surrogate_key
from tillroll.operators.keymap import assign_keys
from tillroll.plans import etl
from tillroll.plans.etl import WarehousePaths, _read, run_stage
from tillroll.sources.files import csv_sources


def short(bits):
    return lambda text: surrogate_key(text) % (1 << bits)


def test_every_member_has_its_own_key_and_keeps_it(spark):
    first = assign_keys(spark.range(300).toDF("u"), "u", hashed=short(10))
    rows = first.collect()
    assert len({r.key for r in rows}) == len({r.natural for r in rows}) == 300
    plain = {r.natural: r.k for r in spark.range(300).select(F.col("id").cast("string").alias("natural"), short(10)(F.col("id")).alias("k")).collect()}
    assert sum(plain[r.natural] == r.key for r in rows) > 200  # most have the plain hash
    later = assign_keys(spark.range(100, 700).toDF("u"), "u", first, short(10)).collect()
    keys = {r.natural: r.key for r in later}
    assert len(set(keys.values())) == len(keys) == 700 and all(keys[r.natural] == r.key for r in rows)


def test_no_collision_is_the_plain_hash_and_nulls_have_none(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "u string")
    out = assign_keys(df, "u")
    assert out.where(F.col("key") != surrogate_key("natural")).count() == 0 and out.count() == 2
    assert assign_keys(df.limit(0), "u").count() == 0


def test_a_hash_without_room_is_refused(spark):
    with pytest.raises(RuntimeError, match="too short"):
        assign_keys(spark.range(20).toDF("u"), "u", hashed=short(3), probes=5)


def test_facts_and_dimensions_stay_joinable(spark, scratch, monkeypatch):
    monkeypatch.setattr(etl, "KEY_HASH", short(2))
    raw_dir, seed = write_f1_csv(scratch)
    raw = csv_sources(spark, raw_dir, seed)
    paths = WarehousePaths(str(scratch / "wh"))
    keys = []
    for run, params in (("a", {"key_maps": True}), ("b", {})):  # the second build finds the maps
        run_stage(spark, raw, paths, "all", with_quality=False, run_id=run, **params)
        assert etl.run_quality_gate(spark, paths) == []
        fact, product, customer = (_read(spark, paths, n) for n in ("fact_order_line", "dim_product", "dim_customer"))
        joined = fact.join(product, "product_key").join(customer, "customer_key")
        assert joined.count() == fact.count() == 4
        wanted = _read(spark, paths, "stg_order_products").join(_read(spark, paths, "stg_orders"), "order_id")
        pairs = lambda df, *c: sorted(map(str, df.selectExpr(*c).collect()))
        assert pairs(joined, "order_id_nk a", "product_id_nk b", "user_id_nk c") == pairs(
            wanted, "cast(order_id as string) a", "cast(product_id as string) b", "cast(user_id as string) c"
        )
        keys.append(pairs(product, "product_id_nk", "product_key") + pairs(customer, "user_id_nk", "customer_key"))
    assert keys[0] == keys[1]
