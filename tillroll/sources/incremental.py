"""Row-limited and key-consistent samples, incremental append and load
counters (S2, S3, S5, S7, S9)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.keys import surrogate_key

SAMPLE_BUCKETS = 1_000_000


def sample_rows(df: DataFrame, n: int, order_by: list[str]) -> DataFrame:
    """The first ``n`` rows of a source by ``order_by`` (a deterministic
    version of "first n rows of the file").  ``n`` must be > 0.

    A sampling feature for light runs: Spark plans it as a top-n (each task
    keeps its n best rows), so it is meant for small n.
    """
    if n is None or int(n) <= 0:
        raise ValueError("sample_rows must be > 0")
    return df.orderBy(*order_by).limit(int(n))


def in_key_sample(key: Column | str, fraction: float) -> Column:
    """Deterministic hash sample predicate on a key: the same keys are kept
    in every table and every run (and by the DuckDB oracle)."""
    if not 0 < fraction <= 1:
        raise ValueError("fraction must be in (0, 1]")
    k = F.col(key) if isinstance(key, str) else key
    return (surrogate_key(k.cast("string")) % SAMPLE_BUCKETS) < int(round(fraction * SAMPLE_BUCKETS))


def key_consistent_sample(
    orders: DataFrame, lines: DataFrame, products: DataFrame, fraction: float, key: str = "order_id"
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """S3: sample orders by key hash, keep only their lines and the products
    those lines reference, so joins of the sample never come out empty."""
    keep = in_key_sample(key, fraction)
    s_orders = orders.where(keep)
    # The hash predicate shrinks the lines first; the semi-join then drops
    # lines whose order is missing from the source.
    s_lines = lines.where(keep).join(s_orders.select(key), key, "left_semi")
    s_products = products.join(s_lines.select("product_id").distinct(), "product_id", "left_semi")
    return s_orders, s_lines, s_products


def incremental_rows(
    source: DataFrame, target: DataFrame, watermark: Column | int | None, key: str = "order_id", late: str = "drop"
) -> DataFrame:
    """Source rows with ``key > watermark`` that the target does not hold.

    Without a watermark (no successful load yet) there is no lower bound, so a
    first load takes every key, zero and negative ones included.  ``late``
    says what happens to keys at or below the watermark that the target lacks:
    ``"drop"`` leaves them out, ``"accept"`` loads them as well.  Rows with a
    null key are never loaded.

    Only target keys above the watermark can match, so the anti-join reads
    just the target's tail (pushed down to the scan) instead of its history.
    """
    if late not in ("drop", "accept"):
        raise ValueError("late must be 'drop' or 'accept'")
    k = F.col(key).cast("long")
    fresh = source.where(k.isNotNull())
    held = target
    if watermark is not None and late == "drop":
        wm = watermark if isinstance(watermark, Column) else F.lit(int(watermark))
        fresh, held = fresh.where(k > wm), held.where(k > wm)
    held = held.select(k.alias(key))
    return fresh.join(held, fresh[key].cast("long") == held[key], "left_anti")


def read_watermark(log: DataFrame) -> DataFrame:
    """Highest watermark of any successful run (0 when none), one row."""
    return log.where(F.col("status") == "SUCCESS").agg(
        F.coalesce(F.max("watermark_order_id"), F.lit(0)).cast("long").alias("watermark")
    )


def load_counters(target: DataFrame, old_watermark: Column | int | None, key: str = "order_id") -> DataFrame:
    """Rows above the old watermark (rows left by a failed earlier run
    count too; all rows when there is none) and the new watermark = max key
    (0 when empty), one row."""
    k = F.col(key).cast("long")
    if old_watermark is None:
        loaded = F.count(k)
    else:
        wm = old_watermark if isinstance(old_watermark, Column) else F.lit(int(old_watermark))
        loaded = F.count_if(k > wm)
    return target.agg(
        loaded.cast("long").alias("rows_loaded"),
        F.coalesce(F.max(k), F.lit(0)).cast("long").alias("watermark"),
    )


def tail_counters(target: DataFrame, old_watermark: int | None, key: str = "order_id") -> tuple[int, int]:
    """S9 for a stored table: the counters from the rows above the old
    watermark alone (pushed down to the scan); without any, the old watermark
    is the stored maximum."""
    tail = target if old_watermark is None else target.where(F.col(key).cast("long") > F.lit(old_watermark))
    row = load_counters(tail, old_watermark, key).first()
    watermark = row["watermark"] if row["rows_loaded"] or old_watermark is None else old_watermark
    return int(row["rows_loaded"]), int(watermark)
