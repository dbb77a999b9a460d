"""Exact deduplication by progressive refinement (operator 9).

Texts that are equal have the same length, then the same prefix hash, then
the same full hash.  Each pass groups the survivors of the one before:

1. by length in bytes,
2. by (length, hash of the first ``prefix_bytes`` bytes),
3. by SHA-256 of the whole content, computed only where pass 2 found company.

Passes 1 and 2 move one narrow pre-aggregated row per key and task.  Which
rows survive goes back to the scan as a bitmap over a fixed hash space (at
most ``BITMAP_WORDS`` rows, whatever the corpus), so no text is ever shuffled
and a text whose length and prefix are unique is never hashed in full.  A bit
shared by two keys costs one needless hash; the full hash decides alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import numbered, without_rows

PREFIX_BYTES = 64
BITMAP_BITS = 22
BITMAP_WORDS = 1 << (BITMAP_BITS - 6)


_SLOT = f"xxhash64({{}}) & {(1 << BITMAP_BITS) - 1}"


def _slot(*key: str) -> Column:
    return F.expr(_SLOT.format(", ".join(key)))


def shared_keys(rows: DataFrame, *key: str) -> DataFrame:
    """Bitmap (word, bits) of the keys that two rows or more have: 64 slots of
    the hash space to a row, at most ``BITMAP_WORDS`` rows."""
    return (
        rows.groupBy(*key)
        .agg(F.count("*").alias("n"))
        .where("n > 1")
        .select(_slot(*key).alias("slot"))
        .groupBy(F.shiftright("slot", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, CAST(slot & 63 AS INT))")).alias("bits"))
    )


def with_company(rows: DataFrame, name: str, among: Column, *key: str) -> DataFrame:
    """``rows`` with the boolean ``name``: false where ``among`` is false, or no
    other row for which it is true has the key."""
    shared = shared_keys(rows.where(among).select(*key), *key)
    slot = _slot(*key)
    bit = F.expr(f"shiftright(bits, CAST({_SLOT.format(", ".join(key))} & 63 AS INT)) & 1") == 1
    # BITMAP_WORDS rows at most, so the broadcast is bounded.
    return rows.join(F.broadcast(shared), F.shiftright(slot, 6) == F.col("word"), "left").select(
        *rows.columns, (among & F.coalesce(bit, F.lit(False))).alias(name)
    )


def exact_groups(docs: DataFrame, prefix_bytes: int = PREFIX_BYTES, digest_all: bool = False) -> DataFrame:
    """(row_id, doc_id, keep_id, group_size, kept, full_sha256) per row.

    Of equal texts the row with the largest doc_id stays; of rows that repeat
    that doc_id exactly one stays (the last in scan order), a null doc_id
    counts as the smallest.  A null text is the empty text.  ``full_sha256``
    is null where refinement proved the text unique before the full hash;
    ``digest_all`` fills it in for those too, for a caller that wants it.
    ``row_id`` numbers the rows of ``docs`` as they are stored.  Other columns
    of ``docs`` are left out.
    """
    data = F.encode("text", "utf-8")
    rows = numbered(docs).select("row_id", "doc_id", "text", F.octet_length("text").alias("n_bytes"))
    rows = with_company(rows, "same_length", F.lit(True), "n_bytes")
    rows = rows.withColumn("prefix", F.xxhash64(F.substring(data, 1, prefix_bytes)))
    rows = with_company(rows, "same_prefix", F.col("same_length"), "n_bytes", "prefix")
    full = F.when(F.col("same_prefix"), F.sha2(data, 256)).alias("full_sha256")
    hashed = rows.select("row_id", "doc_id", full, *([F.sha2(data, 256).alias("digest")] if digest_all else []))
    groups = (
        hashed.where(F.col("full_sha256").isNotNull())
        .groupBy(F.col("full_sha256").alias("group_key"))
        .agg(F.count("*").alias("group_size"), F.max(F.struct("doc_id", "row_id")).alias("last"))
        .where("group_size > 1")
    )
    # A row without a full hash joins on its own number: nulls would all meet in one task.
    key = F.coalesce("full_sha256", F.col("row_id").cast("string"))
    alone = F.col("group_key").isNull()
    return hashed.join(groups, key == F.col("group_key"), "left").select(
        "row_id",
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("last.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).alias("group_size"),
        (alone | (F.col("row_id") == F.col("last.row_id"))).alias("kept"),
        F.col("digest" if digest_all else "full_sha256").alias("full_sha256"),
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """``docs``, all columns, without the rows that :func:`exact_groups` drops."""
    return without_rows(docs, exact_groups(docs).where(~F.col("kept")))
