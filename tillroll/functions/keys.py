"""Surrogate keys.

A key is the first 15 hex digits (60 bits) of the MD5 of the natural key's
text, read as a non-negative LONG.  It is deterministic across runs and
engines (the same value is ``cast('0x' || substr(md5(s), 1, 15) as bigint)``
in DuckDB), needs no sequence or shuffle, and never overflows the way
``abs(xxhash64(...))`` does for Long.MIN_VALUE under ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: separator of composite natural keys.
KEY_SEPARATOR = "|"


def _as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def surrogate_key(natural: Column | str) -> Column:
    """60-bit LONG key of the natural key's string form."""
    text = _as_col(natural).cast("string")
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def composite_key(*parts: Column | str) -> Column:
    """Key of several natural-key parts joined with ``|`` (nulls skipped)."""
    return surrogate_key(F.concat_ws(KEY_SEPARATOR, *[_as_col(p).cast("string") for p in parts]))
