"""String helpers (M2, M6, M9)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: separator of items in a printed itemset.
ITEM_SEPARATOR = ", "


def strip_ws(c: Column) -> Column:
    """Strip all leading/trailing whitespace (SQL ``trim`` removes spaces only).
    Text between two printable ASCII characters has none and skips the pattern."""
    bare = F.substring(c, 1, 1).between("!", "~") & F.substring(c, -1, 1).between("!", "~")
    return F.when(bare, c).otherwise(F.regexp_replace(c, r"^\s+|\s+$", ""))


def itemset_text(items: Column) -> Column:
    """Sorted items joined with ``", "`` -- the printable form of an itemset."""
    return F.array_join(F.array_sort(items), ITEM_SEPARATOR)
