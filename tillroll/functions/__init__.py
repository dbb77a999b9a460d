"""Column-level building blocks (pure ``Column -> Column`` helpers)."""

from tillroll.functions.dates import DOW_ORDER, day_name, is_weekend
from tillroll.functions.filters import in_filters
from tillroll.functions.keys import composite_key, surrogate_key
from tillroll.functions.text import itemset_text, strip_ws

__all__ = [
    "DOW_ORDER",
    "composite_key",
    "day_name",
    "in_filters",
    "is_weekend",
    "itemset_text",
    "strip_ws",
    "surrogate_key",
]
