"""Multi-select filter builder."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def in_filters(selections: Mapping[str, Sequence[object] | None]) -> Column:
    """AND of ``col IN (values)`` for every non-empty selection.

    An empty or missing list means "no restriction"; with no restriction at
    all the predicate is the literal ``true`` (Catalyst folds it away).
    """
    pred: Column | None = None
    for column, values in selections.items():
        if not values:
            continue
        term = F.col(column).isin(list(values))
        pred = term if pred is None else pred & term
    return pred if pred is not None else F.lit(True)
