"""Label arrays and the ignore index."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.schemas import IGNORE_INDEX


def ignore_pad(ids: Column, pad: int) -> Column:
    """Labels that score every token but padding."""
    return F.transform(ids, lambda x: F.when(x == pad, F.lit(IGNORE_INDEX)).otherwise(x))


def only_masked(ids: Column, mask: int, targets: Column | None = None) -> Column:
    """Labels that score masked positions only.

    Without `targets` the kept label is the mask id itself; with them it is the
    original token at that position.
    """
    if targets is None:
        return F.transform(ids, lambda x: F.when(x != mask, F.lit(IGNORE_INDEX)).otherwise(x))
    return F.zip_with(ids, targets, lambda x, t: F.when(x != mask, F.lit(IGNORE_INDEX)).otherwise(t))


def strip_ignored(labels: Column) -> Column:
    return F.filter(labels, lambda x: x != IGNORE_INDEX)


def equal_to_ids(labels: Column, ids: Column) -> Column:
    return labels.eqNullSafe(ids)
