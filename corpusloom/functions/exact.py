"""Sums of doubles that do not depend on the order of the rows.

Adding doubles rounds at every step, so a sum changes with the partitioning.  Here each value is cut into
its whole part and its fraction, both exact as doubles, and the parts are added as decimals of fixed scale:
additions of integers, which commute.  One rounding is left, at the end.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# 18 digits before the point and 20 after it; sums of 10**10 such values fit.
WHOLE, FRACTION = "decimal(28,0)", "decimal(28,20)"
LIMIT = 1e18


def exact_sum(value: Column) -> Column:
    """Sum of a double column; null for no values.

    Fractions are kept to 20 decimal places.  A value that is NaN, infinite or 10**18 and more in size has no
    such parts; with one of these the sum is the plain one of those alone.
    """
    wide = value.cast("double")
    fits = F.abs(wide) < LIMIT      # false for NaN, which is larger than any number
    return F.coalesce(F.sum(F.when(~fits, wide)), sum_of_parts(*exact_parts(F.when(fits, wide))))


def exact_parts(value: Column) -> tuple[Column, Column]:
    """Whole part and fraction of a finite double under 10**18, as decimals; a table that many rows look up holds them ready."""
    wide = value.cast("double")
    fraction = wide % 1
    return (wide - fraction).cast(WHOLE), fraction.cast(FRACTION)


def sum_of_parts(whole: Column, fraction: Column) -> Column:
    """`exact_sum` of values given as their `exact_parts`."""
    return (F.sum(whole).cast("decimal(38,10)") + F.sum(fraction).cast("decimal(38,18)")).cast("double")


def exact_mean(value: Column, weight: Column | None = None) -> Column:
    """Mean of a double column, weighted where a weight is given; rows without a value do not weigh."""
    if weight is None:
        return exact_sum(value) / F.count(value)
    return exact_sum(value * weight) / F.sum(F.when(value.isNotNull(), weight))
