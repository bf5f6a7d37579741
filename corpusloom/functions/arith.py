"""Integer arithmetic on columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def int_div(a: Column, b: Column | int) -> Column:
    """Integral quotient as BIGINT, exact beyond the precision of doubles."""
    return F.call_function("div", a.cast("bigint"), b.cast("bigint") if isinstance(b, Column) else F.lit(b).cast("bigint"))


def ceil_div(a: Column, b: Column | int) -> Column:
    """Quotient of non-negative integers rounded up."""
    return int_div(a + b - 1, b)
