"""Byte counts for people."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unit names, one 1024 step apart.
UNITS = ("KiB", "MiB", "GiB", "TiB", "PiB")


def human_size(size: Column) -> Column:
    """`N Bytes` below 1024, else one decimal and a unit; `N/A` when unknown.

    Works on integers, so the decimal is the exact quotient rounded half to even.
    """
    wide = size.cast("decimal(38,0)")
    out = F.when(size.isNull() | (size < 0), F.lit("N/A"))
    out = out.when(size < 1024, F.concat(size.cast("string"), F.lit(" Bytes")))
    for power, unit in enumerate(UNITS, start=1):
        step = F.lit(1024**power).cast("decimal(38,0)")
        rest = (wide * 10) % step
        whole = ((wide * 10 - rest) / step).cast("bigint")
        up = (rest * 2 > step) | ((rest * 2 == step) & (whole % 2 == 1))
        tenths = whole + F.when(up, 1).otherwise(0)
        text = F.concat(F.floor(tenths / 10).cast("string"), F.lit("."), (tenths % 10).cast("string"), F.lit(f" {unit}"))
        last = power == len(UNITS)
        out = out.otherwise(text) if last else out.when(size < 1024 ** (power + 1), text)
    return out
