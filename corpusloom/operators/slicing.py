"""Contiguous slices of a source by fraction of its rows."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.operators.ordering import Levels, ordered_index


def head_bounds(n: Column, fraction: Column) -> tuple[Column, Column]:
    """First max(1, ceil(n*p)) rows."""
    return F.lit(0).cast("bigint"), F.greatest(F.lit(1).cast("bigint"), F.ceil(n * fraction))


def range_bounds(n: Column, start: Column, end: Column) -> tuple[Column, Column]:
    """Rows [int(n*s), min(int(n*e), n))."""
    return F.floor(n * start), F.least(F.floor(n * end), n.cast("bigint"))


def percent_bounds(n: Column, percent: float) -> tuple[Column, Column]:
    """`[:p%]` rounded to the nearest row; a percent outside (0, 100] means all."""
    whole = n.cast("bigint")
    if not 0 < percent <= 100:
        return F.lit(0).cast("bigint"), whole
    return F.lit(0).cast("bigint"), F.rint(F.lit(float(percent)) * n / F.lit(100.0)).cast("bigint")


def require_rows(lo: Column, hi: Column) -> Column:
    """`lo`, or an error when the slice holds no row."""
    message = F.concat(F.lit("empty slice: start="), lo.cast("string"), F.lit(", end="), hi.cast("string"))
    return F.when(lo < hi, lo).otherwise(F.raise_error(message).cast("bigint"))


def slice_keys(indexed: DataFrame, by: Sequence[str], key: Sequence[str], lo: Column, hi: Column) -> DataFrame:
    """First and last key of the slice per group: one row per group.

    `indexed` carries `idx` and `n_rows`.  A slice is contiguous in key order,
    so these two keys say everything about it.
    """
    # `lo` and `hi` depend on n_rows only, the same in every row of a group
    inside = indexed.where((F.col("idx") >= require_rows(lo, hi)) & (F.col("idx") < hi))
    packed = F.struct(*key)
    return inside.groupBy(*by).agg(F.min(packed).alias("first"), F.max(packed).alias("last"))


def in_key_ranges(limits: DataFrame, by: Sequence[str], key: Sequence[str], source: str | None = None) -> Column:
    """Condition that a row lies in its group's slice.

    `limits` has one row per configured dataset and split; its keys are read
    here so that the scan receives literal ranges.  The ranges of the lead key
    are stated once more on their own (per `source`, a column that is constant
    in each branch of a union): in that form Parquet can skip row groups.
    """
    packed = F.struct(*key)
    reach, exact = F.lit(False), F.lit(False)
    for row in limits.collect():
        first, last = tuple(row["first"]), tuple(row["last"])
        lead = F.col(key[0]).between(first[0], last[0])
        inside = lead
        if len(key) > 1:
            ends = [F.struct(*[F.lit(v).cast("bigint").alias(k) for k, v in zip(key, end)]) for end in (first, last)]
            inside = inside & (packed >= ends[0]) & (packed <= ends[1])
        for name in by:
            inside = inside & (F.col(name) == F.lit(row[name]))
        reach = reach | ((F.col(source) == F.lit(row[source])) & lead if source else lead)
        exact = exact | inside
    return reach & exact


def slice_rows(
    df: DataFrame,
    by: Sequence[str],
    key: Sequence[str],
    levels: Levels,
    bounds,
) -> DataFrame:
    """Whole rows of each group's slice.

    Only the key columns are indexed and shuffled.  The rows themselves are
    filtered by key range where they are scanned, so the text never moves and
    row groups outside the slice are not read.  `bounds` maps the group's row
    count to (lo, hi); groups are configured splits, never data values.
    """
    by = list(by)
    indexed = ordered_index(df.select(*by, *key), by, key, levels)
    lo, hi = bounds(F.col("n_rows"))
    return df.where(in_key_ranges(slice_keys(indexed, by, key, lo, hi), by, key))


def multi_slice(df: DataFrame, plan: DataFrame, key: Sequence[str], levels: Levels) -> DataFrame:
    """Apply a slice plan (dataset, split, start, end) to many sources in one pass.

    A null start and end keeps the whole split; a split not in the plan is not
    read.  `plan` is run configuration: a row per dataset and split.
    """
    by = ["dataset", "split"]
    keys = df.drop("text").join(F.broadcast(plan), by)
    lo, hi = range_bounds(
        F.col("n_rows"),
        F.coalesce("start", F.lit(0.0)),
        F.coalesce("end", F.lit(1.0)),
    )
    limits = slice_keys(ordered_index(keys, by, key, levels), by, key, lo, hi)
    return df.where(in_key_ranges(limits, by, key, source="dataset"))


def first_rows(df: DataFrame, by: str, order: Sequence[str], n: int, keys: DataFrame, widen: int = 16) -> DataFrame:
    """The first `n` rows of each group by a unique order, numbered in `sample`.

    `keys` is the source before any filter, with `by` and the lead key: its least and largest key per group say where to
    look.  The rows are then read in key ranges, literal in the scan so that row groups beyond them are skipped: one of
    `n` keys, and `widen` times as many again and again until every group has `n` rows or is read to its end.
    Groups are configured datasets.
    """
    lead = order[0]
    ends = keys.groupBy(by).agg(F.min(lead).alias("lo"), F.max(lead).alias("hi"))
    reach = {r[by]: [r.lo, min(r.lo + n, r.hi), r.hi] for r in ends.collect()}      # a row per dataset
    open_, span = set(reach), n

    def within(names: Iterable) -> Column:
        each = [(F.col(by) == F.lit(name)) & F.col(lead).between(reach[name][0], reach[name][1]) for name in sorted(names)]
        return reduce(or_, each, F.lit(False))

    while open_:
        found = {r[by]: r["count"] for r in df.where(within(open_)).groupBy(by).count().collect()}
        open_ = {name for name in open_ if found.get(name, 0) < n and reach[name][1] < reach[name][2]}
        span *= widen
        for name in open_:
            reach[name][1] = min(reach[name][0] + span, reach[name][2])
    rank = F.row_number().over(Window.partitionBy(by).orderBy(*order))
    return df.where(within(reach)).withColumn("sample", rank).where(F.col("sample") <= n)
