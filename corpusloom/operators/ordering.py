"""Order-dependent work without a single-task window.

A window with no partition key runs in one task, and a window over a hot key
runs that key in one task.  Here every ordered computation is split in two:
rows are counted per *cell* (a contiguous slice of the sort key), the small
cell table gets its running totals, and only then is each cell ordered on its
own.  Cells nest in levels so that no window partition can grow with the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.session import materialize

Levels = Sequence[Sequence[str | Column]]      # strings are SQL expressions


def integer_levels(*key: str, wide: bool = True) -> Levels:
    """Cell levels for an integer sort key of one or two columns.

    At most 2**20 consecutive values share a cell, and at most 2**20 cells a parent,
    so ids spread over the whole 64-bit range are fine.  `wide=False` leaves the parents
    out, for ids known to count up (a million cells for 10**12 rows).  A second column
    splits each value of the first, so a hot leading value covers many cells.
    """
    lead = f"cast({key[0]} as bigint)"
    levels = [[f"shiftright({lead}, 40)"]] if wide else []
    levels.append([f"shiftright({lead}, 20)"])
    if len(key) == 2:
        levels.append([lead, f"shiftright(cast({key[1]} as bigint), 20)"])
    return levels


def _running_before(measure: str, window) -> Column:
    upto = F.sum(measure).over(window.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return upto - F.col(measure)


def cell_offsets(cells: DataFrame, by: list[str], levels: list[list[str]], measures: list[str]) -> DataFrame:
    """Per cell, the sum of each measure over all earlier cells of `by`, and the total.

    `cells` has one row per combination of `by` and the level columns.
    """
    parent = by + [c for level in levels[:-1] for c in level]
    here = Window.partitionBy(*parent).orderBy(*levels[-1])
    local = [_running_before(m, here).alias(f"{m}_before") for m in measures]
    if len(levels) == 1:
        whole = Window.partitionBy(*by)
        totals = [F.sum(m).over(whole).alias(f"{m}_total") for m in measures]
        return cells.select(*parent, *levels[-1], *local, *totals)
    parents = cells.groupBy(*parent).agg(*[F.sum(m).alias(m) for m in measures])
    above = cell_offsets(parents, by, levels[:-1], measures)
    above = above.withColumnsRenamed({f"{m}_before": f"{m}_above" for m in measures})
    joined = cells.select(*parent, *levels[-1], *local).join(above, parent)
    return joined.select(
        *parent,
        *levels[-1],
        *[(F.col(f"{m}_before") + F.col(f"{m}_above")).alias(f"{m}_before") for m in measures],
        *[f"{m}_total" for m in measures],
    )


def ordered_index(
    df: DataFrame,
    by: Sequence[str],
    key: Sequence[str | Column],
    levels: Levels,
    weights: Sequence[str] = (),
) -> DataFrame:
    """Add the dense 0-based `idx` of each row inside `by`, ordered by `key`.

    Also adds `n_rows` (rows in `by`) and, for each weight column `w`,
    `w_before` (sum over earlier rows) and `w_total`.  `levels` must cut the
    key order into contiguous cells, coarse to fine.  `by` and `key` hold no
    nulls, and `key` is unique inside `by`.
    """
    by = list(by)
    names = [[f"_cell{i}_{j}" for j in range(len(level))] for i, level in enumerate(levels)]
    flat = [n for level in names for n in level]
    exprs = [F.expr(e) if isinstance(e, str) else e for level in levels for e in level]
    rows = df.select("*", *[e.alias(n) for e, n in zip(exprs, flat)])
    measures = ["_rows", *[f"_w_{w}" for w in weights]]
    cells = rows.groupBy(*by, *flat).agg(
        F.count(F.lit(1)).alias("_rows"), *[F.sum(w).alias(f"_w_{w}") for w in weights]
    )
    offsets = cell_offsets(cells, by, names, measures)
    inside = Window.partitionBy(*by, *flat).orderBy(*key)
    ranked = rows.select(
        "*",
        (F.row_number().over(inside) - 1).cast("bigint").alias("_pos"),
        *[_running_before(w, inside).alias(f"_in_{w}") for w in weights],
    )
    return ranked.join(offsets, [*by, *flat]).select(
        *df.columns,
        (F.col("_pos") + F.col("_rows_before")).alias("idx"),
        F.col("_rows_total").alias("n_rows"),
        *[(F.col(f"_in_{w}") + F.col(f"_w_{w}_before")).alias(f"{w}_before") for w in weights],
        *[F.col(f"_w_{w}_total").alias(f"{w}_total") for w in weights],
    )


def _prefixes(cells: DataFrame, by: list[str], fn, pick, bits: int, tiers: int) -> DataFrame:
    """`_prefix` of each `_cell`: `fn` over `_v` of all earlier cells.

    Cells are scanned inside parents of 2**bits, parents inside theirs, so no window is longer
    than that below the last tier.
    """
    if not tiers:
        earlier = Window.partitionBy(*by).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
        return cells.select(*by, "_cell", fn("_v").over(earlier).alias("_prefix"))
    up = F.shiftright("_cell", bits).alias("_up")
    earlier = Window.partitionBy(*by, "_up").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    local = cells.select(*by, up, "_cell", "_v").withColumn("_local", fn("_v").over(earlier))
    parents = cells.groupBy(*by, up).agg(fn("_v").alias("_v")).withColumnRenamed("_up", "_cell")
    above = _prefixes(parents, by, fn, pick, bits, tiers - 1).withColumnsRenamed({"_cell": "_up", "_prefix": "_above"})
    return local.join(above, [*by, "_up"]).select(*by, "_cell", pick("_local", "_above").alias("_prefix"))


def running(
    df: DataFrame,
    by: Sequence[str],
    pos: str,
    value: str,
    fn,
    pick,
    out: str,
    include_current: bool = False,
    cell_bits: int = 16,
    tiers: int = 1,
) -> DataFrame:
    """Running min or max of `value` over the dense position `pos` inside `by`.

    `fn` is the aggregate (`F.min`/`F.max`), `pick` its row-wise form
    (`F.least`/`F.greatest`, which skip nulls).  Positions fall into cells of 2**cell_bits, cells into
    parents of as many, and so on for `tiers`: with the defaults no window is over 2**16 rows up to 2**48 positions.
    """
    by = list(by)
    rows = df.withColumn("_cell", F.shiftright(F.col(pos).cast("bigint"), cell_bits))
    cells = rows.groupBy(*by, "_cell").agg(fn(value).alias("_v"))
    prefix = _prefixes(cells, by, fn, pick, cell_bits, tiers)
    last = Window.currentRow if include_current else -1
    inside = Window.partitionBy(*by, "_cell").orderBy(pos).rowsBetween(Window.unboundedPreceding, last)
    return (
        rows.withColumn("_local", fn(value).over(inside))
        .join(prefix, [*by, "_cell"])
        .withColumn(out, pick("_local", "_prefix"))
        .drop("_cell", "_local", "_prefix")
    )


def ranked_table(df: DataFrame, order: Sequence[Column], out: str, start: int, tag: str) -> DataFrame:
    """Write `df` range-sorted by a unique order and number its rows from `start`.

    For sort keys that have no natural integer cells (strings): the sort
    balances the ranges itself, each sorted partition is one cell, and the
    offsets table has one row per partition.
    """
    numbered = df.orderBy(*order).withColumn("_seq", F.monotonically_increasing_id())
    stored = materialize(numbered, tag)
    part = F.shiftright("_seq", 33)
    sizes = stored.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    starts = sizes.select("_part", _running_before("_n", Window.orderBy("_part")).alias("_start"))
    return (
        stored.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")
        .withColumn(out, (F.col("_start") + F.col("_seq").bitwiseAND((1 << 33) - 1) + start).cast("int"))
        .drop("_part", "_start", "_seq")
    )
