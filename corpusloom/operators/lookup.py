"""Attach the columns of a keyed table to rows whose keys may be skewed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.session import materialize

MAX_BROADCAST_ROWS = 500_000
MAX_BROADCAST_BYTES = 64 << 20
HEAVY_SHARE = 4096          # a key is heavy when it holds 1/4096 of the rows
SALTS = 64                  # parts of a heavy key whose lookup row is too wide to broadcast


def fits_broadcast(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """True when both row count and approximate bytes are under the limits.

    Meant for written tables, where the count is metadata and the width check
    reads the string columns once.
    """
    widths = [F.octet_length(name) for name, kind in df.dtypes if kind == "string"]
    width = F.lit(16 * len(df.columns))
    for w in widths:
        width = width + F.coalesce(w, F.lit(0))
    size = df.agg(F.count(F.lit(1)).alias("n"), F.sum(width.cast("bigint")).alias("b")).first()
    return size.n <= max_rows and (size.b or 0) <= max_bytes


def keyed_lookup(
    rows: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    max_rows: int = MAX_BROADCAST_ROWS,
    heavy_share: int = HEAVY_SHARE,
    small: bool | None = None,
) -> DataFrame:
    """Left join of `rows` to `lookup` (unique on `on`), safe under key skew.

    A lookup of checked size is broadcast.  Otherwise the keys of `rows` are
    counted (combined before the shuffle); those holding at least
    1/`heavy_share` of all rows, at most `heavy_share` of them, are resolved
    first and broadcast, whether or not the lookup knows them.  What is left
    joins by shuffle, where no key can dominate a partition.  Heavy keys whose values are too
    wide to broadcast join by shuffle too, in SALTS parts each.  `small` carries the
    answer of a size check already made.
    """
    on = list(on)
    if fits_broadcast(lookup, max_rows) if small is None else small:
        return rows.join(F.broadcast(lookup), on, "left")
    values = [c for c in lookup.columns if c not in on]
    counts = materialize(rows.groupBy(*on).agg(F.count(F.lit(1)).alias("_n")), "key-counts")
    total = counts.agg(F.sum("_n")).first()[0] or 0
    heavy_keys = counts.where(F.col("_n") * heavy_share >= F.lit(total)).select(*on)
    heavy = materialize(heavy_keys.join(lookup, on, "left").withColumn("_heavy", F.lit(True)), "heavy-keys")
    columns, known = [*rows.columns, *values], ["_heavy", *values]
    if fits_broadcast(heavy):
        marked = rows.join(F.broadcast(heavy), on, "left")
        hot = marked.where("_heavy")
    else:
        marked = rows.join(F.broadcast(heavy.select(*on, "_heavy")), on, "left")        # names only, `heavy_share` of them at most
        known = ["_heavy"]
        spread = heavy.drop("_heavy").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        salted = marked.where("_heavy").withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))
        hot = salted.join(spread.hint("shuffle_hash"), [*on, "_salt"], "left")
    light = marked.where(F.col("_heavy").isNull()).drop(*known).join(lookup, on, "left")
    return hot.select(*columns).unionByName(light.select(*columns))


def most_frequent(table: DataFrame, count: str, max_rows: int) -> Column:
    """Condition for the rows of the largest magnitudes of `count`, `max_rows` of them at most."""
    sizes = table.groupBy(F.floor(F.log2(count)).alias("bits")).agg(F.count(F.lit(1)).alias("k")).collect()     # 63 rows at most
    least, seen = 62, 0
    for row in sorted(sizes, reverse=True):
        seen += row.k
        if seen > max_rows:
            break
        least = row.bits
    return F.col(count) >= (1 << int(least))
