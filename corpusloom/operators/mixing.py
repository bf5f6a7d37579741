"""Mixing sources: global order, shuffling, batches, ranks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.arith import ceil_div, int_div
from corpusloom.operators.ordering import Levels, ordered_index
from corpusloom.operators.permutation import permuted, unpermuted

RUN = 1 << 16           # positions that one row of a resumed epoch stands for


def concat_index(df: DataFrame, key: Sequence[str], levels: Levels, source: str = "source_ord") -> DataFrame:
    """`idx` over the concatenation of all sources of a split, in source order."""
    return ordered_index(df, ["split"], [source, *key], [[F.col(source)], *levels])


def shuffle_epoch(indexed: DataFrame, seed: int, epoch: int, train: str = "train") -> DataFrame:
    """`position` of each row in an epoch: shuffled for train, key order elsewhere.

    The position is computed from the row's index, the row count, seed and epoch alone: no sort, no
    shuffle, and the same order whenever it is asked for.
    """
    drawn = permuted(F.col("idx"), F.col("n_rows"), seed, epoch)
    return indexed.withColumn("position", F.when(F.col("split") == train, drawn).otherwise(F.col("idx")))


def resume_epoch(shuffled: DataFrame, seed: int, epoch: int, start: Column, train: str = "train") -> DataFrame:
    """(split, position, idx) of an epoch from position `start` on, without ordering what came before.

    `shuffled` has one row per split with `n_rows`; each remaining position names its row by the inverse order.
    Positions are made in runs of 2**16, and those in runs of as many, so one split is the work of many tasks.
    """
    first = F.greatest(start.cast("bigint"), F.lit(0))
    open_ = shuffled.where(F.col("n_rows") > first).select("split", "n_rows", first.alias("_first"), (F.col("n_rows") - 1).alias("_last"))
    wide = F.sequence(int_div(F.col("_first"), RUN * RUN), int_div(F.col("_last"), RUN * RUN))
    left = open_.withColumn("_wide", F.explode(wide)).repartition("split", "_wide")
    inside = F.sequence(
        F.greatest(F.col("_wide") * RUN, int_div(F.col("_first"), RUN)), F.least((F.col("_wide") + 1) * RUN - 1, int_div(F.col("_last"), RUN))
    )
    left = left.withColumn("_run", F.explode(inside)).repartition("split", "_run")
    low, high = F.greatest(F.col("_run") * RUN, F.col("_first")), F.least((F.col("_run") + 1) * RUN - 1, F.col("_last"))
    rows = left.select("split", "n_rows", F.explode(F.sequence(low, high)).alias("position"))
    drawn = unpermuted(F.col("position"), F.col("n_rows"), seed, epoch)
    return rows.select("split", "position", F.when(F.col("split") == train, drawn).otherwise(F.col("position")).alias("idx"))


def assign_batches(indexed: DataFrame, batch_size: int, index: str = "idx") -> DataFrame:
    """Fixed-size batches in index order; the last one may be short."""
    return indexed.withColumn("batch_id", int_div(F.col(index), batch_size)).withColumn(
        "batch_pos", F.col(index) % batch_size
    )


def rank_plan(indexed: DataFrame, world: int, batch_size: int, accumulate: int) -> DataFrame:
    """Rank, micro-batch and optimizer step of every slot.

    The slot count is padded to a multiple of `world` by starting over from the
    first rows, so a row may fill more than one slot.
    """
    n = F.col("n_rows")
    last = ceil_div(n, world) * world - 1
    slots = indexed.withColumn("slot", F.explode(F.sequence(F.col("idx"), last, n)))
    micro = int_div(int_div(F.col("slot"), world), batch_size)
    return slots.withColumns(
        {"rank": F.col("slot") % world, "micro_batch": micro, "opt_step": int_div(micro, accumulate)}
    )


def collect_batches(batched: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """One row per batch with its members in order; a group is one batch."""
    members = F.sort_array(F.collect_list(F.struct("batch_pos", *columns)))
    return batched.groupBy(*by, "batch_id").agg(members.alias("members"))
