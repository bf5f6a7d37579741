"""Masked cross-entropy and perplexity over tables of logits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.exact import exact_mean


def cross_entropy(logits: Column, target: Column) -> Column:
    """logsumexp(logits) - logits[target], with the maximum taken out first."""
    top = F.array_max(logits)
    spread = F.aggregate(logits, F.lit(0.0), lambda a, x: a + F.exp(x - top))
    return top + F.log(spread) - F.get(logits, target)


def row_losses(df: DataFrame, logits: str, target: str, ignore_index: int, keep: Sequence[str]) -> DataFrame:
    """Loss per row; null where the target is the ignored id.  Logits are never shifted.

    `bad_target` marks rows whose target is neither ignored nor a place in the logits:
    they have no loss, and the batch says how many there are.
    """
    wide = F.col(logits).cast("array<double>")
    aimed = F.coalesce(F.col(target) != ignore_index, F.lit(True))
    inside = F.coalesce((F.col(target) >= 0) & (F.col(target) < F.size("_logits")), F.lit(False))
    loss = F.when(aimed & inside, cross_entropy(F.col("_logits"), F.col(target)))
    return df.select(*keep, target, wide.alias("_logits")).select(
        *keep, target, loss.alias("loss"), (aimed & ~inside).alias("bad_target")
    )


def batch_losses(losses: DataFrame, batch: Sequence[str]) -> DataFrame:
    """Mean loss per batch over scored rows; null when every row is ignored."""
    return losses.groupBy(*batch).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count("loss").alias("n_scored"),
        F.count_if("bad_target").alias("n_bad"),
        exact_mean(F.col("loss")).alias("loss"),
    )


def perplexity(batches: DataFrame) -> DataFrame:
    """Both readings: mean of the batches' exp(loss), and exp of the mean batch loss."""
    return batches.agg(
        F.count("loss").alias("n_batches"),
        exact_mean(F.col("loss")).alias("mean_loss"),
        exact_mean(F.exp("loss")).alias("mean_of_exp"),
        F.exp(exact_mean(F.col("loss"))).alias("exp_of_mean"),
    )
