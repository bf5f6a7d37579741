"""Run analytics over metric tables (run, step, name, value)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.arith import int_div
from corpusloom.functions.exact import exact_sum
from corpusloom.operators.ordering import ordered_index, running
from corpusloom.session import materialize


def number_steps(df: DataFrame, by: Sequence[str], time: str, tie: str) -> DataFrame:
    """`step`: dense position of each row in its run by time, ties by `tie`.

    Cells are hours and, inside them, seconds, so a run that holds most of the rows is
    ordered in parallel even when all of them fall into one hour.
    """
    levels = [[F.unix_date(F.col(time).cast("date")), F.hour(time)], [F.minute(time), F.second(time)]]
    return ordered_index(df, by, [time, tie], levels).withColumnRenamed("idx", "step").drop("n_rows")


def epoch_means(metrics: DataFrame, weight: str) -> DataFrame:
    """Step metrics rolled up per run, epoch and name, weighted by batch rows."""
    return metrics.groupBy("run", "epoch", "name").agg(
        F.count(F.lit(1)).alias("n_steps"),
        F.max_by("value", "step").alias("last_value"),
        (exact_sum(F.col("value") * F.col(weight)) / F.sum(weight)).alias("mean_value"),
    )


def every_n(metrics: DataFrame, batch_idx: str, n: int, by: Sequence[str] = ("run", "epoch")) -> DataFrame:
    """Rows whose 1-based batch number is a multiple of `n`; with n <= 0 the last row of each epoch."""
    if n > 0:
        return metrics.where((F.col(batch_idx) + 1) % n == 0)
    rest = [c for c in metrics.columns if c not in by]
    last = metrics.groupBy(*by).agg(F.max_by(F.struct(*rest), F.col(batch_idx)).alias("_last"))
    return last.select(*by, "_last.*").select(*metrics.columns)


def usable(value: str) -> Column:
    """The value where it is a finite number, else null."""
    wide = F.col(value).cast("double")
    finite = ~F.isnan(wide) & (F.abs(wide) != float("inf"))
    return F.when(finite, F.col(value))


def early_stop(checks: DataFrame, patience: int, mode: str = "min", by: Sequence[str] = ("run",)) -> DataFrame:
    """Where each run stops.

    `checks` has (by, step, value) with dense steps from 0.  A check improves when it
    is a finite number and beats every earlier one strictly.  A run stops at the first
    check that is `patience` checks past the last improvement (or past the start, before
    any), or that is NaN or infinite; a missing value waits like one that did not
    improve.  Both scans (best so far, last improvement) are two-level, so one long run
    is spread over many tasks.  Runs that never stop keep a null `stop_step` and their
    overall best; without a usable check the best is null.
    """
    if mode not in ("min", "max"):
        raise ValueError(f"mode is 'min' or 'max', got {mode!r}")
    by = list(by)
    lower = mode == "min"
    fn, pick = (F.min, F.least) if lower else (F.max, F.greatest)
    # read by both halves of the first scan; written, its lineage runs once
    checks = materialize(checks.select(*by, "step", "value", usable("value").alias("_value")), "checks")
    seen = running(checks, by, "step", "_value", fn, pick, "_best")
    better = F.col("_value") < F.col("_best") if lower else F.col("_value") > F.col("_best")
    improved = F.col("_value").isNotNull() & (F.col("_best").isNull() | better)
    marked = seen.withColumn("_improved", F.when(improved, F.col("step")))
    placed = running(marked, by, "step", "_improved", F.max, F.greatest, "_last", include_current=True)
    broken = F.col("value").isNotNull() & F.col("_value").isNull()
    waited = F.col("step") - F.coalesce("_last", F.lit(-1)) >= patience
    stop = F.when(broken | waited, F.col("step"))
    stops = placed.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_checks"),
        F.min(stop).alias("stop_step"),
        F.min_by(F.struct("_last", "_best"), stop).alias("_at_stop"),
        F.max("_last").alias("_final_step"),
        fn("_value").alias("_final_best"),
    )
    stopped = F.col("stop_step").isNotNull()
    return stops.select(
        *by,
        "n_checks",
        "stop_step",
        F.when(stopped, F.col("_at_stop._last")).otherwise(F.col("_final_step")).alias("best_step"),
        F.when(stopped, F.col("_at_stop._best")).otherwise(F.col("_final_best")).alias("best_value"),
    )


def best_checkpoints(checks: DataFrame, k: int, mode: str = "min", by: Sequence[str] = ("run",)) -> DataFrame:
    """The k best checks per run, ties to the earlier step; missing and non-finite values are never kept.

    The rank filter runs before the shuffle as well, so each task sends at most
    k rows per run.
    """
    order = F.col("value").asc() if mode == "min" else F.col("value").desc()
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(order, "step"))
    return checks.where(usable("value").isNotNull()).withColumn("checkpoint_rank", rank).where(F.col("checkpoint_rank") <= k)


def job_tally(jobs: DataFrame, by: Sequence[str], ok: Column) -> DataFrame:
    return jobs.groupBy(*by).agg(F.count_if(ok).alias("n_ok"), F.count_if(~ok).alias("n_failed"))


def with_epochs(metrics: DataFrame, steps_per_epoch: int) -> DataFrame:
    return metrics.withColumns(
        {"epoch": int_div(F.col("step"), steps_per_epoch), "batch_idx": F.col("step") % steps_per_epoch}
    )
