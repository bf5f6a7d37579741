"""What several operators of this package share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def blank(text: str | Column) -> Column:
    """Null text counts as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; letters outside ASCII keep their case."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


def small_batches(batches: Iterable[pa.RecordBatch], most_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that each holds about `most_bytes`, or one row.

    Bounds a task's memory by bytes where Arrow bounds it by rows: a batch of
    very long texts is worked on a few rows at a time.
    """
    for batch in batches:
        rows = batch.num_rows
        if rows == 0:
            continue
        step = max(1, min(rows, rows * most_bytes // max(1, batch.nbytes)))
        for at in range(0, rows, step):
            yield batch.slice(at, step)
