"""Packing of groups that arrive in parts, with the open groups as streaming state."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from corpusloom.schemas import BYTE_EOS

PARTITIONS = "spark.sql.shuffle.partitions"
EMPTY_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"
STATE = "arrived bigint, announced bigint, packed boolean, held binary"


@contextmanager
def _settings(spark: SparkSession, wanted: dict[str, str]):
    """Session settings for as long as the stream runs; the session's own come back afterwards."""
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def _packer(by: list[str], key: list[str], block_length: int, eos: int | None, wait_ms: int, remember_ms: int):
    """The state function.  Everything it needs is inside, so that workers need not import this module."""

    def blocks_of(rows: pd.DataFrame) -> list:
        import numpy as np

        mark = [] if eos is None else [np.array([eos], np.int32)]
        parts = [x for raw in rows.sort_values(key)["raw"] for x in (np.frombuffer(raw or b"", np.uint8).astype(np.int32), *mark)]
        tokens = np.concatenate([np.zeros(0, np.int32), *parts])
        return list(tokens[: len(tokens) // block_length * block_length].reshape(-1, block_length))

    def run(group: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        import pickle

        arrived, announced, packed, held = state.get if state.exists else (0, None, False, None)
        if state.hasTimedOut and packed:
            state.remove()
            return
        fresh = [] if state.hasTimedOut else [frame[[*key, "raw", "announced"]] for frame in frames]
        if packed:
            raise ValueError(f"rows of group {dict(zip(by, group))} arrived after it was packed")
        rows = pd.concat([*([pickle.loads(held)] if held else []), *fresh], ignore_index=True)
        said = rows["announced"].dropna()
        announced = int(said.max()) if len(said) else None
        if not state.hasTimedOut and (announced is None or len(rows) < announced):
            state.update((len(rows), announced, False, pickle.dumps(rows)))
            state.setTimeoutDuration(wait_ms)
            return
        state.update((len(rows), announced, True, None))
        state.setTimeoutDuration(remember_ms)
        blocks = blocks_of(rows)
        if blocks:
            named = {name: [value] * len(blocks) for name, value in zip(by, group)}
            yield pd.DataFrame({**named, "block_id": range(len(blocks)), "input_ids": blocks})

    return run


def pack_stateful(
    stream: DataFrame,
    by: Sequence[str],
    key: Sequence[str],
    raw: Column,
    block_length: int,
    sink: str,
    checkpoint: str,
    announced: Column | None = None,
    eos: int | None = BYTE_EOS,
    wait_ms: int = 3_600_000,
    remember_ms: int = 7 * 86_400_000,
    state_partitions: int | None = None,
) -> None:
    """Pack what has arrived into `sink` (by, block_id, input_ids), then stop.

    A group may come in any number of files and batches; its rows are packed in order of `key`, as a batch job
    would, once `announced` of them are there, or with the first batch that comes `wait_ms` after its last row.  Open
    groups wait in the checkpoint's state; a group is as large as the batch size it was cut with.  Rows of a group that was packed are an error
    for `remember_ms`: its blocks are out already.  The state has `state_partitions` parts, by default
    one per core, fixed by the checkpoint's first run.  The file sink commits each batch once.
    """
    spark = stream.sparkSession
    by, key = list(by), list(key)
    none = F.lit(None).cast("bigint")
    rows = stream.select(*by, *key, raw.alias("raw"), (none if announced is None else announced.cast("bigint")).alias("announced"))
    fields = {f.name: f for f in rows.schema}
    ids = [T.StructField("block_id", T.LongType()), T.StructField("input_ids", T.ArrayType(T.IntegerType()))]
    out = T.StructType([*(fields[b] for b in by), *ids])
    packer = _packer(by, key, block_length, eos, wait_ms, remember_ms)
    packed = rows.groupBy(*by).applyInPandasWithState(packer, out, STATE, "append", GroupStateTimeout.ProcessingTimeTimeout)
    # a batch costs a worker per partition of the state, full or not; batches without data would follow each other
    # for ever, as timers are pending
    partitions = str(state_partitions or spark.sparkContext.defaultParallelism)
    with _settings(spark, {PARTITIONS: partitions, EMPTY_BATCHES: "false"}):
        query = (
            packed.writeStream.format("parquet")
            .option("path", sink)
            .option("checkpointLocation", checkpoint)
            .outputMode("append")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
