"""Resumable ingest as a Structured Streaming job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T


def read_arriving(spark: SparkSession, folder: str, schema: T.StructType, files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder)


def ingest(stream: DataFrame, columns: Sequence[Column | str], sink: str, checkpoint: str) -> None:
    """Transform everything that has arrived and append it to `sink`, then stop.

    The checkpoint remembers the files already taken, so a rerun or a restart
    after a failure reads only what is new; the file sink commits each batch
    exactly once.
    """
    query = (
        stream.select(*columns)
        .writeStream.format("parquet")
        .option("path", sink)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def read_sink(spark: SparkSession, sink: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(sink)
