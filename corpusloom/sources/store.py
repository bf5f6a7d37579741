"""Parquet sources and sinks: mirrors, the split cache, packed blocks, run logs."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.schemas import PACKED_COLUMNS, PACKED_SCHEMA


def scan_glob(spark: SparkSession, folder: str, pattern: str = "*.parquet", schema: T.StructType | None = None) -> DataFrame:
    """Read the files of a mirror's `data` folder whose name matches `pattern`; nothing beside it."""
    reader = spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", "true")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(f"{folder}/data")


LOG = "dataset string, split string, version string, n_rows bigint, committed_at timestamp"
FILES = "dataset string, split string, version string, file string, first bigint, last bigint"


def read_if_there(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """The Parquet table at `path`, or no rows where nothing was ever written."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def write_cache(df: DataFrame, path: str, order: Sequence[str] = (), finish: Callable[[DataFrame], DataFrame] = lambda rows: rows, placed: bool = False) -> str:
    """Columnar cache with a folder per dataset, split and version, rows in ranges of `order`; returns the version.

    Every call writes folders of its own and appends a row per dataset and split to `{path}/log` when they are
    whole; both go through Spark's committer.  Readers follow the log, so they never see a part of a write, a failed
    write leaves nothing to clean up, writers at the same time do not touch each other, and other datasets
    stay readable meanwhile.  Of several versions the last committed counts.  Old folders stay until their store is dropped.
    `finish` is applied to the rows once they are placed: what it adds is stored, not shuffled.
    `placed` says that the rows are in such ranges already.
    """
    spark, version = df.sparkSession, uuid.uuid4().hex
    ranges = df if placed else df.repartitionByRange("dataset", "split", *order)
    rows = finish(ranges.sortWithinPartitions("dataset", "split", *order))
    rows.withColumn("version", F.lit(version)).write.mode("append").partitionBy("dataset", "split", "version").parquet(f"{path}/data")
    # partition columns only: the counts come from the files' footers
    stored = _data(spark, path, rows.schema).where(F.col("version") == version)
    entries = stored.groupBy("dataset", "split", "version").agg(F.count(F.lit(1)).alias("n_rows"))
    entries.withColumn("committed_at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(f"{path}/log")
    return version


def _data(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    names = [f for f in schema.fields if f.name not in ("dataset", "split", "version")]
    places = [T.StructField(c, T.StringType()) for c in ("dataset", "split", "version")]
    return spark.read.schema(T.StructType([*names, *places])).parquet(f"{path}/data")


def committed(spark: SparkSession, path: str) -> DataFrame:
    """(dataset, split, version, n_rows): what readers of `path` see; a row per dataset and split."""
    last = F.max_by(F.struct("version", "n_rows"), F.struct("committed_at", "version"))
    return read_if_there(spark, f"{path}/log", LOG).groupBy("dataset", "split").agg(last.alias("_l")).select("dataset", "split", "_l.*")


def read_cache(spark: SparkSession, path: str, schema: T.StructType, split: str | None = None) -> DataFrame:
    """The committed rows of a cache; only the folders of the asked split and of the versions that count are listed."""
    entries = committed(spark, path) if split is None else committed(spark, path).where(F.col("split") == split)
    wanted = F.lit(False)
    for row in entries.collect():       # configured datasets and splits
        wanted = wanted | ((F.col("dataset") == row.dataset) & (F.col("split") == row.split) & (F.col("version") == row.version))
    return _data(spark, path, schema).where(wanted).drop("version")


def is_complete(spark: SparkSession, path: str) -> bool:
    """True when some write to `path` was committed."""
    return not committed(spark, path).isEmpty()


def cache_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("dataset", "split").agg(F.count(F.lit(1)).alias("n_rows"))


def write_packed(df: DataFrame, path: str, placed: bool = False) -> None:
    """Store packed blocks, in files of consecutive blocks, and list which file holds which.

    Labels that equal the ids and masks of ones are placed as marks, and made again where the block is written.
    Blocks that `pack_blocks` gathered in ranges are `placed`.
    """
    check_packed(df)
    known = {"labels": F.col("input_ids"), "attention_mask": F.array_repeat(F.lit(1), F.size("input_ids"))}
    marks = {f"_{c}": F.col(c).eqNullSafe(like) for c, like in known.items()}
    left = {c: F.when(~marks[f"_{c}"], F.col(c)) for c in known}
    made = {c: F.when(F.col(f"_{c}"), like).otherwise(F.col(c)) for c, like in known.items()}
    version = write_cache(df.withColumns({**marks, **left}), path, ["block_id"], lambda rows: rows.withColumns(made).drop(*marks), placed)
    rows = _data(df.sparkSession, path, PACKED_SCHEMA).where(F.col("version") == version)
    files = rows.select("dataset", "split", "version", F.col("_metadata.file_path").alias("file"), "block_id")
    spans = files.groupBy("dataset", "split", "version", "file").agg(F.min("block_id").alias("first"), F.max("block_id").alias("last"))
    spans.coalesce(1).write.mode("append").parquet(f"{path}/files")


def check_packed(df: DataFrame) -> None:
    missing = [c for c in PACKED_COLUMNS if c not in df.columns]
    if missing:
        raise ValueError(f"packed table lacks {missing}; it has {df.columns}")
    wrong = [c for c, kind in df.dtypes if c in PACKED_COLUMNS and kind != "array<int>"]
    if wrong:
        raise ValueError(f"packed columns {wrong} are not ARRAY<INT>")


def read_packed(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    """Packed blocks from a committed store; a split reads only its own folders."""
    if not is_complete(spark, path):
        raise FileNotFoundError(f"no complete packed store at {path}")
    # The stored schema is checked before the fixed one is imposed, so a store
    # without the packed columns fails instead of reading as nulls.
    check_packed(spark.read.parquet(f"{path}/data"))
    return read_cache(spark, path, PACKED_SCHEMA, split)


def blocks_at(spark: SparkSession, path: str, split: str, positions: Sequence[int], sources: Sequence[str]) -> DataFrame:
    """The blocks at `positions` of a split's concatenation of `sources`, numbered by `slot` in the order asked.

    Random access as a loader does it, a batch of positions at a time: the log says which source a position falls in,
    the file list which files hold the blocks, and only these files are opened; of them, only row groups that can
    hold an asked block are read.  A position may be asked for twice; one outside the split is an error.
    """
    sizes = {r.dataset: (r.version, r.n_rows) for r in committed(spark, path).where(F.col("split") == split).collect()}
    asked, start = [], 0
    for name in sources:
        version, n_rows = sizes.get(name, (None, 0))
        asked += [(slot, p, name, version, p - start) for slot, p in enumerate(positions) if start <= p < start + n_rows]
        start += n_rows
    if len(asked) < len(positions):
        raise IndexError(f"positions of {split} go from 0 to {start - 1}, asked for {min(positions)} to {max(positions)}")
    wanted = spark.createDataFrame(asked, "slot int, idx bigint, dataset string, version string, block_id bigint")
    spans = read_if_there(spark, f"{path}/files", FILES).where(F.col("split") == split)
    inside = wanted["block_id"].between(spans["first"], spans["last"]) & (spans["dataset"] == wanted["dataset"]) & (spans["version"] == wanted["version"])
    files = [r.file for r in spans.join(F.broadcast(wanted), inside, "left_semi").select("file").distinct().collect()]
    if not files:
        return spark.createDataFrame([], T.StructType([T.StructField("slot", T.IntegerType()), T.StructField("idx", T.LongType()), *PACKED_SCHEMA.fields]))
    rows = spark.read.schema(PACKED_SCHEMA).option("basePath", f"{path}/data").parquet(*sorted(files))
    rows = rows.where(F.col("block_id").isin(*sorted({block for *_, block in asked})))
    return rows.join(F.broadcast(wanted.drop("version")), ["dataset", "block_id"]).select("slot", "idx", *PACKED_SCHEMA.names)


def as_export(df: DataFrame) -> DataFrame:
    """64-bit token arrays, the type trainers read."""
    return df.withColumns({c: F.col(c).cast("array<bigint>") for c in PACKED_COLUMNS})


def append_log(df: DataFrame, path: str) -> None:
    """Append rows to a run log (metrics or generations)."""
    df.write.mode("append").parquet(path)
