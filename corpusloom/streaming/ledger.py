"""Ingest of files that may be damaged, with a ledger of what became of each."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.session import materialize
from corpusloom.sources.store import read_if_there

ATTEMPTS = 5
LEDGER = "path string, size bigint, modified timestamp, status string, n_rows bigint, error string, run string"


def file_states(spark: SparkSession, ledger: str) -> DataFrame:
    """(path, size, modified, status, n_rows, error, attempts): how each version of a file stands; `taken` or `damaged`."""
    rows = read_if_there(spark, ledger, LEDGER)
    # a version is taken once at most; before that every attempt has its row
    last = F.max_by(F.struct("status", "n_rows", "error"), F.col("status") == "taken")
    return rows.groupBy("path", "size", "modified").agg(last.alias("_l"), F.count(F.lit(1)).alias("attempts")).select(
        "path", "size", "modified", "_l.*", "attempts"
    )


def waiting_files(spark: SparkSession, folder: str, ledger: str, pattern: str, attempts: int = ATTEMPTS) -> DataFrame:
    """(path, size, modified) of the files that were not taken in this version and not tried `attempts` times."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(folder)
    files = found.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))     # contents are not read
    over = file_states(spark, ledger).where((F.col("status") == "taken") | (F.col("attempts") >= attempts))
    return files.join(over, ["path", "size", "modified"], "left_anti")


def take_files(
    spark: SparkSession, folder: str, schema: T.StructType, sink: str, ledger: str, pattern: str = "*.parquet", attempts: int = ATTEMPTS, most_files: int = 10_000
) -> int:
    """Append the rows of what is waiting in `folder` to `sink`; returns how many files were tried.

    A file is read as a whole, so a damaged one gives no rows but an entry in the ledger, and is tried again by later
    runs, five times in all; a file that is replaced starts anew.  A run writes a folder of its own and counts
    when its entries are in the ledger, so one that fails in between leaves nothing behind that is read.  A run takes
    `most_files` files at most, the rest is left to the next.
    """
    todo = waiting_files(spark, folder, ledger, pattern, attempts).orderBy("path").limit(most_files).collect()      # names only, bounded
    if not todo:
        return 0
    run_id, names = uuid.uuid4().hex, schema.names
    layout = spark.createDataFrame([], schema).toArrow().schema
    kinds = [("path", pa.string()), ("status", pa.string()), ("n_rows", pa.int64()), ("error", pa.string())]
    out = pa.schema([*[pa.field(n, k) for n, k in kinds], pa.field("row", pa.struct(list(layout)))])

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq

        def entry(path: str, status: str, n: int, error: str | None) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([{"path": path, "status": status, "n_rows": n, "error": error, "row": None}], schema=out)

        for batch in batches:
            for path, content in zip(*batch.columns):
                name, n = path.as_py(), 0
                try:
                    file = pq.ParquetFile(pa.BufferReader(content.as_buffer()))
                    for part in file.iter_batches(1024, columns=names):
                        rows = pa.Table.from_batches([part]).select(names).cast(layout).combine_chunks().to_batches()
                        for piece in rows:
                            nothing = [pa.nulls(piece.num_rows, k) for _, k in kinds[1:]]
                            yield pa.RecordBatch.from_arrays([pa.array([name] * piece.num_rows), *nothing, piece.to_struct_array()], schema=out)
                            n += piece.num_rows
                    yield entry(name, "taken", n, None)
                except (pa.ArrowException, OSError, KeyError) as error:
                    yield entry(name, "damaged", 0, f"{type(error).__name__}: {error}"[:300])

    # what the store itself cannot deliver is passed over here and has no outcome
    files = spark.read.format("binaryFile").option("ignoreCorruptFiles", "true").load([r.path for r in todo]).select("path", "content")
    row = ", ".join(f"`{f.name}`: {f.dataType.simpleString()}" for f in schema)
    staged = materialize(files.mapInArrow(read, f"path string, status string, n_rows bigint, error string, row struct<{row}>"), "staged-files")
    outcomes = staged.where("status IS NOT NULL").select("path", "status", "n_rows", "error")
    whole = F.broadcast(outcomes.where("status = 'taken'").select("path"))       # a row per file, `most_files` at most
    # rows that a file gave before it proved damaged stay behind
    staged.where("status IS NULL").join(whole, "path", "left_semi").select("row.*").write.parquet(f"{sink}/run={run_id}")
    versions = spark.createDataFrame([(r.path, r.size, r.modified) for r in todo], "path string, size bigint, modified timestamp")
    status, n, why = F.coalesce("status", F.lit("damaged")), F.coalesce("n_rows", F.lit(0).cast("bigint")), F.coalesce("error", F.lit("unreadable"))
    entries = versions.join(outcomes, "path", "left").select(
        "path", "size", "modified", status.alias("status"), n.alias("n_rows"), F.when(status == "damaged", why).alias("error"), F.lit(run_id).alias("run")
    )
    entries.coalesce(1).write.mode("append").parquet(ledger)
    return len(todo)


def taken_rows(spark: SparkSession, schema: T.StructType, sink: str, ledger: str) -> DataFrame:
    """The rows of all finished runs."""
    runs = [r.run for r in read_if_there(spark, ledger, LEDGER).select("run").distinct().collect()]
    if not runs:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{sink}/run={run}" for run in runs])
