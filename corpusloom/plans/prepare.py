"""From a run configuration to batches a trainer reads.

`prepare` slices, tokenizes and packs what a run needs and is not stored yet;
`open_stage` checks and opens the stored splits of a stage; `order_for_epoch`
and `export` fix the order of an epoch and write it out by rank.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators import mixing
from corpusloom.operators.packing import Content, pack_blocks, pack_plan, text_bytes
from corpusloom.operators.slicing import multi_slice
from corpusloom.schemas import BLOCK_LENGTH, BYTE_EOS, PACK_BATCH_ROWS, PACKED_COLUMNS
from corpusloom.session import bucketed
from corpusloom.sources.corpora import CORPORA, CORPUS_CELLS, CORPUS_KEY, STAGE_SPLITS, Corpus, split_names
from corpusloom.sources.naming import parse_slice, storage_key, tokenizer_id
from corpusloom.sources.store import as_export, read_if_there

PLAN_SCHEMA = "dataset string, source_ord int, split string, start double, end double, storage_key string"
LOG = "storage_key string, dataset string, split string, n_blocks bigint, writer string, committed_at timestamp"
CLAIMS = "storage_key string, writer string, claimed_at timestamp"

# (rows with text, whether documents end in a mark) -> rows with text or ids, token column, token count column
Tokenize = Callable[[DataFrame, bool], tuple[DataFrame, Column | Content, Column]]


def by_bytes(rows: DataFrame, eos: bool) -> tuple[DataFrame, Content, Column]:
    content = text_bytes("text", BYTE_EOS if eos else None)
    return rows, content, content.count()


@dataclass(frozen=True)
class Packing:
    """Everything besides the slice that decides the content of a packed split."""

    tokenizer: str = "bytes"
    block_length: int = BLOCK_LENGTH
    eos: bool = True
    scope: str = "batch"
    batch_rows: int = PACK_BATCH_ROWS
    shards: int = 1
    tokenize: Tokenize = field(default=by_bytes, compare=False)

    def settings(self) -> dict[str, object]:
        return {
            "tokenizer": [tokenizer_id(self.tokenizer), f"{self.tokenize.__module__}.{self.tokenize.__qualname__}"],
            "length": self.block_length,
            "eos": self.eos,
            "scope": self.scope,
            "batch_rows": self.batch_rows,
            "shards": self.shards,
        }


def run_plan(
    spark: SparkSession, run_config: dict[str, dict], packing: Packing = Packing(), corpora: Sequence[Corpus] = CORPORA
) -> DataFrame:
    """A row per dataset and split of the run: its slice and its storage key."""
    known = {c.name: (order, c) for order, c in enumerate(corpora)}
    unknown = sorted(set(run_config) - set(known))
    if unknown:
        raise KeyError(f"unregistered datasets {unknown}; registered: {sorted(known)}")
    rows = []
    for name, options in run_config.items():
        strange = sorted(set(options or {}) - {"train_slice"})
        if strange:
            raise KeyError(f"unknown options {strange} of dataset {name!r}; known: ['train_slice']")
        order, corpus = known[name]
        for split, part in split_names(corpus, parse_slice((options or {}).get("train_slice"))).items():
            start, end = part or (None, None)
            key = storage_key(name, corpus.config, split, part, packing.settings())
            rows.append((name, order, split, start, end, key))
    return spark.createDataFrame(rows, PLAN_SCHEMA)


def read_manifest(spark: SparkSession, root: str) -> DataFrame:
    """What is stored under `root`: a row per finished dataset and split, with the writer whose copy counts.

    The log may hold a key twice, where two runs prepared it at the same time.  Both copies are whole and, as the key
    stands for all that decides the content, equal; the first committed is the one all readers take.
    """
    first = F.min_by(F.struct("dataset", "split", "n_blocks", "writer"), F.struct("committed_at", "writer"))
    return read_if_there(spark, f"{root}/log", LOG).groupBy("storage_key").agg(first.alias("_f")).select("storage_key", "_f.*")


def claim(spark: SparkSession, root: str, keys: Sequence[str], writer: str, lease_s: float) -> list[str]:
    """The keys of `keys` that `writer` should prepare: it says so in a log, and takes those nobody claimed before.

    A claim ends after `lease_s` seconds, so that one of a run that died holds nothing up.  Claims only save work: the
    commit log decides, whoever wrote.
    """
    now = F.current_timestamp()
    mine = spark.createDataFrame([(k, writer) for k in keys], "storage_key string, writer string")
    mine.withColumn("claimed_at", now).coalesce(1).write.mode("append").parquet(f"{root}/claims")
    live = spark.read.schema(CLAIMS).parquet(f"{root}/claims").where(F.col("claimed_at") > now - F.make_interval(secs=F.lit(lease_s)))
    owner = F.min_by("writer", F.struct("claimed_at", "writer"))
    owned = live.where(F.col("storage_key").isin(*keys)).groupBy("storage_key").agg(owner.alias("owner")).collect()
    others = {r.storage_key for r in owned if r.owner != writer}
    return [k for k in keys if k not in others]


def prepare(
    spark: SparkSession, rows: DataFrame, plan: DataFrame, root: str, packing: Packing = Packing(), lease_s: float | None = None
) -> int:
    """Slice, tokenize, pack and store every planned split that is not stored yet.

    All pending splits go through one job, into folders of this run.  They are listed in the log after the blocks are
    committed, with counts taken while they were written; folders that are not listed are never read.
    With `lease_s`, keys that another run claimed less than so many seconds ago are left to it.  Returns
    the number of splits prepared.
    """
    writer = uuid.uuid4().hex
    pending = plan.join(read_manifest(spark, root).select("storage_key"), "storage_key", "left_anti")
    names = pending.select(*[c for c in plan.columns if c != "source_ord"]).collect()      # configuration-sized
    if names and lease_s is not None:
        taken = set(claim(spark, root, [r.storage_key for r in names], writer, lease_s))
        names = [r for r in names if r.storage_key in taken]
    if not names:
        return 0
    todo = spark.createDataFrame(names, "dataset string, split string, start double, end double, storage_key string")
    by = ["dataset", "split"]
    sliced = bucketed(multi_slice(rows, todo.drop("storage_key"), CORPUS_KEY, CORPUS_CELLS), "sliced-texts", *by, *CORPUS_KEY)
    documents, ids, count = packing.tokenize(sliced, packing.eos)
    placed = pack_plan(
        documents, by, CORPUS_KEY, CORPUS_CELLS, count, packing.block_length, packing.scope, packing.batch_rows, packing.shards
    )
    blocks = pack_blocks(documents, placed, by, CORPUS_KEY, ids, packing.block_length)
    # the run's configuration: a row per dataset and split
    blocks = blocks.join(F.broadcast(todo.select(*by, "storage_key")), by)
    blocks = blocks.select("block_id", "pack_group", *PACKED_COLUMNS, "storage_key", F.lit(writer).alias("writer"))
    written, key = Observation(), F.col("storage_key")
    # observed behind the shuffle: before it, the sampling of the ranges would count too
    blocks = blocks.repartitionByRange("storage_key", "block_id").sortWithinPartitions("storage_key", "block_id")
    blocks = blocks.observe(written, *[F.count_if(key == r.storage_key).alias(f"n{i}") for i, r in enumerate(names)])
    blocks.write.mode("append").partitionBy("storage_key", "writer").parquet(f"{root}/blocks")
    counts = written.get
    done = [(r.storage_key, r.dataset, r.split, counts[f"n{i}"] or 0, writer) for i, r in enumerate(names)]
    entries = spark.createDataFrame(done, "storage_key string, dataset string, split string, n_blocks bigint, writer string")
    entries.withColumn("committed_at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(f"{root}/log")
    return len(names)


def open_stage(spark: SparkSession, plan: DataFrame, root: str, stage: str | None) -> DataFrame:
    """Packed blocks of all sources of a stage, or one error naming all that is missing."""
    if stage not in STAGE_SPLITS:
        raise ValueError(f"unknown stage {stage!r}; expected one of {list(STAGE_SPLITS)}")
    wanted = plan.where(F.col("split").isin(*STAGE_SPLITS[stage]))
    manifest = read_manifest(spark, root)
    missing = wanted.join(manifest.select("storage_key"), "storage_key", "left_anti")
    failures = (
        missing.groupBy("dataset").agg(F.sort_array(F.collect_list("split")).alias("splits")).orderBy("dataset").collect()
    )
    if failures:
        raise RuntimeError("splits not prepared: " + "; ".join(f"{r.dataset}: {', '.join(r.splits)}" for r in failures))
    keys = wanted.select("storage_key", "dataset", "source_ord", "split")
    stored = manifest.where("n_blocks > 0").join(keys.select("storage_key"), "storage_key", "left_semi").collect()
    if not stored:
        empty = ", ".join(["block_id bigint, pack_group bigint", *(f"{c} array<int>" for c in PACKED_COLUMNS)])
        return spark.createDataFrame([], f"{empty}, storage_key string, dataset string, source_ord int, split string")
    copies = reduce(or_, [(F.col("storage_key") == r.storage_key) & (F.col("writer") == r.writer) for r in stored])
    return spark.read.parquet(f"{root}/blocks").where(copies).drop("writer").join(F.broadcast(keys), "storage_key")


def order_for_epoch(blocks: DataFrame, seed: int, epoch: int, world: int, batch_size: int, accumulate: int) -> DataFrame:
    """Rank, micro-batch and optimizer step of every block in an epoch.

    Only the blocks' keys are ordered; the ids join at the end.  Labels and mask follow
    from the ids and are made at `export`.
    """
    keys = blocks.select("split", "source_ord", "block_id")
    levels = [["shiftright(block_id, 20)"]]
    indexed = mixing.concat_index(keys, ["block_id"], levels)
    shuffled = mixing.shuffle_epoch(indexed, seed, epoch).drop("idx").withColumnRenamed("position", "idx")
    slots = mixing.rank_plan(shuffled, world, batch_size, accumulate).drop("n_rows", "idx")
    return blocks.drop("labels", "attention_mask").join(slots.hint("shuffle_hash"), ["split", "source_ord", "block_id"])


def export(ordered: DataFrame, path: str) -> None:
    """Write an epoch for trainers: a folder per split and rank, files in slot order, 64-bit arrays."""
    rows = ordered.repartitionByRange("split", "rank", "slot").sortWithinPartitions("split", "rank", "slot")
    ids = F.col("input_ids")
    rows = as_export(rows.withColumns({"labels": ids, "attention_mask": F.array_repeat(F.lit(1), F.size(ids))}))
    rows.write.partitionBy("split", "rank").parquet(path)
