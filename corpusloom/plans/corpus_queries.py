"""Registered queries over sources: scans, splits, slices, mixing, manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions import text as txt
from corpusloom.functions.arith import int_div
from corpusloom.operators import manifest, mixing
from corpusloom.operators.slicing import (
    first_rows,
    head_bounds,
    multi_slice,
    percent_bounds,
    range_bounds,
    slice_rows,
)
from corpusloom.plans import fixtures as fx
from corpusloom.plans.prepare import run_plan
from corpusloom.schemas import BATCH_SIZE
from corpusloom.session import scratch_path
from corpusloom.sources import corpora, registry, store
from corpusloom.sources.corpora import CORPUS_CELLS, CORPUS_KEY, read_table, scan_corpora
from corpusloom.sources.naming import parse_slice

PLACE = ["dataset", "split", "key1", "key2"]


def latest_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read_table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "value", "props")
    return registry.latest_by_key(events, ["user_id", "event_type"], "event_id")


def scan_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpora.scan_split(read_table(spark, sf_dir, "documents"), "doc_id", "train")


def split_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_corpora(spark, sf_dir).select(*PLACE)


def split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpora.split_counts(scan_corpora(spark, sf_dir))


def stage_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpora.stage_totals(scan_corpora(spark, sf_dir))


def _cached(spark: SparkSession, sf_dir: str) -> tuple[str, T.StructType]:
    path, rows = scratch_path(spark, "cache"), scan_corpora(spark, sf_dir).select(*PLACE, "text")
    store.write_cache(rows, path, CORPUS_KEY)
    return path, rows.schema


def stage_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stage's rows from the cache, whose folders of other splits are not listed."""
    return corpora.select_stage(store.read_cache(spark, *_cached(spark, sf_dir)), "fit").select(*PLACE)


def scan_glob(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mirror with other files in its data folder and other Parquet beside it; neither is read."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars", "text")
    folder = scratch_path(spark, "mirror")
    docs.write.parquet(f"{folder}/data")
    docs.limit(1).write.parquet(f"{folder}/other")
    docs.select("source").distinct().write.text(f"{folder}/data/notes")
    return store.scan_glob(spark, folder, "*.parquet", docs.schema)


def cache_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.cache_counts(store.read_cache(spark, *_cached(spark, sf_dir)))


def text_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    column = txt.resolve_text_column(pages, "text")
    return pages.select("page_id", F.lit(column).alias("text_column"), F.col(column).alias("text"))


def text_coalesce(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages whose url is blank on every 7th id fall through to the next column."""
    pages = read_table(spark, sf_dir, "pages")
    pages = pages.withColumn("url", F.when(F.col("page_id") % 7 == 0, F.lit(" \n")).otherwise(F.col("url")))
    return pages.select("page_id", txt.first_nonblank(pages, "text").alias("text"))


def text_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.gappy_documents(spark, sf_dir).select(
        "doc_id",
        txt.normalise(F.col("text")).alias("text"),
        txt.normalise(F.col("n_chars")).alias("n_chars_text"),
    )


def nonblank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return txt.drop_blank(fx.blanked_documents(spark, sf_dir), "text").select("doc_id", "text")


def manifest_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source")
    scans = read_table(spark, sf_dir, "labels").select(
        "doc_id", F.when(F.col("toxic") == 0, "ok").when(F.col("toxic") == 1, "infected").alias("scan_result")
    )
    return docs.join(scans, "doc_id", "left").withColumn("safety", manifest.classify_scan(F.col("scan_result")))


def catalog_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.search(fx.catalog(spark, sf_dir), "RED")


def catalog_configs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.configs(fx.catalog(spark, sf_dir))


def size_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.size_estimates(fx.files(spark, sf_dir))


def size_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.size_total(manifest.size_estimates(fx.files(spark, sf_dir)))


def unregistered_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = spark.createDataFrame([(f"src{i}",) for i in range(15)], "source string")
    return registry.unregistered(read_table(spark, sf_dir, "documents"), "source", names)


def missing_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every corpus was prepared except the benchmark's test split."""
    present = scan_corpora(spark, sf_dir).where(~((F.col("dataset") == "benchmark") & (F.col("split") == "test")))
    return registry.missing_splits(registry.planned_splits(registry.registry_table(spark)), present)


def row_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.indexed_corpora(spark, sf_dir).select(*PLACE, "idx", "n_rows")


def _slice(spark: SparkSession, sf_dir: str, bounds) -> DataFrame:
    docs = fx.documents(spark, sf_dir).where(F.col("split") == "train")
    return slice_rows(docs, ["split"], fx.DOC_KEY, fx.DOC_LEVELS, bounds).select("doc_id", "n_chars", "text")


def slice_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _slice(spark, sf_dir, lambda n: head_bounds(n, F.lit(0.1)))


def slice_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    start, end = parse_slice("0.1-0.2")
    return _slice(spark, sf_dir, lambda n: range_bounds(n, F.lit(start), F.lit(end)))


def slice_percent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _slice(spark, sf_dir, lambda n: percent_bounds(n, 10))


def multi_slice_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = run_plan(
        spark, {"documents": {"train_slice": [0.1, 0.2]}, "conversations": {"train_slice": 0.5}, "benchmark": {}}
    )
    return multi_slice(scan_corpora(spark, sf_dir), plan.drop("source_ord", "storage_key"), CORPUS_KEY, CORPUS_CELLS).select(*PLACE, "text")


def sample_per_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First three usable rows of each train split; blank rows do not count."""
    source = scan_corpora(spark, sf_dir).where(F.col("split") == "train")
    rows = source
    hole = (F.col("dataset") == "documents") & (F.col("key1") % 13 == 0)
    rows = rows.withColumn("text", F.when(hole, F.lit(" \t\n")).otherwise(F.col("text")))
    usable = txt.drop_blank(rows, "text")
    return first_rows(usable, "dataset", CORPUS_KEY, 3, source).select("dataset", "sample", "key1", "key2", "text")


def concat_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.concatenated(spark, sf_dir)


def shuffle_epoch(spark: SparkSession, sf_dir: str) -> DataFrame:
    shuffled = mixing.shuffle_epoch(fx.concatenated(spark, sf_dir), fx.SEED, fx.EPOCH)
    return shuffled.select("split", "dataset", "key1", "key2", "idx", "position")


def resume_epoch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of the epoch after a third of each split: the rows by their positions, in no need of the earlier ones."""
    indexed = fx.concatenated(spark, sf_dir)
    sizes = indexed.groupBy("split").agg(F.first("n_rows").alias("n_rows"))
    left = mixing.resume_epoch(sizes, fx.SEED, fx.EPOCH, int_div(F.col("n_rows"), 3))
    return left.join(indexed.drop("n_rows"), ["split", "idx"]).select("split", "position", "idx", "dataset", "key1", "key2")


def batch_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    batched = mixing.assign_batches(fx.concatenated(spark, sf_dir), BATCH_SIZE)
    return batched.select("split", "idx", "dataset", "key1", "key2", "batch_id", "batch_pos")


def rank_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    slots = mixing.rank_plan(fx.concatenated(spark, sf_dir), fx.WORLD, BATCH_SIZE, fx.ACCUMULATE)
    return slots.select("split", "slot", "idx", "rank", "micro_batch", "opt_step")


QUERIES = {
    "latest_by_key": latest_by_key,
    "scan_split": scan_split,
    "split_assign": split_assign,
    "split_counts": split_counts,
    "stage_totals": stage_totals,
    "stage_select": stage_select,
    "scan_glob": scan_glob,
    "cache_counts": cache_counts,
    "text_resolve": text_resolve,
    "text_coalesce": text_coalesce,
    "text_normalise": text_normalise,
    "nonblank": nonblank,
    "manifest_classify": manifest_classify,
    "catalog_search": catalog_search,
    "catalog_configs": catalog_configs,
    "size_estimate": size_estimate,
    "size_total": size_total,
    "unregistered_sources": unregistered_sources,
    "missing_splits": missing_splits,
    "row_index": row_index,
    "slice_head": slice_head,
    "slice_range": slice_range,
    "slice_percent": slice_percent,
    "multi_slice": multi_slice_query,
    "sample_per_dataset": sample_per_dataset,
    "concat_sources": concat_sources,
    "shuffle_epoch": shuffle_epoch,
    "resume_epoch": resume_epoch,
    "batch_assign": batch_assign,
    "rank_plan": rank_plan,
}
