"""The inputs of the registered queries, derived from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators.mixing import concat_index
from corpusloom.operators.ordering import integer_levels, ordered_index
from corpusloom.operators.runs import number_steps, with_epochs
from corpusloom.sources.corpora import CORPUS_CELLS, CORPUS_KEY, read_table, scan_corpora, with_split

# Parameters of the registered queries.
PACK_ROWS = 100
SEED, EPOCH = 42, 1
WORLD, ACCUMULATE = 2, 2
STEPS_PER_EPOCH = 20
LOGIT_IGNORE = 9

DOC_KEY = ["doc_id"]
DOC_LEVELS = integer_levels("doc_id")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_split(read_table(spark, sf_dir, "documents"), "doc_id")


def indexed_corpora(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row index of every corpus inside its (dataset, split); keys only."""
    keys = scan_corpora(spark, sf_dir).drop("text")
    return ordered_index(keys, ["dataset", "split"], CORPUS_KEY, CORPUS_CELLS)


def concatenated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row index over the concatenation of all corpora per split; keys only."""
    keys = scan_corpora(spark, sf_dir).drop("text")
    indexed = concat_index(keys, CORPUS_KEY, CORPUS_CELLS)
    return indexed.select("split", "dataset", "key1", "key2", "idx", "n_rows")


def gappy_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with missing text on every 17th id."""
    docs = read_table(spark, sf_dir, "documents")
    return docs.withColumn("text", F.when(F.col("doc_id") % 17 != 0, F.col("text")))


def blanked_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with blank text on every 13th id."""
    docs = read_table(spark, sf_dir, "documents")
    return docs.withColumn("text", F.when(F.col("doc_id") % 13 == 0, F.lit(" \t\n")).otherwise(F.col("text")))


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a metric log: one run per user, steps in time order."""
    events = read_table(spark, sf_dir, "events").select(
        F.col("user_id").alias("run"),
        F.col("event_type").alias("name"),
        "ts",
        "event_id",
        "value",
        (F.lit(1) + F.col("event_id") % 4).alias("batch_rows"),
    )
    return with_epochs(number_steps(events, ["run"], "ts", "event_id"), STEPS_PER_EPOCH)


def checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as validation checks: one series per user and event type; some are missing or no number."""
    number = F.when(F.col("event_id") % 97 == 0, F.lit(float("nan"))).when(F.col("event_id") % 89 == 0, F.lit(float("-inf")))
    value = F.when(F.col("event_id") % 83 != 0, F.coalesce(number, F.col("value")))
    events = read_table(spark, sf_dir, "events").select(
        F.col("user_id").alias("run"), F.col("event_type").alias("name"), "ts", "event_id", value.alias("value")
    )
    return number_steps(events, ["run", "name"], "ts", "event_id").select("run", "name", "step", "value")


def logits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as logits; every 101st target is outside them, every 103rd unknown."""
    target = F.when(F.col("vec_id") % 101 == 0, F.lit(1_000_000)).when(F.col("vec_id") % 103 != 0, F.col("label"))
    return read_table(spark, sf_dir, "embeddings").withColumn("label", target)


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as repository files; every 11th size is unknown."""
    docs = read_table(spark, sf_dir, "documents")
    return docs.select(
        F.col("source").alias("repo"),
        F.col("doc_id").alias("path"),
        F.when(F.col("doc_id") % 11 != 0, F.col("n_chars")).alias("size"),
    )


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "part").select(
        F.col("p_name").alias("id"), F.col("p_brand").alias("source"), F.col("p_type").alias("config")
    )
