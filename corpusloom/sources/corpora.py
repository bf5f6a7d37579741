"""Text sources: specifications, scans, splits, stages."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.text import normalise, resolve_text_column
from corpusloom.schemas import SPLITS


@dataclass(frozen=True)
class Corpus:
    """One registered text source.

    `key` orders its rows (one or two integer columns); rows carry no index of
    their own, so every ordered operation goes through it.
    """

    name: str
    table: str
    key: tuple[str, ...]
    text_column: str = "text"
    config: str | None = None
    splits: tuple[str, ...] = SPLITS


# The registered corpora, in concatenation order.
CORPORA = (
    Corpus("documents", "documents", ("doc_id",)),
    Corpus("conversations", "conversations", ("conv_id", "turn")),
    Corpus("benchmark", "benchmark", ("item_id",)),
    Corpus("pages", "pages", ("page_id",)),
)

# What each stage reads.
STAGE_SPLITS = {"fit": ("train", "validation"), "test": ("test",), None: SPLITS}

CORPUS_KEY = ("key1", "key2")
CORPUS_CELLS = (("cell00",), ("cell0",), ("cell1", "cell2"))


# Declared schemas, so that opening a table starts no inference job.
TABLE_SCHEMAS = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
    "benchmark": "item_id bigint, text string",
    "pages": "page_id bigint, url string, html string",
    "labels": "doc_id bigint, quality int, toxic int",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
}


def read_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.schema(TABLE_SCHEMAS[table]).parquet(f"{sf_dir}/{table}.parquet")


def split_of(key: Column) -> Column:
    """Deterministic split from the lead key: one tenth each held out."""
    rest = F.pmod(key.cast("bigint"), F.lit(10))
    return F.when(rest == 0, "validation").when(rest == 1, "test").otherwise("train")


def with_split(df: DataFrame, key: str) -> DataFrame:
    return df.withColumn("split", split_of(F.col(key)))


def scan_split(df: DataFrame, key: str, split: str) -> DataFrame:
    """One base split; the condition reaches the Parquet scan as a row filter."""
    return with_split(df, key).where(F.col("split") == split)


def split_names(corpus: Corpus, train_slice: tuple[float, float] | None = None) -> dict[str, tuple[float, float] | None]:
    """Split -> slice to apply; only `train` is ever sliced."""
    return {s: train_slice if s == "train" else None for s in corpus.splits}


def _branch(spark: SparkSession, sf_dir: str, corpus: Corpus, order: int) -> DataFrame:
    df = read_table(spark, sf_dir, corpus.table)
    text = resolve_text_column(df, corpus.text_column)
    key1 = F.col(corpus.key[0]).cast("bigint")
    two = len(corpus.key) == 2
    key2 = F.col(corpus.key[1]).cast("bigint") if two else F.lit(0).cast("bigint")
    none = F.lit(0).cast("bigint")
    return df.select(
        F.lit(corpus.name).alias("dataset"),
        F.lit(order).alias("source_ord"),
        split_of(key1).alias("split"),
        key1.alias("key1"),
        key2.alias("key2"),
        # cells of the sort key, as operators.ordering.integer_levels cuts them
        F.shiftright(key1, 40).alias("cell00"),
        F.shiftright(key1, 20).alias("cell0"),
        (key1 if two else none).alias("cell1"),
        (F.shiftright(key2, 20) if two else none).alias("cell2"),
        normalise(F.col(text)).alias("text"),
    )


def scan_corpora(spark: SparkSession, sf_dir: str, corpora: Sequence[Corpus] = CORPORA) -> DataFrame:
    """All corpora as one table; unused columns and filtered branches are pruned."""
    return concat_frames(spark, [_branch(spark, sf_dir, c, i) for i, c in enumerate(corpora)])


EMPTY_CORPUS = T.StructType(
    [
        T.StructField("dataset", T.StringType()),
        T.StructField("source_ord", T.IntegerType()),
        T.StructField("split", T.StringType()),
        T.StructField("key1", T.LongType()),
        T.StructField("key2", T.LongType()),
        *[T.StructField(c, T.LongType()) for level in CORPUS_CELLS for c in level],
        T.StructField("text", T.StringType()),
    ]
)


def concat_frames(spark: SparkSession, frames: Iterable[DataFrame], empty: T.StructType = EMPTY_CORPUS) -> DataFrame:
    """Concatenate sources by column name without deduplication."""
    frames = list(frames)
    if not frames:
        return spark.createDataFrame([], empty)
    return reduce(DataFrame.unionByName, frames)


def select_stage(df: DataFrame, stage: str | None) -> DataFrame:
    """Rows of the splits a stage needs; prunes partitions on a split-partitioned store."""
    if stage not in STAGE_SPLITS:
        raise ValueError(f"unknown stage {stage!r}; expected one of {list(STAGE_SPLITS)}")
    return df.where(F.col("split").isin(*STAGE_SPLITS[stage]))


def split_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("dataset", "split").agg(F.count(F.lit(1)).alias("n_rows"))


def stage_totals(df: DataFrame) -> DataFrame:
    """Sources and examples per split, from the per-source counts."""
    return split_counts(df).groupBy("split").agg(
        F.count("dataset").alias("n_sources"), F.sum("n_rows").alias("n_rows")
    )
