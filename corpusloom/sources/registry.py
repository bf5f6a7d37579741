"""Registrations, and checks of data against the plan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.session import scratch_path
from corpusloom.sources.corpora import CORPORA, Corpus

REGISTRY_DDL = "name string, source string, config string, splits array<string>, text_column string"


def registry_table(spark: SparkSession, corpora: Sequence[Corpus] = CORPORA) -> DataFrame:
    """The registry as a table: one row per configured source."""
    rows = [(c.name, c.table, c.config, list(c.splits), c.text_column) for c in corpora]
    return spark.createDataFrame(rows, REGISTRY_DDL)


def latest_by_key(df: DataFrame, key: Sequence[str], ordinal: str) -> DataFrame:
    """Last registration per key, and how many earlier ones it replaced.

    `max_by` combines before the shuffle, so a hot key costs one row per task.
    """
    values = [c for c in df.columns if c not in key]
    return (
        df.groupBy(*key)
        .agg(
            F.max_by(F.struct(*values), F.col(ordinal)).alias("_last"),
            (F.count(F.lit(1)) - 1).alias("n_overwritten"),
        )
        .select(*key, "_last.*", "n_overwritten")
    )


def unregistered(df: DataFrame, column: str, registered: DataFrame, strict: bool = False) -> DataFrame:
    """Row counts of sources missing from `registered` (a config-sized table).

    Rows are counted first, so the anti join sees one row per source.  `strict`
    writes all of them to a table and raises with their number and its path.
    """
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n_rows"))
    missing = counts.join(registered.select(column), column, "left_anti")
    if strict:
        path = scratch_path(df.sparkSession, "unregistered")
        missing.write.parquet(path)
        missing = df.sparkSession.read.schema(missing.schema).parquet(path)
        n = missing.count()
        if n:
            raise KeyError(f"{n} unregistered sources, listed in {path}")
    return missing


def planned_splits(registry: DataFrame) -> DataFrame:
    return registry.select(F.col("name").alias("dataset"), F.explode("splits").alias("split"))


def missing_splits(planned: DataFrame, present: DataFrame, strict: bool = False) -> DataFrame:
    """All planned splits that do not exist, gathered per dataset before failing."""
    found = present.select("dataset", "split").distinct()
    missing = (
        planned.join(found, ["dataset", "split"], "left_anti")
        .groupBy("dataset")
        .agg(
            F.count(F.lit(1)).alias("n_missing"),
            F.array_join(F.sort_array(F.collect_set("split")), ",").alias("missing"),
        )
    )
    if strict:
        failures = missing.orderBy("dataset").collect()
        if failures:
            raise RuntimeError("missing splits: " + "; ".join(f"{r.dataset}: {r.missing}" for r in failures))
    return missing
