"""File manifests and the dataset catalogue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.sizes import human_size


def classify_scan(result: Column) -> Column:
    """Unscanned or ok files are safe, infected ones are not, the rest needs a look."""
    return (
        F.when(result.isNull() | (result == "ok"), "safe").when(result == "infected", "unsafe").otherwise("unexpected")
    )


def size_estimates(files: DataFrame, repo: str = "repo", size: str = "size") -> DataFrame:
    """Bytes per repository; missing sizes are skipped and a zero total is unknown."""
    total = F.nullif(F.sum(size), F.lit(0).cast("bigint"))
    sizes = files.groupBy(repo).agg(F.count(F.lit(1)).alias("n_files"), total.alias("total_bytes"))
    return sizes.withColumn("readable", human_size(F.col("total_bytes")))


def size_total(estimates: DataFrame) -> DataFrame:
    totals = estimates.agg(
        F.count(F.lit(1)).alias("n_repos"),
        F.coalesce(F.sum("total_bytes"), F.lit(0).cast("bigint")).alias("total_bytes"),
        F.count_if(F.col("total_bytes").isNull()).alias("n_unknown"),
    )
    return totals.withColumn("readable", human_size(F.col("total_bytes")))


def search(catalog: DataFrame, keyword: str, limit: int = 20) -> DataFrame:
    """Ids containing the keyword, the first `limit` in name order."""
    hits = catalog.where(F.lower("id").contains(keyword.lower())).select("id").distinct()
    return hits.orderBy("id").limit(limit)


def configs(catalog: DataFrame) -> DataFrame:
    return catalog.select("source", "config").distinct()
