"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.session import materialize


def components(edges: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node each node of `edges` can reach.

    Alternates two steps that keep components as they are: every node hands its larger
    neighbours to its smallest one (large star), then its smaller neighbours (small
    star), until each node hangs on its component's smallest.  Each round is written to
    the shared folder, so no lineage grows and a lost executor costs one round at most.
    Loops and repeated edges do no harm; an empty table gives no rows.
    """
    big, small = F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    now = materialize(edges.where(F.col(a) != F.col(b)).select(big, small).distinct(), "edges")
    last = None
    for _ in range(most_rounds):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = materialize(joined.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        print_ = F.xxhash64("u", "v").cast("decimal(38,0)")
        state = tuple(now.agg(F.count(F.lit(1)), F.sum(print_)).first())
        if state == last:
            break
        last = state
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
