"""Sharding by a hierarchical weighted hash tree (regions, racks, shards).

A row descends from the root: at each level every child of the chosen node
draws `-ln(u) / weight` from a hash of the row's key and the child's name, and
the smallest draw wins.  A child wins with probability weight / sum of weights.
A draw depends on nothing but key, child and weight, so when a weight grows,
rows leave other subtrees only for the one that grew; nothing moves between
subtrees whose weights stay.  One more shard opens a region of its own, hence
it takes rows only into itself.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import blank
from corpusloom.session import materialize

Rack = tuple[float, ...]            # weights of its shards
CELLS = 4096                        # numbering cells of a shard


@dataclass(frozen=True)
class HashTree:
    """Regions of racks of shard weights; shards are numbered from left to right."""

    regions: tuple[tuple[Rack, ...], ...]

    @property
    def n_shards(self) -> int:
        return sum(len(rack) for region in self.regions for rack in region)

    def grown(self, weight: float = 1.0) -> HashTree:
        """The tree with one more shard, alone in a region of its own."""
        return replace(self, regions=(*self.regions, ((weight,),)))


def even_tree(n_regions: int = 3, n_racks: int = 2, n_shards: int = 4) -> HashTree:
    return HashTree(tuple(tuple((1.0,) * n_shards for _ in range(n_racks)) for _ in range(n_regions)))


def _draw(key: Column, name: str, weight: float) -> Column:
    """Exponential draw of rate `weight`; 53 bits of the hash make a number strictly inside (0, 1)."""
    bits = F.shiftrightunsigned(F.xxhash64(F.concat(key, F.lit(f"/{name}"))), 11)
    return -F.log((bits.cast("double") + 0.5) / F.lit(float(1 << 53))) / F.lit(float(weight))


def _winner(key: Column, children: list[tuple[str, float]]) -> Column:
    """Position of the child with the smallest draw."""
    if len(children) == 1:
        return F.lit(0)
    draws = [F.struct(_draw(key, name, w).alias("d"), F.lit(i).alias("i")) for i, (name, w) in enumerate(children) if w > 0]
    return F.array_min(F.array(*draws)).getField("i")


def _choose(at: Column, options: list[Column]) -> Column:
    chosen = options[-1]
    for i in reversed(range(len(options) - 1)):
        chosen = F.when(at == i, options[i]).otherwise(chosen)
    return chosen


def with_shard(df: DataFrame, key: Column, tree: HashTree, out: str = "shard") -> DataFrame:
    """Add the shard of each row, and the region and rack it went through (`{out}_path`).  `key` is a string."""
    path, leaf = f"{out}_path", f"_{out}_leaf"
    region_w = [sum(map(sum, region)) for region in tree.regions]
    region = _winner(key, [(f"r{i}", w) for i, w in enumerate(region_w)])
    racks = [_winner(key, [(f"r{i}k{j}", sum(rack)) for j, rack in enumerate(region)]) for i, region in enumerate(tree.regions)]
    first, leaves = 0, []
    for i, racks_of in enumerate(tree.regions):
        inner = []
        for j, rack in enumerate(racks_of):
            inner.append(_winner(key, [(f"r{i}k{j}s{s}", w) for s, w in enumerate(rack)]) + F.lit(first))
            first += len(rack)
        leaves.append(_choose(F.col(path)["rack"], inner))
    return (
        df.withColumn(path, F.struct(region.alias("region")))
        .withColumn(path, F.struct(F.col(path)["region"].alias("region"), _choose(F.col(path)["region"], racks).alias("rack")))
        .withColumn(leaf, _choose(F.col(path)["region"], leaves).cast("int"))
        .withColumnRenamed(leaf, out)
    )


def numbered_in_shard(placed: DataFrame, shard: str = "shard", out: str = "slot") -> DataFrame:
    """Add a gapless number from 0 inside each shard.

    A shard grows with the data, so no window runs over one: rows fall into
    `CELLS` hash cells per shard, cells are counted, the small count table gets
    running totals, and each cell is numbered on its own.  The cell hashes a row
    id, so rows that repeat a key spread too.
    """
    marked = placed.withColumn("_row", F.monotonically_increasing_id())
    stored = materialize(marked.withColumn("_cell", F.pmod(F.xxhash64("_row"), F.lit(CELLS)).cast("int")), "shard-rows")
    counts = stored.groupBy(shard, "_cell").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(shard).orderBy("_cell").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    starts = counts.select(shard, "_cell", (before - F.col("_n")).alias("_start"))
    inside = F.row_number().over(Window.partitionBy(shard, "_cell").orderBy("_row")) - 1
    return (
        stored.withColumn("_at", inside)
        .join(starts, [shard, "_cell"])
        .withColumn(out, F.col("_start") + F.col("_at"))
        .drop("_row", "_cell", "_start", "_at")
    )


def shard_documents(docs: DataFrame, tree: HashTree, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard, region, rack) for every row of `docs`.

    `size` is the UTF-8 length plus 8; null text has length 0 and the checksum of
    the empty string.  The key is the id alone: rows that repeat an id meet in one
    shard, a null id counts as the empty key.  `grown_shard` is the shard under the
    tree with one more shard.  An empty table gives no rows; other columns of
    `docs` are not used.
    """
    raw = blank(text).cast("binary")
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        (F.octet_length(raw) + F.lit(8)).cast("bigint").alias("size"),
        F.crc32(raw).alias("text_crc32"),
    )
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    both = with_shard(with_shard(rows, key, tree), key, tree.grown(), "grown_shard")
    return numbered_in_shard(both).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        F.col("slot").cast("bigint").alias("slot"),
        "grown_shard",
        F.col("shard_path.region").alias("region"),
        F.col("shard_path.rack").alias("rack"),
    )
