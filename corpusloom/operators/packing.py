"""Sequence packing: documents concatenated and cut into fixed-length blocks."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.arith import ceil_div, int_div
from corpusloom.operators.ordering import Levels, cell_offsets, ordered_index
from corpusloom.functions.tokens import raw_tokens
from corpusloom.schemas import BYTE_EOS, PACK_BATCH_ROWS
from corpusloom.session import materialize


def batch_group(idx: Column, n: Column, batch_rows: int, shards: int) -> Column:
    """Number of the map batch a row falls in.

    Rows are cut into `shards` contiguous shards (the first n % shards hold one
    row more), and each shard into batches of `batch_rows`.
    """
    if shards == 1:
        return int_div(idx, batch_rows)
    used = F.least(n, F.lit(shards).cast("bigint"))
    size, extra = int_div(n, used), n % used
    in_large = idx < extra * (size + 1)
    shard = F.when(in_large, int_div(idx, size + 1)).otherwise(
        extra + int_div(idx - extra * (size + 1), size)
    )
    first = shard * size + F.least(shard, extra)
    large_before, small_before = F.least(shard, extra), F.greatest(shard - extra, F.lit(0))
    batches_before = large_before * ceil_div(size + 1, batch_rows) + small_before * ceil_div(size, batch_rows)
    return (batches_before + int_div(idx - first, batch_rows)).cast("bigint")


def pack_plan(
    df: DataFrame,
    by: Sequence[str],
    key: Sequence[str],
    levels: Levels,
    n: Column,
    block_length: int,
    scope: str = "batch",
    batch_rows: int = PACK_BATCH_ROWS,
    shards: int = 1,
) -> DataFrame:
    """Where each document's tokens go, from token counts alone.

    Columns: by, key, n_tokens, pack_group, token_offset (inside the group),
    group_tokens, first_block (id of the group's first block).  Nothing wider
    than a key and a count is shuffled or kept.
    """
    if scope not in ("batch", "split"):
        raise ValueError(f"scope is 'batch' or 'split', got {scope!r}")
    by, key = list(by), list(key)
    counted = df.select(*by, *key, *_level_columns(df, by, key), n.cast("bigint").alias("n_tokens"))
    # counted is read several times below; written, the text is scanned for it once
    counted = materialize(counted, "token-counts")
    placed = ordered_index(counted, by, key, levels, weights=["n_tokens"])
    if scope == "split":
        return placed.select(
            *by,
            *key,
            "n_tokens",
            F.lit(0).cast("bigint").alias("pack_group"),
            F.col("n_tokens_before").alias("token_offset"),
            F.col("n_tokens_total").alias("group_tokens"),
            F.lit(0).cast("bigint").alias("first_block"),
        )
    placed = placed.withColumn("pack_group", batch_group(F.col("idx"), F.col("n_rows"), batch_rows, shards))
    # read by the groups and by the join to them
    placed = materialize(placed, "placed-rows")
    groups = placed.groupBy(*by, "pack_group").agg(
        F.min("n_tokens_before").alias("_start"), F.sum("n_tokens").alias("group_tokens")
    )
    groups = groups.withColumns(
        {"_blocks": int_div(F.col("group_tokens"), block_length), "_span": F.shiftright("pack_group", 20)}
    )
    before = cell_offsets(groups, by, [["_span"], ["pack_group"]], ["_blocks"])
    numbered = groups.join(
        before.select(*by, "pack_group", F.col("_blocks_before").alias("first_block")), [*by, "pack_group"]
    ).select(*by, "pack_group", "_start", "group_tokens", "first_block")
    return placed.join(numbered, [*by, "pack_group"]).select(
        *by,
        *key,
        "n_tokens",
        "pack_group",
        (F.col("n_tokens_before") - F.col("_start")).alias("token_offset"),
        "group_tokens",
        "first_block",
    )


def _level_columns(df: DataFrame, by: list[str], key: list[str]) -> list[str]:
    return [c for c in df.columns if c.startswith("cell") and c not in by and c not in key]


@dataclass(frozen=True)
class Content:
    """A document's tokens as bytes, `width` to a token, and the mark that ends it (None for none).

    Only bytes are cut and moved; `decode` makes ids of what a block gathered.
    """

    raw: Column
    eos: int | None = BYTE_EOS
    width: int = 1
    decode: Callable[[Column], Column] = raw_tokens

    def count(self) -> Column:
        return int_div(F.octet_length(self.raw), self.width) + int(self.eos is not None)


def text_bytes(text: str = "text", eos: int | None = BYTE_EOS) -> Content:
    """The UTF-8 bytes of a text as tokens."""
    return Content(F.coalesce(F.col(text), F.lit("")).cast("binary"), eos)


def pack_blocks(
    df: DataFrame,
    plan: DataFrame,
    by: Sequence[str],
    key: Sequence[str],
    ids: Column | Content,
    block_length: int,
    join: str = "shuffle_hash",
    in_ranges: bool = False,
) -> DataFrame:
    """Blocks of exactly `block_length` tokens; each group's tail is dropped.

    `ids` is a row's tokens and `plan` (from `pack_plan`) says where they
    go.  Every row is cut into the fragments that fall in each block, and a
    block gathers its fragments: at most `block_length` of them, however long
    or skewed the documents are.  Tokens given as `Content` travel as bytes; where
    `df` is a table of buckets by `by` and `key`, the texts meet the plan in place.
    `join` may say `broadcast` for a plan of proven size.  `in_ranges` gathers blocks in ranges of `by` and `block_id`,
    so a store need not move them again.
    """
    by, key = list(by), list(key)
    size = F.lit(block_length).cast("bigint")
    used = plan.where(
        (F.col("n_tokens") > 0) & (F.col("token_offset") < int_div(F.col("group_tokens"), block_length) * size)
    )
    start, end = F.col("token_offset"), F.col("token_offset") + F.col("n_tokens")
    last = F.least(int_div(end - 1, block_length), int_div(F.col("group_tokens"), block_length) - 1)
    content = ids if isinstance(ids, Content) else None
    # Hashing the narrow plan leaves the wide text rows unsorted, and never
    # broadcasts the text however small a run is.
    rows = df.join(used.hint(join), [*by, *key]).select(
        *by, "pack_group", "first_block", "token_offset", "n_tokens",
        int_div(start, block_length).alias("_from"), last.alias("_to"), (content.raw if content else ids).alias("_tokens"),
    )

    # The slice stays outside higher-order functions: there it would unpack the
    # whole document once per fragment.
    spans = rows.select("*", F.explode(F.sequence("_from", "_to")).alias("block"))
    at = F.greatest(start, F.col("block") * size)
    stop = F.least(end, (F.col("block") + 1) * size)
    part = _slice(content, at - start, stop - start, F.col("n_tokens"))
    block_id = (F.col("first_block") + F.col("block")).alias("block_id")
    pieces = spans.select(*by, "pack_group", block_id, at.alias("at"), part.alias("part"))
    if in_ranges:
        pieces = pieces.repartitionByRange(*by, "block_id")
    blocks = pieces.groupBy(*by, "pack_group", "block_id").agg(
        F.sort_array(F.collect_list(F.struct("at", "part"))).alias("_parts")
    )
    tokens = F.flatten(F.transform("_parts", lambda p: _ids(content, p["part"])))
    return blocks.select(*by, "block_id", "pack_group", tokens.alias("input_ids")).select(
        *by,
        "block_id",
        "pack_group",
        "input_ids",
        F.col("input_ids").alias("labels"),
        F.array_repeat(F.lit(1), block_length).alias("attention_mask"),
    )


def _slice(content: Content | None, first: Column, stop: Column, n_tokens: Column) -> Column:
    """Tokens `first` to `stop` of a document: an array, or bytes and whether its end mark follows."""
    if content is None:
        return F.slice("_tokens", (first + 1).cast("int"), (stop - first).cast("int"))
    ends = (stop == n_tokens) if content.eos is not None else F.lit(False)
    length = (stop - first - ends.cast("int")) * content.width
    raw = F.substring("_tokens", (first * content.width + 1).cast("int"), length.cast("int"))
    return F.struct(raw.alias("raw"), ends.alias("ends"))


def _ids(content: Content | None, part: Column) -> Column:
    if content is None:
        return part
    ids = content.decode(part["raw"])
    return ids if content.eos is None else F.when(part["ends"], F.concat(ids, F.array(F.lit(content.eos)))).otherwise(ids)


def pack_stats(plan: DataFrame, by: Sequence[str], block_length: int) -> DataFrame:
    """Tokens, whole blocks and dropped tail tokens of each pack group."""
    return plan.groupBy(*by, "pack_group").agg(F.sum("n_tokens").alias("n_tokens")).select(
        *by,
        "pack_group",
        "n_tokens",
        int_div(F.col("n_tokens"), block_length).alias("n_blocks"),
        (F.col("n_tokens") % block_length).alias("n_dropped"),
    )


def token_counts(df: DataFrame, by: Sequence[str], mask: Column) -> DataFrame:
    """Real and padded positions, from the attention masks."""
    real = F.aggregate(mask, F.lit(0), lambda a, x: a + x)
    return df.select(*by, real.alias("_real"), F.size(mask).alias("_all")).groupBy(*by).agg(
        F.sum("_real").alias("real_tokens"), F.sum(F.col("_all") - F.col("_real")).alias("padded_tokens")
    )
