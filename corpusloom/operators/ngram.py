"""Bigram language model: fit, held-out loss, next-token choice.

A pair of tokens is one LONG, (prev << 32) | next, as soon as it is made: the vocabulary's head, of bounded
size, is broadcast and names both sides of nearly every pair in the task that read it, so what is counted
and shuffled is LONGs.  Only pairs with a token outside of the head keep that token's text, once per
task, until the rest of the vocabulary names it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.exact import exact_parts, exact_sum, sum_of_parts
from corpusloom.functions.tokens import next_token_pairs, word_tokens
from corpusloom.operators.lookup import keyed_lookup, most_frequent
from corpusloom.operators.ordering import ordered_index
from corpusloom.operators.vocab import HEAD_ROWS, cutter, head_and_tail
from corpusloom.schemas import EOS_ID, FIRST_WORD_ID, UNK_ID
from corpusloom.session import materialize

EOS_TOKEN = ""          # no word is empty, so this cannot clash with a token
LOSS_HEAD_ROWS = 1 << 20        # pairs whose losses are broadcast, 16 bytes each
PART_TOKENS = 1 << 22       # tokens whose pairs a task counts at a time, one text at least
CLASS_CELL_BITS = 14    # next ids of one cell where pairs of a count are ordered


def pair_tokens(docs: DataFrame, key: Sequence[str] = (), text: str = "text") -> DataFrame:
    """(key, prev_token, next_token) for every neighbouring pair, end mark included."""
    ids = F.concat(word_tokens(F.col(text)), F.array(F.lit(EOS_TOKEN)))
    return docs.select(*key, ids.alias("_ids")).select(
        *key, F.inline(next_token_pairs(F.col("_ids"))).alias("prev_token", "next_token")
    )


def pair_of(prev: Column, following: Column) -> Column:
    return F.shiftleft(prev.cast("bigint"), 32).bitwiseOR(following.cast("bigint"))


def prev_of(pair: Column) -> Column:
    return F.shiftright(pair, 32).cast("int")


def next_of(pair: Column) -> Column:
    return pair.bitwiseAND((1 << 32) - 1).cast("int")


def _coded(docs: DataFrame, head: DataFrame, key: Sequence[str], text: str) -> DataFrame:
    """(key, pair, prev_open, next_open) per pair: a token outside of the head leaves 0 in the pair and its text beside it."""
    rows = pair_tokens(docs, key, text)
    ids, open_ = {}, {}
    for side in ("prev", "next"):
        token = f"{side}_token"
        names = head.select(F.col("token").alias(token), F.col("id").alias(f"_{side}"))
        rows = rows.join(F.broadcast(names), token, "left")
        ids[side] = F.coalesce(f"_{side}", F.when(F.col(token) == EOS_TOKEN, EOS_ID), F.lit(0))
        open_[side] = F.when(F.col(f"_{side}").isNull() & (F.col(token) != EOS_TOKEN), F.col(token))
    return rows.select(*key, pair_of(ids["prev"], ids["next"]).alias("pair"), *[x.alias(f"{side}_open") for side, x in open_.items()])


def _named(counted: DataFrame, tail: DataFrame) -> DataFrame:
    """Rows with open tokens, coded through the rest of the vocabulary; what that does not know is unknown."""
    rows = counted
    for side, shift in (("prev", 32), ("next", 0)):
        names = tail.select(F.col("token").alias(f"{side}_open"), F.col("id").cast("bigint").alias("_id"))
        rows = rows.join(names, f"{side}_open", "left")
        rows = rows.withColumn("pair", F.col("pair").bitwiseOR(F.shiftleft(F.coalesce("_id", F.lit(UNK_ID).cast("bigint")), shift))).drop("_id")
    return rows.drop("prev_open", "next_open")


def _pair_counter(head: Broadcast) -> Callable:
    """Task function: the distinct pairs of a part of the texts, with their counts, in the form of `_coded`.

    Everything it needs is inside, so that workers need not import this module.
    """
    cut, eos = cutter(PART_TOKENS), EOS_ID

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        for batch in cut(batches, "_tokens"):
            lists = batch.column("_tokens")
            flat, known = lists.flatten(), head.value.column(0).combine_chunks()
            lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
            at = pc.fill_null(pc.index_in(flat, value_set=known.cast(flat.type)), -1).to_numpy()
            ends = np.unique(np.cumsum(lengths)[lengths > 0])
            ids = np.concatenate([head.value.column(1).to_numpy().astype(np.int64), [0]])[at]
            ids[ends - 1] = eos
            at = at.copy()
            at[ends - 1] = 0
            open_ = np.flatnonzero(at < 0)
            named = flat.take(pa.array(open_)).dictionary_encode()
            ids[open_] = -1 - named.indices.to_numpy().astype(np.int64)
            inside = np.ones(len(ids), bool)
            inside[ends - 1] = False            # the last token of a text has no next one
            first = np.flatnonzero(inside)
            pairs, n = np.unique((ids[first] << 32) | (ids[first + 1] & 0xFFFFFFFF), return_counts=True)
            prev, following = pairs >> 32, (pairs & 0xFFFFFFFF).astype(np.uint32).view(np.int32).astype(np.int64)
            opened = [named.dictionary.take(pa.array(-1 - x, mask=x >= 0)) for x in (prev, following)]
            coded = (np.maximum(prev, 0) << 32) | np.maximum(following, 0)
            yield pa.RecordBatch.from_arrays([pa.array(coded), *opened, pa.array(n.astype(np.int64))], ["pair", "prev_open", "next_open", "n"])

    return run


def pair_counts(docs: DataFrame, vocab: DataFrame, text: str = "text", max_rows: int = HEAD_ROWS) -> DataFrame:
    """(pair, n) over all documents; one pass over the texts, counts combined in parts of a task, then before the shuffle."""
    head, tail = head_and_tail(vocab, max_rows)
    held = docs.sparkSession.sparkContext.broadcast(head.select("token", "id").toArrow())
    tokens = docs.select(F.concat(word_tokens(F.col(text)), F.array(F.lit(EOS_TOKEN))).alias("_tokens"))
    parts = tokens.mapInArrow(_pair_counter(held), "pair bigint, prev_open string, next_open string, n bigint")
    counted = materialize(parts.groupBy("pair", "prev_open", "next_open").agg(F.sum("n").alias("n")), "coded-pairs")
    is_open = F.col("prev_open").isNotNull() | F.col("next_open").isNotNull()
    # a pair named by the tail holds an id the head does not have, so the two parts share no pair
    named = _named(counted.where(is_open), tail).groupBy("pair").agg(F.sum("n").alias("n"))
    return counted.where(~is_open).select("pair", "n").unionByName(named)


def bigram_counts(docs: DataFrame, vocab: DataFrame, text: str = "text", max_rows: int = HEAD_ROWS) -> DataFrame:
    """(prev, next, n) by token id."""
    pairs = pair_counts(docs, vocab, text, max_rows)
    return pairs.select(prev_of(F.col("pair")).alias("prev"), next_of(F.col("pair")).alias("next"), "n")


def context_totals(bigrams: DataFrame) -> DataFrame:
    """`context_n` per prev, a written table: grouped, not windowed, so frequent contexts combine before the shuffle."""
    return materialize(bigrams.groupBy("prev").agg(F.sum("n").alias("context_n")), "context-totals")


def by_context(rows: DataFrame, totals: DataFrame, max_rows: int = HEAD_ROWS) -> DataFrame:
    """Left join of `rows` to `totals`, one row per `prev`.

    Ids are frequency ranks, so the contexts of the first `max_rows` ids, the special ones among them, hold nearly all
    rows and every heavy key; their totals are broadcast.  The rest joins by shuffle.
    """
    often = F.col("prev") < FIRST_WORD_ID + max_rows
    near = rows.where(often).join(F.broadcast(totals.where(often)), ["prev"], "left")
    return near.unionByName(rows.where(~F.coalesce(often, F.lit(False))).join(totals.where(~often), ["prev"], "left"))


def with_context_totals(bigrams: DataFrame) -> DataFrame:
    return by_context(bigrams, context_totals(bigrams))


def smoothed(n: Column, context_n: Column, vocab_size: int | Column, k: float) -> Column:
    size = vocab_size if not isinstance(vocab_size, int) else F.lit(vocab_size)
    return (n + F.lit(k)) / (context_n + F.lit(k) * size)


def vocab_size(vocab: DataFrame) -> int:
    """Words plus the special ids."""
    return vocab.count() + FIRST_WORD_ID


def pair_types_scored(
    held_out: DataFrame, vocab: DataFrame, bigrams: DataFrame, size: int, k: float, text: str = "text", max_rows: int = HEAD_ROWS
) -> DataFrame:
    """(pair, n_pairs, loss): each distinct held-out pair, its count and -ln p(next | prev)."""
    types = pair_counts(held_out, vocab, text, max_rows).withColumnRenamed("n", "n_pairs")
    known = bigrams.select(pair_of(F.col("prev"), F.col("next")).alias("pair"), "n")
    found = types.join(known, "pair", "left").withColumn("prev", prev_of(F.col("pair")))
    # read twice below, for the frequent contexts and for the others
    scored = by_context(materialize(found, "held-out-pairs"), context_totals(bigrams))
    p = smoothed(F.coalesce("n", F.lit(0)), F.coalesce("context_n", F.lit(0)), size, k)
    return scored.select("pair", "n_pairs", (-F.log(p)).alias("loss"))


def overall_loss(scored: DataFrame) -> DataFrame:
    """Held-out loss and perplexity from the scored pair types."""
    loss = exact_sum(F.col("n_pairs") * F.col("loss")) / F.sum("n_pairs")
    return scored.agg(F.sum("n_pairs").alias("n_pairs"), loss.alias("loss"), F.exp(loss).alias("perplexity"))


def document_losses(
    held_out: DataFrame,
    key: Sequence[str],
    vocab: DataFrame,
    scored: DataFrame,
    text: str = "text",
    max_rows: int = HEAD_ROWS,
    max_losses: int = LOSS_HEAD_ROWS,
) -> DataFrame:
    """Held-out loss and perplexity per document; `scored` is a written table of `pair_types_scored`.

    Losses of the most frequent pairs are broadcast, so most of a document is summed where it is
    read and leaves one row; only its other pairs are shuffled, as LONGs.
    """
    key = list(key)
    head, tail = head_and_tail(vocab, max_rows)
    often = scored.where(most_frequent(scored, "n_pairs", max_losses))
    whole, fraction = exact_parts(F.col("loss"))        # once for a pair, not for each of its occurrences
    often = often.select(F.col("pair").alias("_closed"), whole.alias("_w"), fraction.alias("_f"))
    rows = _coded(held_out, head, key, text)
    closed = F.when(F.col("prev_open").isNull() & F.col("next_open").isNull(), F.col("pair"))
    rows = rows.withColumn("_closed", closed).join(F.broadcast(often), "_closed", "left")
    left = F.col("_w").isNull()
    place = [F.when(left, F.col(c)).alias(c) for c in ("pair", "prev_open", "next_open")]
    counted = rows.select(*key, *place, "_w", "_f").groupBy(*key, "pair", "prev_open", "next_open").agg(
        F.count(F.lit(1)).alias("n_pairs"), sum_of_parts(F.col("_w"), F.col("_f")).alias("lost")
    )
    counted = materialize(counted, "document-pairs")
    named = _named(counted.where("pair IS NOT NULL").drop("lost"), tail)
    priced = named.join(scored.select("pair", "loss"), "pair").select(*key, "n_pairs", (F.col("n_pairs") * F.col("loss")).alias("lost"))
    every = counted.where("pair IS NULL").select(*key, "n_pairs", "lost").unionByName(priced)
    loss = exact_sum(F.col("lost")) / F.sum("n_pairs")
    return every.groupBy(*key).agg(F.sum("n_pairs").alias("n_pairs"), loss.alias("loss"), F.exp(loss).alias("perplexity"))


def tempered(bigrams: DataFrame, temperature: float) -> DataFrame:
    """`p`: next-token probability per context, sharpened or flattened by temperature."""
    # the context total cancels out of p**(1/T) once renormalised, so counts do
    weighed = bigrams.withColumn("_w", F.pow(F.col("n").cast("double"), F.lit(1.0 / temperature)))
    totals = materialize(weighed.groupBy("prev").agg(F.sum("_w").alias("_all")), "context-weights")
    priced = by_context(weighed, totals)
    return priced.withColumn("p", F.col("_w") / F.col("_all")).drop("_w", "_all")


def top_k(distribution: DataFrame, k: int, weight: str = "n") -> DataFrame:
    """The k most probable next tokens per context.

    Ranked by count, which orders as the probability does and has exact ties.
    """
    order = Window.partitionBy("prev").orderBy(F.col(weight).desc(), F.col("next"))
    return distribution.withColumn("next_rank", F.row_number().over(order)).where(F.col("next_rank") <= k)


def top_p(bigrams: DataFrame, p: float) -> DataFrame:
    """Nucleus: next tokens kept while the probability before them is under `p`, most frequent first, then by id.

    The pairs of a context that share a count form a class.  A context has few of them (k different
    counts need k*k/2 occurrences), and their running totals say which can be in the nucleus.  Only the pairs of
    those are ordered, class by class, in cells of ids.  All totals are integers.
    """
    classes = materialize(bigrams.groupBy("prev", "n").agg(F.count(F.lit(1)).alias("k")), "count-classes")
    mass = (F.col("n") * F.col("k")).alias("_mass")
    falling = Window.partitionBy("prev").orderBy(F.col("n").desc())
    upto = F.sum("_mass").over(falling.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = classes.select("prev", "n", "k", mass).select(
        "prev", "n", "k", (upto - F.col("_mass")).alias("_before"), F.sum("_mass").over(Window.partitionBy("prev")).alias("_total")
    )
    placed = materialize(placed.where(F.col("_before") < F.lit(p) * F.col("_total")), "nucleus-classes")
    # a class of one cell's size is ordered as it is, where it meets its totals
    small, columns = F.col("k") <= (1 << CLASS_CELL_BITS), ["prev", "next", "n", "_before", "_total", "idx"]
    order = Window.partitionBy("prev", "n").orderBy("next")
    inside = bigrams.join(placed.where(small), ["prev", "n"]).withColumn("idx", F.row_number().over(order).cast("bigint") - 1).select(*columns)
    if not placed.where(~small).isEmpty():
        large = bigrams.join(placed.where(~small), ["prev", "n"])
        cells = ordered_index(large, ["prev", "n"], ["next"], [[f"shiftright(next, {CLASS_CELL_BITS})"]])
        inside = inside.unionByName(cells.select(*columns))
    before = F.col("_before") + F.col("n") * F.col("idx")
    kept = inside.select("prev", "next", "n", before.alias("_before"), "_total").where(F.col("_before") < F.lit(p) * F.col("_total"))
    return kept.select("prev", "next", "n", (F.col("_before") / F.col("_total")).alias("p_before"))


def greedy_table(bigrams: DataFrame) -> DataFrame:
    """Most frequent next token per context, ties to the smaller id."""
    best = F.max(F.struct(F.col("n"), (-F.col("next")).alias("_neg")))
    return bigrams.groupBy("prev").agg(best.alias("_b")).select("prev", (-F.col("_b._neg")).alias("next"))


def greedy_next(prompts: DataFrame, key: Sequence[str], vocab: DataFrame, bigrams: DataFrame, text: str = "text") -> DataFrame:
    """Greedy continuation of each prompt by one token, from its last word."""
    words = vocab.select("token", "id")
    table = greedy_table(bigrams)
    named = table.join(words.withColumnsRenamed({"id": "prev", "token": "prev_token"}), "prev")
    named = named.join(words.withColumnsRenamed({"id": "next", "token": "next_token"}), "next", "left")
    named = named.select("prev_token", "next", F.coalesce("next_token", F.lit("<eos>")).alias("next_token"))
    last = F.get(F.reverse(word_tokens(F.col(text))), F.lit(0))
    asked = prompts.select(*key, F.coalesce(last, F.lit(EOS_TOKEN)).alias("prev_token"))
    return keyed_lookup(asked, named, ["prev_token"])


def repetition_penalty(score: Column, seen: Column, penalty: float) -> Column:
    """Seen tokens lose score: negative scores are multiplied, others divided."""
    return F.when(seen & (score < 0), score * penalty).when(seen, score / penalty).otherwise(score)
