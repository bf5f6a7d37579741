"""Vocabulary tables, and arrays mapped through them."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.tokens import word_tokens
from corpusloom.operators.ordering import ranked_table
from corpusloom.schemas import EOS_ID, FIRST_WORD_ID, MASK_ID, UNK_ID
from corpusloom.session import materialize

HEAD_ROWS = 500_000         # with HEAD_TOKEN_BYTES, at most 48 MB are broadcast
HEAD_TOKEN_BYTES = 64
PART_TOKENS = 1 << 20       # elements that a task codes at a time, one row at least

# Names of the special ids.
SPECIAL_TOKENS = {UNK_ID: "<unk>", EOS_ID: "<eos>", MASK_ID: "<mask>"}


def build_vocab(docs: DataFrame, text: str = "text") -> DataFrame:
    """(token, n, id): ids rank tokens by falling count, ties by token.

    Counting combines before the shuffle, so frequent tokens cost one row per
    task.  The result is a written table.
    """
    tokens = docs.select(F.explode(word_tokens(F.col(text))).alias("token"))
    counts = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    ranked = ranked_table(counts, [F.col("n").desc(), F.col("token")], "id", FIRST_WORD_ID, "vocab-order")
    return materialize(ranked, "vocab")


def head_and_tail(vocab: DataFrame, max_rows: int = HEAD_ROWS) -> tuple[DataFrame, DataFrame]:
    """The most frequent tokens, of a size that may be broadcast, and all others."""
    in_head = (F.col("id") < FIRST_WORD_ID + max_rows) & (F.octet_length("token") <= HEAD_TOKEN_BYTES)
    return vocab.where(in_head), vocab.where(~in_head)


def cutter(tokens: int) -> Callable:
    """Cuts batches into parts of about `tokens` elements of an array, one row at least, so a task's memory is bounded."""

    def cut(batches: Iterator[pa.RecordBatch], array: str) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = max(1, len(batch) * tokens // max(1, len(batch.column(array).flatten())))
            yield from (batch.slice(at, step) for at in range(0, len(batch), step))

    return cut


def _coder(key: list[str], head: Broadcast) -> Callable:
    """Task function: rows as codes.  Code i is row i of the head, code -1 - j the row's j-th distinct element outside of it.

    Everything it needs is inside, so that workers need not import this module.
    """
    cut = cutter(PART_TOKENS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        for batch in cut(batches, "_array"):
            lists = batch.column("_array")
            flat, known = lists.flatten(), head.value.column(0).combine_chunks()
            lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy().astype(np.int64)
            codes = pc.fill_null(pc.index_in(flat, value_set=known.cast(flat.type)), -1).to_numpy().astype(np.int32)
            ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
            open_ = np.flatnonzero(codes < 0)
            row = np.searchsorted(ends, open_, side="right") - 1
            named = flat.take(pa.array(open_)).dictionary_encode(null_encoding="encode")
            width = max(len(named.dictionary), 1)
            pairs, at = np.unique(row * width + named.indices.to_numpy().astype(np.int64), return_inverse=True)
            first = np.searchsorted(pairs // width, np.arange(len(lengths) + 1)).astype(np.int32)
            codes[open_] = first[row] - at - 1
            parts = [pa.ListArray.from_arrays(ends, codes), pa.ListArray.from_arrays(first, named.dictionary.take(pa.array(pairs % width)))]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in key), *parts], [*key, "_codes", "_open"])

    return run


def _filler(key: list[str], head: Broadcast) -> Callable:
    """Task function: codes as values, of the head or of the row's `_names`."""
    cut = cutter(PART_TOKENS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        import pyarrow as pa

        for batch in cut(batches, "_codes"):
            lists, names = batch.column("_codes"), batch.column("_names")
            codes, ends = lists.flatten().to_numpy().astype(np.int64), lists.offsets.to_numpy()
            known, named = head.value.column(1).combine_chunks(), names.flatten()
            first = len(known) + names.offsets.to_numpy()[:-1] - names.offsets[0].as_py()
            at = np.where(codes < 0, np.repeat(first, np.diff(ends)) - 1 - codes, codes)
            values = pa.concat_arrays([known.cast(named.type), named]).take(pa.array(at))
            mapped = pa.ListArray.from_arrays((ends - ends[0]).astype(np.int32), values)
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in key), mapped], [*key, "mapped"])

    return run


def map_arrays(
    df: DataFrame,
    key: Sequence[str],
    array: Column,
    vocab: DataFrame,
    on: str,
    value: str,
    missing: Callable[[Column], Column],
    max_rows: int = HEAD_ROWS,
) -> DataFrame:
    """Replace every array element by its `value` in the vocabulary; (key, mapped).

    Ids are frequency ranks, so the vocabulary's head, at most `max_rows` tokens of at
    most HEAD_TOKEN_BYTES bytes, resolves nearly every element by broadcast, in the task that reads
    the row: arrays are never exploded.  They are written once, as codes.  What the head does not know
    goes through a shuffle once per row and token, frequent tokens never; only rows with such a token are
    shuffled, as codes.  Rows that share a key are merged position by position; only a table that has such rows
    is gathered by key.
    """
    key, spark = list(key), df.sparkSession
    head, tail = (part.select(on, value) for part in head_and_tail(vocab, max_rows))
    rows = df.select(*key, array.alias("_array"))
    keys = [rows.schema[k] for k in key]
    kinds = {f.name: f.dataType for f in vocab.schema}
    held = spark.sparkContext.broadcast(head.toArrow())
    codes = [T.StructField("_codes", T.ArrayType(T.IntegerType())), T.StructField("_open", T.ArrayType(rows.schema["_array"].dataType.elementType))]
    coded = materialize(rows.mapInArrow(_coder(key, held), T.StructType([*keys, *codes])), "coded")
    if tail.isEmpty():
        named = coded.withColumn("_names", F.transform("_open", missing))
    else:
        closed = coded.where(F.size("_open") == 0).withColumn("_names", F.array().cast(T.ArrayType(kinds[value])))
        listed = coded.select(*key, F.explode("_open").alias(on)).join(tail, on)
        maps = listed.groupBy(*key).agg(F.map_from_entries(F.collect_set(F.struct(on, value))).alias("_m"))
        found = F.transform("_open", lambda x: F.coalesce(F.try_element_at("_m", x), missing(x)))
        rest = coded.where(F.size("_open") > 0).join(maps, key, "left").withColumn("_names", found)
        named = closed.select(*key, "_codes", "_names").unionByName(rest.select(*key, "_codes", "_names"))
    mapped = T.StructField("mapped", T.ArrayType(kinds[value]))
    filled = named.select(*key, "_codes", "_names").mapInArrow(_filler(key, held), T.StructType([*keys, mapped]))
    if coded.groupBy(*key).count().where("count > 1").isEmpty():
        return filled
    placed = F.flatten(F.transform(F.collect_list("mapped"), lambda row: F.transform(row, lambda x, at: F.struct(at.alias("at"), x.alias("x")))))
    return filled.groupBy(*key).agg(F.transform(F.sort_array(placed), lambda p: p["x"]).alias("mapped"))


def encode_words(
    docs: DataFrame, key: Sequence[str], vocab: DataFrame, text: str = "text", max_rows: int = HEAD_ROWS
) -> DataFrame:
    """Word ids per document; words outside the vocabulary become the unknown id."""
    out = map_arrays(
        docs.select(*key, text), key, word_tokens(F.col(text)), vocab, "token", "id", lambda _: F.lit(UNK_ID), max_rows
    )
    return out.withColumnRenamed("mapped", "input_ids")


def decode_words(
    encoded: DataFrame,
    key: Sequence[str],
    vocab: DataFrame,
    ids: str = "input_ids",
    skip_special: bool = True,
    max_rows: int = HEAD_ROWS,
) -> DataFrame:
    """Tokens per document as one string, optionally without the special ids."""
    array = F.col(ids)
    if skip_special:
        array = F.filter(array, lambda x: x >= FIRST_WORD_ID)
    named = F.create_map(*[F.lit(v) for pair in SPECIAL_TOKENS.items() for v in pair])

    def special(token_id: Column) -> Column:
        return F.coalesce(F.try_element_at(named, token_id), F.lit(SPECIAL_TOKENS[UNK_ID]))

    out = map_arrays(encoded.select(*key, ids), key, array, vocab, "id", "token", special, max_rows)
    return out.select(*key, F.array_join("mapped", " ").alias("decoded"))
