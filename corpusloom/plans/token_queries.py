"""Registered queries over tokens: encoding, vocabulary, packing, labels, reports, streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import labels as lab
from corpusloom.functions import tokens as tok
from corpusloom.functions.arith import int_div
from corpusloom.functions.text import drop_blank, preview
from corpusloom.operators import packing
from corpusloom.operators.ordering import ordered_index
from corpusloom.operators.slicing import first_rows
from corpusloom.operators.vocab import build_vocab, decode_words, encode_words
from corpusloom.plans import fixtures as fx
from corpusloom.plans import prepare as prep
from corpusloom.schemas import BATCH_SIZE, BLOCK_LENGTH, BYTE_EOS, EOS_ID, PACKED_COLUMNS
from corpusloom.session import bucketed, scratch_path
from corpusloom.sources import store
from corpusloom.sources.corpora import CORPUS_KEY, read_table, scan_corpora
from corpusloom.streaming import ingest, ledger
from corpusloom.streaming.stateful import pack_stateful

SCATTER = 7919      # fixed value: steps between the positions a batch asks for
BYTE_MASK = 101     # fixed value: the byte standing in for the mask token


def byte_ids() -> Column:
    return tok.append_eos(tok.byte_tokens(F.col("text")), BYTE_EOS)


def byte_length() -> Column:
    return tok.byte_count(F.col("text")) + 1


def as_text(df: DataFrame, *columns: str) -> DataFrame:
    """Arrays as space-separated text, the form the checks compare."""
    return df.withColumns({c: tok.joined(F.col(c)) for c in columns})


def text_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.documents(spark, sf_dir).select("split", "doc_id", "text")


def encode_byte(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = text_documents(spark, sf_dir)
    return as_text(docs.select("doc_id", tok.byte_tokens(F.col("text")).alias("input_ids")), "input_ids")


def append_eos(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = fx.blanked_documents(spark, sf_dir)
    return as_text(docs.select("doc_id", byte_ids().alias("input_ids")), "input_ids")


def word_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = tok.word_tokens(F.col("text"))
    docs = text_documents(spark, sf_dir).select("doc_id", words.alias("tokens"))
    return as_text(docs.select("doc_id", F.size("tokens").alias("n_tokens"), "tokens"), "tokens")


def train_vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_vocab(text_documents(spark, sf_dir).where(F.col("split") == "train"))


def vocab_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    return train_vocab(spark, sf_dir).select("token", "n", "id")


def encoded_documents(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    vocab = train_vocab(spark, sf_dir)
    return encode_words(fx.documents(spark, sf_dir), ["doc_id"], vocab), vocab


def encode_word(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded, _ = encoded_documents(spark, sf_dir)
    return as_text(encoded.select("doc_id", F.size("input_ids").alias("n_tokens"), "input_ids"), "input_ids")


def decode_word(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded, vocab = encoded_documents(spark, sf_dir)
    return decode_words(encoded, ["doc_id"], vocab, skip_special=True)


def next_token_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded, _ = encoded_documents(spark, sf_dir)
    ids = tok.append_eos(F.col("input_ids"), EOS_ID)
    pairs = encoded.select("doc_id", ids.alias("_ids")).select("doc_id", tok.next_token_pairs(F.col("_ids")).alias("_p"))
    shown = F.transform("_p", lambda p: F.concat_ws(">", p["prev"].cast("string"), p["next"].cast("string")))
    return pairs.select("doc_id", F.size("_p").alias("n_pairs"), F.array_join(shown, " ").alias("pairs"))


def padded(spark: SparkSession, sf_dir: str, extra: list[str] | None = None) -> DataFrame:
    """Right-padded byte rows of the documents, pad = EOS."""
    docs = text_documents(spark, sf_dir)
    rows = docs.select("doc_id", *(extra or []), tok.first_byte_tokens(F.col("text"), BLOCK_LENGTH).alias("_ids"))
    return rows.select(
        "doc_id",
        *(extra or []),
        tok.pad_right(F.col("_ids"), BLOCK_LENGTH, BYTE_EOS).alias("input_ids"),
        tok.mask_right(F.col("_ids"), BLOCK_LENGTH).alias("attention_mask"),
    )


def pad_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_text(padded(spark, sf_dir), "input_ids", "attention_mask")


def pad_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = text_documents(spark, sf_dir).select("doc_id", tok.first_byte_tokens(F.col("text"), BLOCK_LENGTH).alias("_ids"))
    rows = docs.select(
        "doc_id",
        tok.pad_left(F.col("_ids"), BLOCK_LENGTH, BYTE_EOS).alias("input_ids"),
        tok.mask_left(F.col("_ids"), BLOCK_LENGTH).alias("attention_mask"),
    )
    return as_text(rows, "input_ids", "attention_mask")


def _labelled(spark: SparkSession, sf_dir: str, labels: Column) -> DataFrame:
    return padded(spark, sf_dir).select("doc_id", "input_ids", labels.alias("labels"))


def labels_ignore_pad(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _labelled(spark, sf_dir, lab.ignore_pad(F.col("input_ids"), BYTE_EOS))
    return as_text(rows.select("doc_id", "labels"), "labels")


def labels_mlm(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _labelled(spark, sf_dir, lab.only_masked(F.col("input_ids"), BYTE_MASK))
    return as_text(rows.select("doc_id", "labels"), "labels")


def strip_ignored(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _labelled(spark, sf_dir, lab.ignore_pad(F.col("input_ids"), BYTE_EOS))
    return as_text(rows.select("doc_id", lab.strip_ignored(F.col("labels")).alias("kept")), "kept")


def labels_equal(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _labelled(spark, sf_dir, lab.ignore_pad(F.col("input_ids"), BYTE_EOS))
    same = lab.equal_to_ids(F.col("labels"), F.col("input_ids"))
    return rows.select("doc_id", same.cast("int").alias("identical"))


def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.token_counts(padded(spark, sf_dir, ["split"]), ["split"], F.col("attention_mask"))


def packed_documents(
    spark: SparkSession, sf_dir: str, scope: str = "batch", batch_rows: int = fx.PACK_ROWS, shards: int = 1,
    in_ranges: bool = False,
) -> DataFrame:
    """Byte-packed blocks of every split of the documents.

    The texts are placed once, in buckets by their key; counts, plan and texts meet there.
    """
    docs = bucketed(text_documents(spark, sf_dir), "texts", "split", *fx.DOC_KEY)
    content = packing.text_bytes()
    plan = packing.pack_plan(docs, ["split"], fx.DOC_KEY, fx.DOC_LEVELS, content.count(), BLOCK_LENGTH, scope, batch_rows, shards)
    return packing.pack_blocks(docs, plan, ["split"], fx.DOC_KEY, content, BLOCK_LENGTH, in_ranges=in_ranges)


def pack_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_text(packed_documents(spark, sf_dir), *PACKED_COLUMNS)


def pack_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch packing as three workers would do it, each on its contiguous shard."""
    return as_text(packed_documents(spark, sf_dir, shards=3), *PACKED_COLUMNS).drop("labels", "attention_mask")


def pack_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_text(packed_documents(spark, sf_dir, scope="split"), *PACKED_COLUMNS)


def pack_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = packing.pack_plan(
        fx.documents(spark, sf_dir), ["split"], fx.DOC_KEY, fx.DOC_LEVELS, byte_length(), BLOCK_LENGTH,
        "batch", fx.PACK_ROWS,
    )
    return packing.pack_stats(plan, ["split"], BLOCK_LENGTH)


def packed_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "packed")
    packed = packed_documents(spark, sf_dir, in_ranges=True).withColumn("dataset", F.lit("documents"))
    store.write_packed(packed, path, placed=True)
    back = store.as_export(store.read_packed(spark, path))
    return as_text(back.select("dataset", "split", "block_id", *PACKED_COLUMNS), *PACKED_COLUMNS)


def peek_packed(spark: SparkSession, sf_dir: str, n_blocks: int = 3) -> DataFrame:
    """First three training blocks of the stored documents: both ends and the readable form.

    The store is sorted by block, so the filter skips whole files and row groups.
    """
    path = scratch_path(spark, "packed")
    store.write_packed(packed_documents(spark, sf_dir).withColumn("dataset", F.lit("documents")), path)
    return store.read_packed(spark, path, "train").where(F.col("block_id") < n_blocks).select(
        "block_id",
        tok.joined(F.slice("input_ids", 1, 15)).alias("first_ids"),
        tok.joined(F.slice("input_ids", -15, 15)).alias("last_ids"),
        tok.byte_repr(F.col("input_ids")).alias("decoded"),
    )


def rows_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A loader's batch of 64 scattered training blocks, read by position from the files that hold them."""
    path = scratch_path(spark, "packed")
    store.write_packed(packed_documents(spark, sf_dir).withColumn("dataset", F.lit("documents")), path)
    sizes = store.committed(spark, path).where("split = 'train'").first()
    asked = [i * SCATTER % sizes.n_rows for i in range(64)]
    rows = store.blocks_at(spark, path, "train", asked, ["documents"])
    return as_text(rows.select("slot", "idx", "dataset", "block_id", "input_ids"), "input_ids")


def tokenizer_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three usable training rows per corpus as the tokenizer sees them."""
    source = scan_corpora(spark, sf_dir).where(F.col("split") == "train")
    rows = first_rows(drop_blank(source, "text"), "dataset", CORPUS_KEY, 3, source).withColumn("_ids", tok.first_byte_tokens(F.col("text"), BLOCK_LENGTH))
    rows = rows.withColumns(
        {
            "_padded": tok.pad_right(F.col("_ids"), BLOCK_LENGTH, BYTE_EOS),
            "_mask": tok.mask_right(F.col("_ids"), BLOCK_LENGTH),
        }
    )
    return rows.select(
        "dataset",
        "sample",
        preview(F.col("text")).alias("preview"),
        tok.joined(F.slice("_padded", 1, 20)).alias("first_ids"),
        F.size("_padded").alias("length"),
        F.aggregate("_mask", F.lit(0), lambda a, x: a + x).alias("non_pad"),
        tok.byte_repr(F.filter("_padded", lambda x: x != BYTE_EOS)).alias("decoded"),
        tok.joined(F.slice("_mask", 1, 20)).alias("first_mask"),
    )


def batch_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First two members of every batch of packed blocks."""
    packed = packed_documents(spark, sf_dir)
    rows = packed.withColumns(
        {"batch_id": int_div(F.col("block_id"), BATCH_SIZE), "item": F.col("block_id") % BATCH_SIZE}
    ).where(F.col("item") < 2)
    same = lab.equal_to_ids(F.col("labels"), F.col("input_ids"))
    return rows.select(
        "split",
        "batch_id",
        "item",
        tok.joined(F.slice("input_ids", 1, 20)).alias("first_ids"),
        tok.joined(F.slice("attention_mask", 1, 20)).alias("first_mask"),
        tok.joined(F.slice("labels", 1, 20)).alias("first_labels"),
        F.size("input_ids").alias("length"),
        tok.byte_repr(F.col("input_ids")).alias("decoded"),
        same.cast("int").alias("labels_equal"),
        F.when(~same, tok.byte_repr(lab.strip_ignored(F.col("labels")))).alias("decoded_labels"),
    )


def _landed(df: DataFrame, tag: str) -> str:
    folder = scratch_path(df.sparkSession, tag)
    df.write.parquet(folder)
    return folder


def stream_tokenize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents arriving as files, tokenized as they come; run twice to show nothing is taken again."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    folder = _landed(docs.repartition("doc_id"), "arriving")
    sink, checkpoint = scratch_path(spark, "tokenized"), scratch_path(spark, "progress")
    columns = ["doc_id", byte_ids().alias("input_ids")]
    files = max(3, spark.sparkContext.defaultParallelism)       # a batch gives every core a file
    for _ in range(2):
        ingest.ingest(ingest.read_arriving(spark, folder, docs.schema, files), columns, sink, checkpoint)
    return as_text(ingest.read_sink(spark, sink), "input_ids")


def ingest_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file per source and a damaged one, taken in two runs: the second has only the damaged file to try again."""
    docs = read_table(spark, sf_dir, "documents").select("source", "doc_id", "text")
    folder, sink, book = (scratch_path(spark, x) for x in ("arriving", "taken", "ledger"))
    docs.repartition("source").write.partitionBy("source").parquet(folder)
    spark.range(1).select(F.lit("no table").alias("value")).write.text(f"{folder}/source=damaged")
    schema = docs.drop("source").schema
    for _ in range(2):
        ledger.take_files(spark, folder, schema, sink, book, pattern="part-*")
    states = ledger.file_states(spark, book)
    rows = ledger.taken_rows(spark, schema, sink, book)
    states = states.select(F.regexp_extract("path", "source=([^/]*)/", 1).alias("source"), "status", "n_rows", "attempts")
    total = rows.agg(F.count(F.lit(1)).alias("n_rows"), F.sum(F.octet_length("text").cast("bigint")).alias("n_bytes"))
    total = total.withColumns({"source": F.lit("all"), "status": F.lit("read back")})
    return states.unionByName(total, allowMissingColumns=True)


def stream_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose pack groups arrive in parts, over three batches; open groups wait in the stream's state."""
    docs = fx.documents(spark, sf_dir)
    placed = ordered_index(docs.select("split", "doc_id"), ["split"], fx.DOC_KEY, fx.DOC_LEVELS)
    group = int_div(F.col("idx"), fx.PACK_ROWS)
    last = group == int_div(F.col("n_rows") - 1, fx.PACK_ROWS)
    rows = F.when(last, F.col("n_rows") - group * fx.PACK_ROWS).otherwise(fx.PACK_ROWS)
    groups = placed.select("doc_id", group.alias("arrival_group"), rows.cast("bigint").alias("group_rows"))
    arriving = docs.select("split", "doc_id", "text").join(groups, "doc_id")
    files = max(2, spark.sparkContext.defaultParallelism)       # of each batch, one for every core
    folder = _landed(arriving.repartition(3 * files, "doc_id"), "arriving")
    sink, checkpoint = scratch_path(spark, "packed"), scratch_path(spark, "progress")
    pack_stateful(
        ingest.read_arriving(spark, folder, arriving.schema, files), ["split", "arrival_group"], fx.DOC_KEY,
        F.col("text").cast("binary"), BLOCK_LENGTH, sink, checkpoint, announced=F.col("group_rows"),
    )
    return as_text(ingest.read_sink(spark, sink), "input_ids")


def rank_export(spark: SparkSession, sf_dir: str, eos: bool = True) -> DataFrame:
    """The whole way: run configuration, slices, packing, store, epoch order, batches by rank."""
    packing_settings = prep.Packing(batch_rows=fx.PACK_ROWS, eos=eos)
    config = {"documents": {"train_slice": [0.1, 0.2]}, "conversations": {"train_slice": 0.5}, "benchmark": {}}
    plan = prep.run_plan(spark, config, packing_settings)
    root, out = scratch_path(spark, "prepared"), scratch_path(spark, "epoch")
    for _ in range(2):      # the second call finds everything stored
        prep.prepare(spark, scan_corpora(spark, sf_dir), plan, root, packing_settings)
    blocks = prep.open_stage(spark, plan, root, "fit")
    prep.export(prep.order_for_epoch(blocks, fx.SEED, fx.EPOCH, fx.WORLD, BATCH_SIZE, fx.ACCUMULATE), out)
    rows = spark.read.parquet(out).withColumn("rank", F.col("rank").cast("bigint"))
    rows = rows.select("split", "slot", "rank", "micro_batch", "opt_step", "dataset", "block_id", "input_ids")
    return as_text(rows, "input_ids")


def rank_export_no_eos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same run for a tokenizer without an end mark."""
    return rank_export(spark, sf_dir, eos=False)


QUERIES = {
    "encode_byte": encode_byte,
    "append_eos": append_eos,
    "word_tokens": word_tokens,
    "vocab_build": vocab_build,
    "encode_word": encode_word,
    "decode_word": decode_word,
    "next_token_pairs": next_token_pairs,
    "pad_truncate": pad_truncate,
    "pad_left": pad_left,
    "labels_ignore_pad": labels_ignore_pad,
    "labels_mlm": labels_mlm,
    "strip_ignored": strip_ignored,
    "labels_equal": labels_equal,
    "token_counts": token_counts,
    "pack_batch": pack_batch,
    "pack_shards": pack_shards,
    "pack_split": pack_split,
    "pack_stats": pack_stats,
    "packed_roundtrip": packed_roundtrip,
    "peek_packed": peek_packed,
    "rows_at": rows_at,
    "tokenizer_report": tokenizer_report,
    "batch_report": batch_report,
    "stream_tokenize": stream_tokenize,
    "stream_pack": stream_pack,
    "ingest_ledger": ingest_ledger,
    "rank_export": rank_export,
    "rank_export_no_eos": rank_export_no_eos,
}
