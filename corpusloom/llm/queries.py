"""Registered queries of the operators in this package, with production parameters and whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import bin_slack, bpe, chat, dac, hash_tree, pages, parity, quality, repair, repeats, spelling, warc, winnow, word_lm
from corpusloom.llm.common import table
from corpusloom.session import scratch_path


def chat_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 1 over all conversations, with the planted conversation -1."""
    said = "</s>[INST] ok [/INST]"
    planted = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(said).alias("text"),
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(planted)
    return chat.conversation_digests(chat.prefix_examples(turns))


def host_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 2 over all pages."""
    return pages.main_text(table(spark, sf_dir, "pages")).select(
        "page_id", "url", "text", F.char_length("text").cast("bigint").alias("n_chars"), "path"
    )


def cross_entropy_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 3: all documents, scored by word bigram models of the good ones and of all."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return word_lm.score(docs, labels.where("quality = 1")).withColumn("selected", F.col("score") < 0)


def addressable_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 4: all documents written as segments, then read back."""
    folder = scratch_path(spark, "token-segments")
    dac.write(table(spark, sf_dir, "documents"), folder, bpe.tokenizer_path(), end_id=2)
    digests = dac.read_documents(spark, folder).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return dac.with_start(digests, folder).select("doc_id", "start", "n_tokens", "ids_crc32")


def winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 5: all documents against all benchmark items."""
    found = winnow.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def hash_tree_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 6: all documents into 24 shards (3 regions, 2 racks each, 4 shards each)."""
    return hash_tree.shard_documents(table(spark, sf_dir, "documents"), hash_tree.even_tree(3, 2, 4))


def parity_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 7: all documents, three-word shingles, similarity 0.9."""
    return parity.similar_groups(table(spark, sf_dir, "documents"), parity.Join(words=3, percent=90))


def compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 8 over all documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.with_quality(docs).select("doc_id", "quality.*")


def bin_slack_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 9: all documents packed into sequences of 2048 ids."""
    packing = bin_slack.Packing(bpe.tokenizer_path(), capacity=2048, end_id=1)
    pieces = bin_slack.pack(table(spark, sf_dir, "documents"), packing)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def warc_histories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 10: all pages archived and read back through the merged index.

    The table has no capture times; page ids are taken as seconds after the start of 2024.
    """
    captured = F.timestamp_seconds(F.lit(1704067200) + F.col("page_id"))
    found = warc.capture_histories(spark, table(spark, sf_dir, "pages"), scratch_path(spark, "warc"), captured)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "urlkey", "captured", "part", "seq")


def prefix_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 11: all documents without the bytes of any repeated string of 200 bytes."""
    return repeats.repeat_report(table(spark, sf_dir, "documents"))


def spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 12: words of all documents, each with its form and the root of its chain."""
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


def conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 13: all conversations, damaged by rule, and the cheapest repair of each."""
    return repair.repair_damaged(table(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_chat_prefix": chat_prefix,
    "op2_host_paths": host_paths,
    "op3_cross_entropy_difference": cross_entropy_difference,
    "op4_addressable_codes": addressable_codes,
    "op5_winnowing": winnowing,
    "op6_hash_tree_shards": hash_tree_shards,
    "op7_parity_join": parity_join,
    "op8_compression_bands": compression_bands,
    "op9_bin_slack_packing": bin_slack_packing,
    "op10_warc_histories": warc_histories,
    "op11_prefix_intervals": prefix_intervals,
    "op12_spelling_variants": spelling_variants,
    "op13_conversation_repair": conversation_repair,
}

_LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_WORDS = rf"list_filter(regexp_split_to_array(translate(coalesce(text, ''), {_LETTERS}), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"



def _escaped(column: str) -> str:
    for plain, shown in (("\\", "\\\\"), ("<s>", "<\\s>"), ("</s>", "<\\/s>"), ("[INST]", "[\\INST]"), ("[/INST]", "[\\/INST]")):
        column = f"replace({column}, '{plain}', '{shown}')"
    return column


ORACLE_SQL: dict[str, str] = {
    "op1_chat_prefix": f"""
        WITH t AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
            UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
        )
        SELECT conv_id, count(*)::BIGINT AS n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
            coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
            sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
            sum(23 + length({_escaped('role')}) + length({_escaped('text')}))::BIGINT AS formatted_chars,
            (count(*) FILTER (WHERE role = 'assistant')
                + CASE WHEN arg_max(role, (turn, role, text)) = 'assistant' THEN 0 ELSE 1 END)::BIGINT AS n_examples
        FROM t GROUP BY conv_id
    """,
    "op5_winnowing": f"""
        WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
        b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
        bw AS (
            SELECT DISTINCT item_id, least(len(w), 13) AS m, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS win
            FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i FROM b WHERE len(w) > 0)
        ),
        dw AS (
            SELECT doc_id, m, i, array_to_string(w[i:i + m - 1], ' ') AS win
            FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, (SELECT DISTINCT m FROM bw) WHERE len(w) >= m)
        ),
        hit AS (SELECT doc_id, item_id, i, m FROM dw JOIN bw USING (m, win)),
        covered AS (
            SELECT doc_id, count(DISTINCT p) AS n_hit
            FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM (SELECT DISTINCT doc_id, i, m FROM hit)) GROUP BY doc_id
        ),
        named AS (
            SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
            FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id
        )
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
            sha256(coalesce(ids, '')) AS items_sha256,
            coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
        FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
    """,
    "op7_parity_join": f"""
        WITH RECURSIVE d AS (
            SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), {_LETTERS}), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
            FROM documents
        ),
        s AS (
            SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS g
            FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM d WHERE len(w) > 0)
        ),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        both_have AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2),
        link AS (
            SELECT a, b FROM both_have JOIN n AS p ON p.doc_id = a JOIN n AS q ON q.doc_id = b WHERE 100 * c >= 90 * (p.n + q.n - c)
        ),
        step AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
        reach(a, b) AS (SELECT doc_id, doc_id FROM d UNION SELECT reach.a, step.b FROM reach JOIN step ON step.a = reach.b)
        SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, r.c AS component_id
        FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS c FROM reach GROUP BY a) AS r USING (doc_id)
    """,
}
