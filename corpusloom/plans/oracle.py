r"""Independent SQL for the registered queries, run by DuckDB on the same tables.

Written over single-window and token-per-row forms on purpose: slower, but a
different way to the same rows than the Spark jobs take.
"""

from __future__ import annotations

from corpusloom.functions.text import WHITESPACE
from corpusloom.functions.tokens import WORD_PATTERN
from corpusloom.operators.permutation import KEY_MODULUS, KEY_SHIFT, MIX_MODULUS, MIX_SHIFT, MULTIPLIERS, salts

SPLIT = "CASE {key} % 10 WHEN 0 THEN 'validation' WHEN 1 THEN 'test' ELSE 'train' END"

DOCS = f"docs AS (SELECT *, {SPLIT.format(key='doc_id')} AS split FROM documents)"

CORPORA = f"""raw AS (
  SELECT 'documents' AS dataset, 0 AS source_ord, doc_id AS key1, 0::BIGINT AS key2, text FROM documents
  UNION ALL SELECT 'conversations', 1, conv_id, turn, text FROM conversations
  UNION ALL SELECT 'benchmark', 2, item_id, 0, text FROM benchmark
  UNION ALL SELECT 'pages', 3, page_id, 0, url FROM pages),
corpora AS (SELECT dataset, source_ord, key1, key2, coalesce(text, '') AS text, {SPLIT.format(key='key1')} AS split FROM raw)"""

CONCAT = CORPORA + """,
concat_rows AS (SELECT split, dataset, key1, key2,
  row_number() OVER (PARTITION BY split ORDER BY source_ord, key1, key2) - 1 AS idx,
  count(*) OVER (PARTITION BY split) AS n_rows FROM corpora)"""

TRAIN_ROWS = DOCS + """,
ix AS (SELECT doc_id, n_chars, text, row_number() OVER (ORDER BY doc_id) - 1 AS idx, count(*) OVER () AS n
  FROM docs WHERE split = 'train')"""

BYTES = "list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda x: ('0x' || x)::INT)"
JOINED = "array_to_string({ids}, ' ')"
REPR = (
    r"array_to_string(list_transform({ids}, lambda x: CASE WHEN x = 256 THEN '<eos>' "
    r"WHEN x BETWEEN 32 AND 126 THEN chr(x) ELSE '\x' || lpad(hex(x), 2, '0') END), '')"
)


def _shuffled(source: str, key: str, n: str, seed: int = 42, epoch: int = 1) -> str:
    """`drawn`: the rows of `source` (with `split`) and each one's `position` in the epoch's order of its split."""

    def hashed(digit: str, salts: tuple[int, int]) -> str:
        keyed = f"((({digit}) * {MULTIPLIERS[0]} + {salts[0]}) % {KEY_MODULUS} >> {KEY_SHIFT})"
        return f"(({keyed} * {MULTIPLIERS[1]} + {salts[1]}) % {MIX_MODULUS} >> {MIX_SHIFT})"

    def mixed(x: str) -> str:
        high, low = f"({x} // b)", f"({x} % b)"
        for i, pair in enumerate(salts(seed, epoch)):
            if i % 2 == 0:
                high = f"(({high} + {hashed(low, pair)}) % a)"
            else:
                low = f"(({low} + {hashed(high, pair)}) % b)"
        return f"({high} * b + {low})"

    return f"""digits AS (SELECT split, {key} AS k, {n} AS size, a, ({n} + a - 1) // a AS b
  FROM (SELECT *, (floor(sqrt({n}::DOUBLE)) + 1)::BIGINT AS a FROM {source})),
walked AS (SELECT *, {mixed('k')} AS place FROM digits UNION ALL SELECT split, k, size, a, b, {mixed('place')} FROM walked WHERE place >= size),
drawn AS (SELECT s.*, CASE WHEN s.split = 'train' THEN w.place ELSE s.{key} END AS position
  FROM {source} s JOIN walked w ON w.split = s.split AND w.k = s.{key} WHERE w.place < w.size)"""


def _pack(group: str) -> str:
    """One row per byte token, numbered inside its group and cut every 128."""
    return DOCS + f""",
ix AS (SELECT split, doc_id, list_concat({BYTES}, [256]) AS ids,
  row_number() OVER (PARTITION BY split ORDER BY doc_id) - 1 AS idx,
  count(*) OVER (PARTITION BY split) AS n FROM docs),
toks AS (SELECT split, idx, {group} AS pack_group, unnest(ids) AS id, generate_subscripts(ids, 1) AS p FROM ix),
pos AS (SELECT split, pack_group, id,
  row_number() OVER (PARTITION BY split, pack_group ORDER BY idx, p) - 1 AS o FROM toks),
cut AS (SELECT split, pack_group, o // 128 AS b, list(id ORDER BY o) AS ids
  FROM pos GROUP BY split, pack_group, o // 128 HAVING count(*) = 128),
blocks AS (SELECT split, pack_group, b, ids,
  row_number() OVER (PARTITION BY split ORDER BY pack_group, b) - 1 AS block_id FROM cut)"""


BATCHES = _pack("idx // 100")
ONES = "array_to_string(list_transform(ids, lambda x: 1), ' ')"
PACKED = f"split, block_id, pack_group, {JOINED.format(ids='ids')} AS input_ids, {JOINED.format(ids='ids')} AS labels, {ONES} AS attention_mask"

# three contiguous shards, the first n % 3 one row longer, batches of 100 inside each
SHARD_GROUP = """(CASE
  WHEN idx < least(n % 3, 1) * (n // 3 + 1) THEN idx // 100
  WHEN idx < n // 3 + least(n % 3, 1) THEN idx // 100
  WHEN idx < 2 * (n // 3) + least(n % 3, 2) THEN
    ceil((n // 3 + least(n % 3, 1)) / 100.0)::BIGINT + (idx - (n // 3 + least(n % 3, 1))) // 100
  ELSE ceil((n // 3 + least(n % 3, 1)) / 100.0)::BIGINT
    + ceil((n // 3 + least(n % 3, 2) - least(n % 3, 1)) / 100.0)::BIGINT
    + (idx - (2 * (n // 3) + least(n % 3, 2))) // 100 END)"""

WORDS = f"regexp_extract_all(text, '{WORD_PATTERN}')"

VOCAB = DOCS + f""",
counts AS MATERIALIZED (SELECT token, count(*) AS n FROM (SELECT unnest({WORDS}) AS token FROM docs WHERE split = 'train') GROUP BY token),
vocab AS MATERIALIZED (SELECT token, n, (row_number() OVER (ORDER BY n DESC, token) + 2)::INT AS id FROM counts)"""

ENCODED = VOCAB + f""",
toks AS (SELECT doc_id, unnest(w) AS token, generate_subscripts(w, 1) AS p
  FROM (SELECT doc_id, {WORDS} AS w FROM docs)),
enc AS (SELECT doc_id, p, token, coalesce(id, 0) AS id FROM toks LEFT JOIN vocab USING (token))"""

BIGRAMS = VOCAB + f""",
words AS (SELECT doc_id, split, list_concat({WORDS}, ['']) AS w FROM docs),
seq AS (SELECT doc_id, split, unnest(w) AS token, generate_subscripts(w, 1) AS p FROM words),
ids AS MATERIALIZED (SELECT doc_id, split, p, CASE WHEN token = '' THEN 1 ELSE coalesce(id, 0) END AS id FROM seq LEFT JOIN vocab USING (token)),
pairs AS (SELECT * FROM (SELECT doc_id, split, id AS prev,
  lead(id) OVER (PARTITION BY doc_id ORDER BY p) AS next FROM ids) WHERE next IS NOT NULL),
bigrams AS MATERIALIZED (SELECT prev, next, count(*) AS n FROM pairs WHERE split = 'train' GROUP BY prev, next),
contexts AS (SELECT prev, sum(n)::BIGINT AS context_n FROM bigrams GROUP BY prev),
size AS (SELECT count(*) + 3 AS v FROM vocab)"""

SCORED = BIGRAMS + """,
held AS (SELECT doc_id, -ln((coalesce(n, 0) + 0.1::DOUBLE) / (coalesce(context_n, 0) + 0.1::DOUBLE * v)) AS loss
  FROM (SELECT * FROM pairs WHERE split = 'validation') LEFT JOIN bigrams USING (prev, next)
  LEFT JOIN contexts USING (prev) CROSS JOIN size)"""

PADDED = f"""b AS (SELECT doc_id, {SPLIT.format(key='doc_id')} AS split, {BYTES} AS ids FROM documents),
padded AS (SELECT doc_id, split,
  list_concat(ids[1:128], list_transform(range(greatest(0, 128 - len(ids))), lambda x: 256)) AS input_ids,
  list_concat(list_transform(ids[1:128], lambda x: 1), list_transform(range(greatest(0, 128 - len(ids))), lambda x: 0)) AS mask,
  list_concat(list_transform(range(greatest(0, 128 - len(ids))), lambda x: 256), ids[1:128]) AS left_ids,
  list_concat(list_transform(range(greatest(0, 128 - len(ids))), lambda x: 0), list_transform(ids[1:128], lambda x: 1)) AS left_mask
  FROM b)"""

METRICS = """log AS (SELECT user_id AS run, event_type AS name, value, 1 + event_id % 4 AS batch_rows,
  row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS step FROM events),
metrics AS (SELECT *, step // 20 AS epoch, step % 20 AS batch_idx FROM log)"""

CHECKS = """checks AS (SELECT user_id AS run, event_type AS name,
  CASE WHEN event_id % 83 <> 0 THEN CASE WHEN event_id % 97 = 0 THEN 'nan'::DOUBLE WHEN event_id % 89 = 0 THEN '-inf'::DOUBLE ELSE value END END AS value,
  row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) - 1 AS step FROM events)"""

LOSSES = """e AS (SELECT vec_id // 4 AS batch_id, CASE WHEN vec_id % 101 = 0 THEN 1000000 WHEN vec_id % 103 <> 0 THEN label END AS label, list_transform(embedding, lambda x: x::DOUBLE) AS z FROM embeddings),
l AS (SELECT batch_id, label IS DISTINCT FROM 9 AND NOT coalesce(label BETWEEN 0 AND len(z) - 1, false) AS bad,
  CASE WHEN label <> 9 AND label BETWEEN 0 AND len(z) - 1 THEN
  list_max(z) + ln(list_sum(list_transform(z, lambda x: exp(x - list_max(z))))) - z[label + 1] END AS loss FROM e),
batches AS (SELECT batch_id, count(*) AS n_rows, count(loss) AS n_scored, count(*) FILTER (bad) AS n_bad,
  avg(loss) AS loss FROM l GROUP BY batch_id)"""

FILES = "files AS (SELECT source AS repo, CASE WHEN doc_id % 11 <> 0 THEN n_chars END AS size FROM documents)"
REPOS = FILES + """,
repos AS (SELECT repo, count(*) AS n_files, nullif(sum(size), 0)::BIGINT AS total_bytes FROM files GROUP BY repo)"""
READABLE = """CASE WHEN {t} IS NULL THEN 'N/A' WHEN {t} < 1024 THEN {t} || ' Bytes'
  WHEN {t} < 1048576 THEN format('{{:.1f}} KiB', {t} / 1024.0)
  WHEN {t} < 1073741824 THEN format('{{:.1f}} MiB', {t} / 1048576.0)
  ELSE format('{{:.1f}} GiB', {t} / 1073741824.0) END""".format

BLANKED = "blanked AS (SELECT doc_id, CASE WHEN doc_id % 13 = 0 THEN ' ' || chr(9) || chr(10) ELSE text END AS text FROM documents)"
HAS_TEXT = "trim(text, '" + WHITESPACE + "') <> ''"

_LABELS = "list_transform(input_ids, lambda x: CASE WHEN x = 256 THEN -100 ELSE x END)"

CORPUS_SQL = {
    "latest_by_key": """SELECT user_id, event_type, event_id, value, props, n - 1 AS n_overwritten FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) AS r,
    count(*) OVER (PARTITION BY user_id, event_type) AS n FROM events) WHERE r = 1""",
    "scan_split": f"WITH {DOCS} SELECT * FROM docs WHERE split = 'train'",
    "split_assign": f"WITH {CORPORA} SELECT dataset, split, key1, key2 FROM corpora",
    "split_counts": f"WITH {CORPORA} SELECT dataset, split, count(*) AS n_rows FROM corpora GROUP BY dataset, split",
    "stage_totals": f"WITH {CORPORA} SELECT split, count(DISTINCT dataset) AS n_sources, count(*) AS n_rows FROM corpora GROUP BY split",
    "stage_select": f"WITH {CORPORA} SELECT dataset, split, key1, key2 FROM corpora WHERE split IN ('train', 'validation')",
    "scan_glob": "SELECT doc_id, source, n_chars, text FROM documents",
    "cache_counts": f"WITH {CORPORA} SELECT dataset, split, count(*) AS n_rows FROM corpora GROUP BY dataset, split",
    "text_resolve": "SELECT page_id, 'url' AS text_column, url AS text FROM pages",
    "text_coalesce": "SELECT page_id, CASE WHEN page_id % 7 = 0 THEN html ELSE url END AS text FROM pages",
    "text_normalise": """SELECT doc_id, CASE WHEN doc_id % 17 = 0 THEN '' ELSE text END AS text,
  n_chars::VARCHAR AS n_chars_text FROM documents""",
    "nonblank": f"WITH {BLANKED} SELECT doc_id, text FROM blanked WHERE {HAS_TEXT}",
    "manifest_classify": """SELECT d.doc_id, d.source, CASE l.toxic WHEN 0 THEN 'ok' WHEN 1 THEN 'infected' END AS scan_result,
  CASE WHEN l.toxic = 1 THEN 'unsafe' ELSE 'safe' END AS safety FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    "catalog_search": "SELECT DISTINCT p_name AS id FROM part WHERE p_name ILIKE '%red%' ORDER BY id LIMIT 20",
    "catalog_configs": "SELECT DISTINCT p_brand AS source, p_type AS config FROM part",
    "size_estimate": f"WITH {REPOS} SELECT repo, n_files, total_bytes, {READABLE(t='total_bytes')} AS readable FROM repos",
    "size_total": f"""WITH {REPOS}, total AS (SELECT count(*) AS n_repos, coalesce(sum(total_bytes), 0)::BIGINT AS total_bytes,
  count(*) FILTER (total_bytes IS NULL) AS n_unknown FROM repos)
SELECT *, {READABLE(t='total_bytes')} AS readable FROM total""",
    "unregistered_sources": """SELECT source, count(*) AS n_rows FROM documents
WHERE source NOT IN (SELECT 'src' || i FROM range(15) t(i)) GROUP BY source""",
    "missing_splits": f"""WITH {CORPORA}, planned AS (
  SELECT dataset, split FROM (VALUES ('documents'), ('conversations'), ('benchmark'), ('pages')) d(dataset),
    (VALUES ('train'), ('validation'), ('test')) s(split)),
present AS (SELECT DISTINCT dataset, split FROM corpora WHERE NOT (dataset = 'benchmark' AND split = 'test'))
SELECT dataset, count(*) AS n_missing, string_agg(split, ',' ORDER BY split) AS missing
FROM planned p WHERE NOT EXISTS (SELECT 1 FROM present q WHERE q.dataset = p.dataset AND q.split = p.split) GROUP BY dataset""",
    "row_index": f"""WITH {CORPORA} SELECT dataset, split, key1, key2,
  row_number() OVER (PARTITION BY dataset, split ORDER BY key1, key2) - 1 AS idx,
  count(*) OVER (PARTITION BY dataset, split) AS n_rows FROM corpora""",
    "slice_head": f"WITH {TRAIN_ROWS} SELECT doc_id, n_chars, text FROM ix WHERE idx < greatest(1, ceil(n * 0.1::DOUBLE))",
    "slice_range": f"""WITH {TRAIN_ROWS} SELECT doc_id, n_chars, text FROM ix
WHERE idx >= floor(n * 0.1::DOUBLE) AND idx < least(floor(n * 0.2::DOUBLE), n)""",
    "slice_percent": f"WITH {TRAIN_ROWS} SELECT doc_id, n_chars, text FROM ix WHERE idx < round_even(10::DOUBLE * n / 100::DOUBLE, 0)",
    "multi_slice": f"""WITH {CORPORA}, ix AS (SELECT *,
  row_number() OVER (PARTITION BY dataset, split ORDER BY key1, key2) - 1 AS idx,
  count(*) OVER (PARTITION BY dataset, split) AS n FROM corpora)
SELECT dataset, split, key1, key2, text FROM ix WHERE dataset <> 'pages' AND (split <> 'train' OR CASE dataset
  WHEN 'documents' THEN idx >= floor(n * 0.1::DOUBLE) AND idx < floor(n * 0.2::DOUBLE)
  WHEN 'conversations' THEN idx < floor(n * 0.5::DOUBLE) ELSE true END)""",
    "sample_per_dataset": f"""WITH {CORPORA}, usable AS (SELECT * FROM corpora
  WHERE split = 'train' AND NOT (dataset = 'documents' AND key1 % 13 = 0) AND {HAS_TEXT})
SELECT dataset, sample, key1, key2, text FROM (SELECT *,
  row_number() OVER (PARTITION BY dataset ORDER BY key1, key2)::INT AS sample FROM usable) WHERE sample <= 3""",
    "concat_sources": f"WITH {CONCAT} SELECT split, dataset, key1, key2, idx, n_rows FROM concat_rows",
    "shuffle_epoch": f"""WITH RECURSIVE {CONCAT},
{_shuffled('concat_rows', 'idx', 'n_rows')}
SELECT split, dataset, key1, key2, idx, position FROM drawn""",
    "resume_epoch": f"""WITH RECURSIVE {CONCAT},
{_shuffled('concat_rows', 'idx', 'n_rows')}
SELECT split, position, idx, dataset, key1, key2 FROM drawn WHERE position >= n_rows // 3""",
    "batch_assign": f"""WITH {CONCAT} SELECT split, idx, dataset, key1, key2, idx // 4 AS batch_id, idx % 4 AS batch_pos FROM concat_rows""",
    "rank_plan": f"""WITH {CONCAT}, slots AS (SELECT split, idx,
  unnest(range(idx, ((n_rows + 1) // 2) * 2, n_rows)) AS slot FROM concat_rows)
SELECT split, slot, idx, slot % 2 AS rank, (slot // 2) // 4 AS micro_batch, ((slot // 2) // 4) // 2 AS opt_step FROM slots""",
}

TOKEN_SQL = {
    "encode_byte": f"SELECT doc_id, {JOINED.format(ids=BYTES)} AS input_ids FROM documents",
    "append_eos": f"WITH {BLANKED} SELECT doc_id, array_to_string(list_concat({BYTES}, [256]), ' ') AS input_ids FROM blanked",
    "word_tokens": f"SELECT doc_id, len({WORDS})::INT AS n_tokens, array_to_string({WORDS}, ' ') AS tokens FROM documents",
    "vocab_build": f"WITH {VOCAB} SELECT token, n, id FROM vocab",
    "encode_word": f"""WITH {ENCODED} SELECT d.doc_id, count(p)::INT AS n_tokens,
  coalesce(string_agg(id::VARCHAR, ' ' ORDER BY p), '') AS input_ids FROM docs d LEFT JOIN enc ON d.doc_id = enc.doc_id GROUP BY d.doc_id""",
    "decode_word": f"""WITH {ENCODED} SELECT d.doc_id,
  coalesce(string_agg(token, ' ' ORDER BY p) FILTER (id >= 3), '') AS decoded FROM docs d LEFT JOIN enc ON d.doc_id = enc.doc_id GROUP BY d.doc_id""",
    "next_token_pairs": f"""WITH {ENCODED}, ended AS (SELECT doc_id, p, id FROM enc
  UNION ALL SELECT doc_id, 1000000000, 1 FROM docs),
shifted AS (SELECT doc_id, p, id, lead(id) OVER (PARTITION BY doc_id ORDER BY p) AS nxt FROM ended)
SELECT doc_id, count(nxt)::INT AS n_pairs,
  coalesce(string_agg(id || '>' || nxt, ' ' ORDER BY p) FILTER (nxt IS NOT NULL), '') AS pairs FROM shifted GROUP BY doc_id""",
    "pad_truncate": f"WITH {PADDED} SELECT doc_id, array_to_string(input_ids, ' ') AS input_ids, array_to_string(mask, ' ') AS attention_mask FROM padded",
    "pad_left": f"WITH {PADDED} SELECT doc_id, array_to_string(left_ids, ' ') AS input_ids, array_to_string(left_mask, ' ') AS attention_mask FROM padded",
    "labels_ignore_pad": f"WITH {PADDED} SELECT doc_id, array_to_string({_LABELS}, ' ') AS labels FROM padded",
    "labels_mlm": f"""WITH {PADDED} SELECT doc_id,
  array_to_string(list_transform(input_ids, lambda x: CASE WHEN x <> 101 THEN -100 ELSE x END), ' ') AS labels FROM padded""",
    "strip_ignored": f"""WITH {PADDED} SELECT doc_id,
  array_to_string(list_filter({_LABELS}, lambda x: x <> -100), ' ') AS kept FROM padded""",
    "labels_equal": "SELECT doc_id, (strlen(text) >= 128)::INT AS identical FROM documents",
    "token_counts": f"""WITH {PADDED} SELECT split, sum(list_sum(mask))::BIGINT AS real_tokens,
  sum(128 - list_sum(mask))::BIGINT AS padded_tokens FROM padded GROUP BY split""",
    "pack_batch": f"WITH {BATCHES} SELECT {PACKED} FROM blocks",
    "pack_shards": f"WITH {_pack(SHARD_GROUP)} SELECT split, block_id, pack_group, {JOINED.format(ids='ids')} AS input_ids FROM blocks",
    "pack_split": f"WITH {_pack('0::BIGINT')} SELECT {PACKED} FROM blocks",
    "pack_stats": f"""WITH {DOCS}, ix AS (SELECT split, strlen(text) + 1 AS n,
  row_number() OVER (PARTITION BY split ORDER BY doc_id) - 1 AS idx FROM docs)
SELECT split, idx // 100 AS pack_group, sum(n)::BIGINT AS n_tokens, (sum(n) // 128)::BIGINT AS n_blocks,
  (sum(n) % 128)::BIGINT AS n_dropped FROM ix GROUP BY split, idx // 100""",
    "packed_roundtrip": f"""WITH {BATCHES} SELECT 'documents' AS dataset, split, block_id, {JOINED.format(ids='ids')} AS input_ids,
  {JOINED.format(ids='ids')} AS labels, {ONES} AS attention_mask FROM blocks""",
    "peek_packed": f"""WITH {BATCHES} SELECT block_id, {JOINED.format(ids='ids[1:15]')} AS first_ids,
  {JOINED.format(ids='ids[114:128]')} AS last_ids, {REPR.format(ids='ids')} AS decoded
FROM blocks WHERE split = 'train' ORDER BY block_id LIMIT 3""",
    "rows_at": f"""WITH {BATCHES}, t AS (SELECT *, count(*) OVER () AS n FROM blocks WHERE split = 'train')
SELECT i::INT AS slot, block_id AS idx, 'documents' AS dataset, block_id, {JOINED.format(ids='ids')} AS input_ids
FROM t JOIN range(64) r(i) ON block_id = i * 7919 % n""",
    "tokenizer_report": f"""WITH {CORPORA}, usable AS (SELECT * FROM corpora WHERE split = 'train' AND {HAS_TEXT}),
top AS (SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY key1, key2)::INT AS sample FROM usable QUALIFY sample <= 3),
b AS (SELECT dataset, sample, text, {BYTES} AS raw FROM top),
p AS (SELECT *, list_concat(raw[1:128], list_transform(range(greatest(0, 128 - len(raw))), lambda x: 256)) AS ids,
  list_transform(range(128), lambda i: (i < len(raw))::INT) AS mask FROM b)
SELECT dataset, sample, CASE WHEN length(text) > 103 THEN substring(text, 1, 100) || '...' ELSE text END AS preview,
  {JOINED.format(ids='ids[1:20]')} AS first_ids, len(ids)::INT AS length, list_sum(mask)::INT AS non_pad,
  {REPR.format(ids='raw[1:128]')} AS decoded, {JOINED.format(ids='mask[1:20]')} AS first_mask FROM p""",
    "batch_report": f"""WITH {BATCHES} SELECT split, block_id // 4 AS batch_id, block_id % 4 AS item,
  {JOINED.format(ids='ids[1:20]')} AS first_ids, array_to_string(list_transform(range(20), lambda x: 1), ' ') AS first_mask,
  {JOINED.format(ids='ids[1:20]')} AS first_labels, len(ids)::INT AS length, {REPR.format(ids='ids')} AS decoded,
  1::INT AS labels_equal, NULL::VARCHAR AS decoded_labels FROM blocks WHERE block_id % 4 < 2""",
    "stream_tokenize": f"SELECT doc_id, array_to_string(list_concat({BYTES}, [256]), ' ') AS input_ids FROM documents",
    "ingest_ledger": """SELECT source, 'taken' AS status, count(*) AS n_rows, 1::BIGINT AS attempts, NULL::BIGINT AS n_bytes FROM documents GROUP BY source
UNION ALL SELECT 'damaged', 'damaged', 0, 2, NULL UNION ALL SELECT 'all', 'read back', count(*), NULL, sum(strlen(text))::BIGINT FROM documents""",
    "stream_pack": f"WITH {BATCHES} SELECT split, pack_group AS arrival_group, b AS block_id, {JOINED.format(ids='ids')} AS input_ids FROM blocks",
}

EVAL_SQL = {
    "masked_xent": f"WITH {LOSSES} SELECT batch_id, n_rows, n_scored, n_bad, round(loss, 6) AS loss FROM batches",
    "perplexity": f"""WITH {LOSSES} SELECT count(loss) AS n_batches, round(avg(loss), 6) AS mean_loss,
  round(avg(exp(loss)), 6) AS mean_of_exp, round(exp(avg(loss)), 6) AS exp_of_mean FROM batches""",
    "metric_epoch": f"""WITH {METRICS} SELECT run, epoch, name, count(*) AS n_steps, arg_max(value, step) AS last_value,
  round(sum(value * batch_rows) / sum(batch_rows), 6) AS mean_value FROM metrics GROUP BY run, epoch, name""",
    "every_n": f"WITH {METRICS} SELECT run, epoch, batch_idx, step, name, value FROM metrics WHERE (batch_idx + 1) % 5 = 0",
    "every_n_epoch_end": f"""WITH {METRICS} SELECT run, epoch, batch_idx, step, name, value FROM metrics
QUALIFY row_number() OVER (PARTITION BY run, epoch ORDER BY batch_idx DESC) = 1""",
    "early_stop": f"""WITH {CHECKS},
u AS (SELECT *, CASE WHEN isfinite(value) THEN value END AS ok FROM checks),
a AS (SELECT *, min(ok) OVER (PARTITION BY run, name ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best FROM u),
b AS (SELECT *, max(CASE WHEN ok IS NOT NULL AND (best IS NULL OR ok < best) THEN step END) OVER (PARTITION BY run, name ORDER BY step) AS hit FROM a),
s AS (SELECT run, name, count(*) AS n_checks,
  min(CASE WHEN step - coalesce(hit, -1) >= 3 OR (value IS NOT NULL AND ok IS NULL) THEN step END) AS stop_step FROM b GROUP BY run, name),
r AS (SELECT s.run, s.name, c.step, c.ok, row_number() OVER (PARTITION BY s.run, s.name ORDER BY c.ok, c.step) AS k
  FROM s JOIN u c ON s.run = c.run AND s.name = c.name AND c.step <= coalesce(s.stop_step, c.step) WHERE c.ok IS NOT NULL)
SELECT s.run, s.name, n_checks, stop_step, r.step AS best_step, r.ok AS best_value
FROM s LEFT JOIN r ON r.run = s.run AND r.name = s.name AND k = 1""",
    "best_checkpoints": f"""WITH {CHECKS} SELECT * FROM (SELECT run, name, step, value,
  row_number() OVER (PARTITION BY run, name ORDER BY value, step)::INT AS checkpoint_rank FROM checks WHERE isfinite(value)) WHERE checkpoint_rank <= 2""",
    "job_tally": """SELECT user_id, count(*) FILTER (event_type <> 'error') AS n_ok,
  count(*) FILTER (event_type = 'error') AS n_failed FROM events GROUP BY user_id""",
    "bigram_counts": f"""WITH {BIGRAMS} SELECT prev, next, n, context_n,
  round((n + 0.1::DOUBLE) / (context_n + 0.1::DOUBLE * v), 6) AS p FROM bigrams JOIN contexts USING (prev) CROSS JOIN size""",
    "bigram_eval": f"""WITH {SCORED} SELECT count(*) AS n_pairs, round(avg(loss), 6) AS loss,
  round(exp(avg(loss)), 4) AS perplexity FROM held""",
    "bigram_eval_docs": f"""WITH {SCORED} SELECT doc_id, count(*) AS n_pairs, round(avg(loss), 6) AS loss,
  round(exp(avg(loss)), 3) AS perplexity FROM held GROUP BY doc_id""",
    "next_token_topk": f"""WITH {BIGRAMS}, w AS (SELECT prev, next, n, pow(n / context_n::DOUBLE, 1 / 0.7::DOUBLE) AS w
  FROM bigrams JOIN contexts USING (prev)),
r AS (SELECT prev, next, n, round(w / sum(w) OVER (PARTITION BY prev), 6) AS p,
  row_number() OVER (PARTITION BY prev ORDER BY n DESC, next)::INT AS next_rank FROM w)
SELECT * FROM r WHERE next_rank <= 50""",
    "next_token_topp": f"""WITH {BIGRAMS}, c AS (SELECT prev, next, n,
  (sum(n) OVER (PARTITION BY prev ORDER BY n DESC, next ROWS UNBOUNDED PRECEDING) - n)::BIGINT AS before,
  (sum(n) OVER (PARTITION BY prev))::BIGINT AS total FROM bigrams)
SELECT prev, next, n, round(before / total::DOUBLE, 6) AS p_before FROM c WHERE before < 0.95::DOUBLE * total""",
    "next_token_greedy": f"""WITH {BIGRAMS},
best AS (SELECT prev, next FROM bigrams QUALIFY row_number() OVER (PARTITION BY prev ORDER BY n DESC, next) = 1),
asked AS (SELECT conv_id, turn, coalesce({WORDS}[-1], '') AS prev_token FROM conversations)
SELECT conv_id, turn, prev_token, best.next,
  CASE WHEN best.next IS NULL THEN NULL ELSE coalesce(nv.token, '<eos>') END AS next_token
FROM asked LEFT JOIN vocab pv ON pv.token = prev_token LEFT JOIN best ON best.prev = pv.id
LEFT JOIN vocab nv ON nv.id = best.next""",
    "repetition_penalty": """SELECT vec_id, pos, round(CASE WHEN pos % 3 <> 0 THEN s WHEN s < 0 THEN s * 1.2::DOUBLE ELSE s / 1.2::DOUBLE END, 6) AS score
FROM (SELECT vec_id, (generate_subscripts(embedding, 1) - 1)::INT AS pos, unnest(embedding)::DOUBLE AS s FROM embeddings)""",
    "map_batches": """SELECT doc_id, generate_subscripts(w, 1) - 1 AS line_no, length(unnest(w)) AS n_chars
FROM (SELECT doc_id, string_split(text, chr(10)) AS w FROM documents)""",
    "batch_predict": "SELECT doc_id, length(text) AS prediction FROM documents",
    "predict_safe": """SELECT doc_id, 0::BIGINT AS global_step, text AS prompt, CASE WHEN doc_id % 19 = 0
  THEN 'GENERATION FAILED: no output for ' || doc_id ELSE length(text) || ' characters' END AS generated_text FROM documents""",
}

EVAL_SQL["generation_log"] = f"""SELECT step AS global_step, prompt, generated_text
FROM ({EVAL_SQL['predict_safe']}), (VALUES (10::BIGINT), (20)) AS s(step)"""
EVAL_SQL["metric_log"] = f"""WITH {METRICS} SELECT run, step, name, value FROM metrics
UNION ALL SELECT run, (epoch + 1) * 20 - 1, name || '_epoch', round(sum(value * batch_rows) / sum(batch_rows), 6)
FROM metrics GROUP BY run, epoch, name"""

# slices of multi_slice, packed per (dataset, split) in batches of 100 rows
_SLICED = f"""{CORPORA}, ranked AS (SELECT *,
  row_number() OVER (PARTITION BY dataset, split ORDER BY key1, key2) - 1 AS r,
  count(*) OVER (PARTITION BY dataset, split) AS n FROM corpora),
sliced AS (SELECT * FROM ranked WHERE dataset <> 'pages' AND split <> 'test' AND (split <> 'train' OR CASE dataset
  WHEN 'documents' THEN r >= floor(n * 0.1::DOUBLE) AND r < floor(n * 0.2::DOUBLE)
  WHEN 'conversations' THEN r < floor(n * 0.5::DOUBLE) ELSE true END)),
ix AS (SELECT dataset, source_ord, split, list_concat({BYTES}, [256]) AS ids,
  row_number() OVER (PARTITION BY dataset, split ORDER BY key1, key2) - 1 AS idx FROM sliced),
toks AS (SELECT dataset, source_ord, split, idx, unnest(ids) AS id, generate_subscripts(ids, 1) AS p FROM ix),
pos AS (SELECT *, idx // 100 AS g, row_number() OVER (PARTITION BY dataset, split, idx // 100 ORDER BY idx, p) - 1 AS o FROM toks),
cut AS (SELECT dataset, source_ord, split, g, o // 128 AS b, string_agg(id::VARCHAR, ' ' ORDER BY o) AS input_ids
  FROM pos GROUP BY dataset, source_ord, split, g, o // 128 HAVING count(*) = 128),
blocks AS (SELECT *, row_number() OVER (PARTITION BY dataset, split ORDER BY g, b) - 1 AS block_id FROM cut),
together AS (SELECT *, row_number() OVER (PARTITION BY split ORDER BY source_ord, block_id) - 1 AS i,
  count(*) OVER (PARTITION BY split) AS n FROM blocks),
{_shuffled('together', 'i', 'n')},
slots AS (SELECT *, unnest(range(position, ((n + 1) // 2) * 2, n)) AS slot FROM drawn)"""

TOKEN_SQL["rank_export"] = f"""WITH RECURSIVE {_SLICED} SELECT split, slot, slot % 2 AS rank, (slot // 2) // 4 AS micro_batch,
  ((slot // 2) // 4) // 2 AS opt_step, dataset, block_id, input_ids FROM slots"""

TOKEN_SQL["rank_export_no_eos"] = TOKEN_SQL["rank_export"].replace(f"list_concat({BYTES}, [256])", BYTES)

EVAL_SQL["classify_docs"] = f"""WITH {DOCS},
y AS (SELECT docs.doc_id, split, quality, {WORDS} AS w FROM docs LEFT JOIN labels USING (doc_id)),
tr AS (SELECT * FROM y WHERE split = 'train' AND quality IS NOT NULL),
prior AS (SELECT ln(count(*) FILTER (quality = 0) / count(*)::DOUBLE) AS p0, ln(count(*) FILTER (quality = 1) / count(*)::DOUBLE) AS p1 FROM tr),
cnt AS (SELECT token, count(*) FILTER (quality = 0) AS n0, count(*) FILTER (quality = 1) AS n1
  FROM (SELECT quality, unnest(w) AS token FROM tr) GROUP BY token),
tot AS (SELECT count(*) AS v, sum(n0) AS t0, sum(n1) AS t1 FROM cnt),
ll AS (SELECT token, ln((n0 + 1) / (t0 + v)::DOUBLE) AS l0, ln((n1 + 1) / (t1 + v)::DOUBLE) AS l1 FROM cnt CROSS JOIN tot),
s AS (SELECT doc_id, sum(l0) AS s0, sum(l1) AS s1 FROM (SELECT doc_id, unnest(w) AS token FROM y) JOIN ll USING (token) GROUP BY doc_id)
SELECT y.doc_id, split, quality AS label, round(coalesce(s0, 0) + p0, 4) AS logit_0, round(coalesce(s1, 0) + p1, 4) AS logit_1,
  CASE WHEN coalesce(s1, 0) + p1 > coalesce(s0, 0) + p0 THEN 1 ELSE 0 END AS prediction FROM y LEFT JOIN s USING (doc_id) CROSS JOIN prior"""

ORACLE_SQL = {**CORPUS_SQL, **TOKEN_SQL, **EVAL_SQL}
