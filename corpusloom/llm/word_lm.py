"""Cross-entropy difference of a target and a background word bigram model.

A word is a run without ASCII white space, A-Z lowered; a text is its words between
two edges, and the closing edge is its end token.  Every word of every document
counts, there is no vocabulary of most frequent ones, and both models share all of
them.  The background is counted over all documents, the target over all that are
labelled good.  The models are matched: same order, same smoothing, and the
background's counts are scaled to the target's total.  A token's loss difference is
its loss under the target minus that under the background; a document's score is the
mean over its tokens, below zero when it reads more like the target.  A document is
scored by models that have counted it too.

What is counted grows with the corpus and never reaches the driver.  Documents are
dealt to chunks of bounded bytes, keys to ranges of bounded number.  A chunk sends each
of its distinct words and bigrams once, with its own counts, to the key's range: one
row per range, the sorted keys as differences.  The range adds them up and answers each
row by position, without the keys, since the chunk makes its sorted keys again.  So a
key is sent at most once per chunk, however frequent it is, and none can dominate a
task.  The texts are shuffled once: both passes over the chunks read the same exchange.
Keys are 64-bit hashes: among 10^10 of them about three pairs share one.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import blank, small_batches

CHUNK_BYTES = 12 << 20      # of text; a larger chunk sends a key less often, but takes more memory
RANGE_TOKENS = 1 << 21      # whose keys a range sums
LEAST_BYTES, LEAST_TOKENS = 1 << 20, 1 << 16    # no smaller chunks and ranges than these to keep all shuffle partitions busy
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


@dataclass(frozen=True)
class Smoothing:
    """Weight of the shorter context in every longer one, in tokens."""

    bigram: float = 4.0
    unigram: float = 1.0


@dataclass(frozen=True)
class Totals:
    """Sums over the whole corpus: tokens of both models, distinct words with the edge, and bytes of text."""

    background: int
    target: int
    words: int
    size: int


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _M1
    x = (x ^ (x >> np.uint64(29))) * _M2
    return x ^ (x >> np.uint64(32))


@dataclass
class Chunk:
    """Texts as local numbers: `word` and `pair` index the distinct words (0 is the edge) and bigrams of each token."""

    counts: np.ndarray          # tokens of each text: its words and the end
    word: np.ndarray
    pair: np.ndarray
    word_keys: np.ndarray
    pair_keys: np.ndarray
    before: np.ndarray          # first word of each distinct bigram
    after: np.ndarray


def chunk_of(texts: list[bytes]) -> Chunk:
    number: defaultdict[bytes, int] = defaultdict(count().__next__)
    number[b""]                                             # the edge
    counts, parts = np.zeros(len(texts), np.int64), []
    for i, raw in enumerate(texts):
        words = raw.lower().split()
        counts[i] = len(words) + 1
        parts += [np.fromiter(map(number.__getitem__, words), np.int32, len(words)), np.zeros(1, np.int32)]
    word = np.concatenate(parts)
    del parts
    m = len(number)
    codes = word.astype(np.int64)
    codes[1:] += m * codes[:-1]                             # the end of a text is the edge before the next one
    pairs, pair = np.unique(codes, return_inverse=True)
    pair = pair.astype(np.int32)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, number), np.uint64, m)
    before, after = pairs // m, pairs % m
    return Chunk(counts, word, pair, _mix(hashes), _mix(hashes[before] * _M2 + _mix(hashes[after] + _M1)), before, after)


def _bytes(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    return [x.as_py() for x in pc.cast(column, pa.binary())]


def corpus_totals(rows: DataFrame, ids: DataFrame) -> Totals:
    """Totals of (doc_id, text) rows and the target's distinct ids; each task names each of its words once."""

    def lengths_and_words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            texts, words, n = _bytes(batch.column(1)), {b""}, []
            for raw in texts:
                own = raw.lower().split()
                n.append(len(own) + 1)
                words.update(own)
            found = _mix(np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))).view(np.int64)
            none = np.zeros(len(words), np.int64)
            for is_word, key, tokens, size in ((False, batch.column(0), n, [*map(len, texts)]), (True, found, none, none)):
                yield pa.RecordBatch.from_pydict({
                    "is_word": pa.array(np.full(len(tokens), is_word)), "key": key, "n": pa.array(tokens, pa.int64()), "size": pa.array(size, pa.int64()),
                })

    parts = rows.select("doc_id", "text").mapInArrow(lengths_and_words, "is_word boolean, key bigint, n bigint, size bigint")
    keys = parts.groupBy("is_word", "key").agg(F.sum("n").alias("n"), F.sum("size").alias("size"))
    good = ids.select(F.lit(False).alias("is_word"), F.col("doc_id").alias("key"), F.lit(True).alias("good"))
    found = keys.join(good, ["is_word", "key"], "left").agg(F.sum("n"), F.sum(F.when(F.col("good"), F.col("n"))), F.count_if("is_word"), F.sum("size"))
    return Totals(*(int(x or 0) for x in found.head()))


def _place(doc_id: Column, text: Column | None, chunks: int) -> Column:
    """The chunk of a row: by its id, by its text where it has none."""
    code = F.xxhash64(doc_id) if text is None else F.when(doc_id.isNull(), F.xxhash64(text)).otherwise(F.xxhash64(doc_id))
    return F.pmod(code, F.lit(chunks)).cast("int").alias("chunk")


def _parts(amount: int, most: int, least: int, wanted: int) -> int:
    """How many parts of at most `most` on average; up to `wanted` while they are not below `least`."""
    return max(1, -(-amount // most), min(wanted, -(-amount // least)))


def packed(*columns: np.ndarray) -> bytes:
    """Whole numbers from 0 in columns of equal length, by byte planes: of each column as many as its largest number needs."""
    widths = [max(1, -(-int(c.max(initial=0)).bit_length() // 8)) for c in columns]
    planes = (c.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :w].T.tobytes() for c, w in zip(columns, widths, strict=True))
    return bytes(widths) + pa.compress(b"".join(planes), codec="zstd", asbytes=True)


def unpacked(raw: bytes, size: int, columns: int) -> list[np.ndarray]:
    """The `columns` columns of `size` numbers each that `packed` was given."""
    widths = list(raw[:columns])
    flat = np.frombuffer(pa.decompress(raw[columns:], size * sum(widths), codec="zstd"), np.uint8)
    found = []
    for part, w in zip(np.split(flat, np.cumsum(widths)[:-1] * size), widths, strict=True):
        whole = np.zeros((size, 8), np.uint8)
        whole[:, :w] = part.reshape(w, size).T
        found.append(whole.view("<u8").ravel())
    return found


def _dealt(keys: np.ndarray, ranges: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order of the keys, the ranges that have some, and the bounds of these in that order."""
    order = np.argsort(keys, kind="stable")
    of = (keys[order] >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)
    begin = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
    return order, of[begin].astype(np.int32), np.append(begin, len(keys))


def _sent(rows: DataFrame, ids: DataFrame, ranges: int) -> DataFrame:
    """(chunk, range, size, packed): of every chunk and range that meet, differences of sorted keys and the chunk's counts in both models.

    `rows` is (doc_id, text, chunk), `ids` the target's (doc_id, chunk).
    """

    def count_keys(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return pa.table({"chunk": pa.array([], pa.int32()), "range": pa.array([], pa.int32()), "size": pa.array([], pa.int64()),
                             "packed": pa.array([], pa.binary())})
        made = chunk_of(_bytes(left.column("text")))
        good = np.array(pc.is_in(left.column("doc_id"), value_set=right.column("doc_id").combine_chunks()).to_pylist(), bool)
        token = np.repeat(good, made.counts)
        both = ((made.word, len(made.word_keys)), (made.pair, len(made.pair_keys)))
        keys = np.concatenate([made.word_keys, made.pair_keys])
        n = np.concatenate([np.bincount(where, minlength=size) for where, size in both])
        n_target = np.concatenate([np.bincount(where[token], minlength=size) for where, size in both])
        order, numbers, bounds = _dealt(keys, ranges)
        keys, n, n_target = keys[order], n[order], n_target[order]
        spans = [slice(*x) for x in zip(bounds[:-1], bounds[1:], strict=True)]
        return pa.table({
            "chunk": pa.array(np.full(len(spans), left.column("chunk")[0].as_py(), np.int32)), "range": numbers, "size": np.diff(bounds).astype(np.int64),
            "packed": pa.array([packed(np.diff(keys[x], prepend=np.uint64(0)), n[x], n_target[x]) for x in spans], pa.binary()),
        })

    return rows.groupBy("chunk").cogroup(ids.groupBy("chunk")).applyInArrow(count_keys, "chunk int, range int, size bigint, packed binary")


def _summed(group: pa.Table) -> tuple[np.ndarray, ...]:
    """Of all keys that a range was sent, chunk by chunk: the key, the chunk's counts in both models, the corpus's, and whether the key is the first such."""
    parts = [unpacked(raw.as_py(), size, 3) for raw, size in zip(group.column("packed"), group.column("size").to_pylist(), strict=True)]
    keys = np.concatenate([np.cumsum(p[0]) for p in parts])
    own = [np.concatenate([p[i] for p in parts]).astype(np.int64) for i in (1, 2)]
    _, index, at = np.unique(keys, return_index=True, return_inverse=True)
    first = np.zeros(len(keys), bool)
    first[index] = True
    return keys, *own, *(np.bincount(at, n).astype(np.int64)[at] for n in own), first


def counted(rows: DataFrame, ids: DataFrame, ranges: int = 1) -> DataFrame:
    """(chunk, key, background, target, first): the corpus's count of every key, once for each chunk that has it.

    `rows` is (doc_id, text, chunk), `ids` the target's (doc_id, chunk).  `first` marks one
    row of each key, so those rows are the model's table.
    """

    def table(group: pa.Table) -> pa.Table:
        keys, _, _, background, target, first = _summed(group)
        chunk = np.repeat(group.column("chunk").to_numpy(), group.column("size").to_numpy())
        return pa.table({"chunk": chunk, "key": keys.view(np.int64), "background": background, "target": target, "first": pa.array(first)})

    schema = "chunk int, key bigint, background bigint, target bigint, first boolean"
    return _sent(rows, ids, ranges).groupBy("range").applyInArrow(table, schema)


def _answers(sent: DataFrame) -> DataFrame:
    """(chunk, range, size, packed): for every row sent, by its order of keys, the background count of all other chunks and the target's count."""

    def answer(group: pa.Table) -> pa.Table:
        _, n, _, background, target, _ = _summed(group)
        bounds = np.cumsum(group.column("size").to_numpy())[:-1]
        packs = [packed(*x) for x in zip(np.split(background - n, bounds), np.split(target, bounds), strict=True)]
        return pa.table({"chunk": group.column("chunk"), "range": group.column("range"), "size": group.column("size"), "packed": pa.array(packs, pa.binary())})

    return sent.groupBy("range").applyInArrow(answer, "chunk int, range int, size bigint, packed binary")


def _losses(made: Chunk, sums: np.ndarray, total: float, scale: float, words: int, s: Smoothing) -> np.ndarray:
    """Log probability of each distinct bigram of a chunk, with counts `sums` of its words and bigrams in turn."""
    one, two = np.split(sums * scale, [len(made.word_keys)])
    p1 = (one + s.unigram / words) / (total + s.unigram)
    return np.log(two + s.bigram * p1[made.after]) - np.log(one[made.before] + s.bigram)


def _unscored(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches):
        n = np.array([len(raw.lower().split()) + 1 for raw in _bytes(batch.column(1))], np.int64)
        nothing = pa.nulls(len(n), pa.float64())
        yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "n_tokens": n, "difference": nothing, "score": nothing})


def score(docs: DataFrame, good: DataFrame, smoothing: Smoothing = Smoothing(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, difference, score) for every row of `docs`; `good` lists the target's ids in `doc_id`.

    `n_tokens` is the number of words and the end token; `difference` the summed loss
    difference in nats, `score` its mean, both null where no document is of the target.
    Null texts are empty, repeated rows all count and score alike, null and repeated ids
    in `good` do nothing more, an empty table gives no rows.  Rows that share an id are
    in one chunk.
    """
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), blank(text).alias("text"))
    ids = good.select(F.col("doc_id").cast("bigint").alias("doc_id")).where("doc_id IS NOT NULL").distinct()
    schema = "doc_id bigint, n_tokens bigint, difference double, score double"
    totals = corpus_totals(rows, ids)
    if not totals.target:
        return rows.mapInArrow(_unscored, schema)
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = _parts(totals.size, CHUNK_BYTES, LEAST_BYTES, least)
    ranges = _parts(totals.background, RANGE_TOKENS, LEAST_TOKENS, least)

    def judge(left: pa.Table, right: pa.Table) -> pa.Table:
        made = chunk_of(_bytes(left.column("text")))
        right = right.sort_by("range")
        answers = [unpacked(raw.as_py(), size, 2) for raw, size in zip(right.column("packed"), right.column("size").to_pylist(), strict=True)]
        order = _dealt(np.concatenate([made.word_keys, made.pair_keys]), ranges)[0]
        background = np.concatenate([np.bincount(made.word, minlength=len(made.word_keys)), np.bincount(made.pair)])
        target = np.zeros_like(background)
        background[order] += np.concatenate([others for others, _ in answers]).astype(np.int64)
        target[order] = np.concatenate([n for _, n in answers])
        scale = totals.target / totals.background
        apart = _losses(made, background, totals.target, scale, totals.words, smoothing)
        apart = apart - _losses(made, target, totals.target, 1.0, totals.words, smoothing)
        difference = np.add.reduceat(apart[made.pair], np.cumsum(made.counts) - made.counts)
        return pa.table({"doc_id": left.column("doc_id"), "n_tokens": made.counts, "difference": difference, "score": difference / made.counts})

    rows = rows.withColumn("chunk", _place(F.col("doc_id"), F.col("text"), chunks))
    sent = _sent(rows, ids.withColumn("chunk", _place(F.col("doc_id"), None, chunks)), ranges)
    return rows.groupBy("chunk").cogroup(_answers(sent).groupBy("chunk")).applyInArrow(judge, schema)
