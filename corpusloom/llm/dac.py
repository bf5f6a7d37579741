"""Token ids in directly addressable codes.

An id is cut into chunks of eight bits, least significant first.  Level l holds
the l-th chunk of every id that has one, in order, and a bitmap that says which of
these ids continue on the next level.  A rank directory keeps the number of set
bits before every 512-bit block, so the place of an id's next chunk is a lookup and
a short popcount: any token is read with one probe per level, and no block is
decoded.  Frequent tokens have small ids and take one level.

A segment is one such file: header, document directory, levels.  Segments are the
rows of a Parquet table, so Spark's committer publishes them as a whole and a lost
executor leaves nothing behind.

Layout of a segment, all numbers little-endian:
    magic "DAC1", tokens u64, documents u64, levels u32
    document ids i64 each, id-is-null flags u8 each, first token of each document u64 and the token count u64
    per level: entries u64, chunks u8 each, bitmap bytes (bit i of byte b is entry 8b+i), ranks u64 per 512 entries
"""

from __future__ import annotations

import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.llm import bpe
from corpusloom.llm.common import small_batches

MAGIC = b"DAC1"         # fixed value of the format
HEAD = "<4sQQI"
BLOCK = 512
PROBE_LISTS = 16        # lists that the positions asked of one segment are dealt to
SEGMENT_TOKENS = 1 << 20
SEGMENT_SCHEMA = "part int, seq int, n_docs bigint, n_tokens bigint, first_doc bigint, last_doc bigint, payload binary"


def encode_segment(doc_ids: list[int | None], counts: list[int], ids: np.ndarray) -> bytes:
    """The bytes of a segment of documents with `counts` ids each."""
    starts = np.zeros(len(counts) + 1, "<u8")
    starts[1:] = np.cumsum(np.asarray(counts, "u8"))
    parts = [
        np.array([0 if x is None else x for x in doc_ids], "<i8").tobytes(),
        np.array([x is None for x in doc_ids], "u1").tobytes(),
        starts.tobytes(),
    ]
    levels, rest = 0, ids.astype("<u4")
    while levels == 0 or len(rest):
        more = rest > 0xFF
        bitmap = np.packbits(more, bitorder="little")
        sums = np.add.reduceat(more, np.arange(0, len(more), BLOCK), dtype="u8") if len(more) else np.zeros(0, "u8")
        ranks = np.concatenate([np.zeros(1, "u8"), np.cumsum(sums)])[: len(sums)].astype("<u8")
        parts += [struct.pack("<Q", len(rest)), (rest & 0xFF).astype("u1").tobytes(), bitmap.tobytes(), ranks.tobytes()]
        rest, levels = rest[more] >> 8, levels + 1
    return b"".join([struct.pack(HEAD, MAGIC, len(ids), len(doc_ids), levels), *parts])


class Segment:
    """Random access into the bytes of a segment; nothing is decoded until it is asked for."""

    def __init__(self, payload: bytes):
        magic, self.n_tokens, n_docs, n_levels = struct.unpack_from(HEAD, payload)
        if magic != MAGIC:
            raise ValueError("not a segment of directly addressable codes")
        at = struct.calcsize(HEAD)

        def array(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(payload, kind, n, at)
            at += out.nbytes
            return out

        ids, null = array("<i8", n_docs), array("u1", n_docs)
        self.doc_ids = [None if gone else int(x) for x, gone in zip(ids, null)]
        self.starts = array("<u8", n_docs + 1).astype(np.int64)
        self.levels = []
        for _ in range(n_levels):
            n = int(array("<Q", 1)[0])
            self.levels.append((array("u1", n), array("u1", -(-n // 8)), array("<u8", -(-n // BLOCK))))

    def _continued(self, level: int, at: np.ndarray) -> np.ndarray:
        return (self.levels[level][1][at >> 3] >> (at & 7).astype("u1")) & 1 == 1

    def _rank(self, level: int, at: np.ndarray) -> np.ndarray:
        """Set bits of the level's bitmap before each position: directory, whole bytes of the block, rest of a byte."""
        _, bitmap, ranks = self.levels[level]
        block = at // BLOCK
        width = BLOCK // 8
        near = (block * width)[:, None] + np.arange(width)
        inside = near < (at >> 3)[:, None]
        whole = np.where(inside, np.bitwise_count(bitmap[np.minimum(near, len(bitmap) - 1)]), 0).sum(1, dtype=np.int64)
        part = np.bitwise_count(bitmap[at >> 3] & ((1 << (at & 7)) - 1).astype("u1"))
        return ranks[block].astype(np.int64) + whole + part

    def tokens_at(self, positions: Iterable[int]) -> np.ndarray:
        """Ids at any positions of the segment, in the order asked."""
        at = np.asarray(list(positions), np.int64)
        if len(at) and (at.min() < 0 or at.max() >= self.n_tokens):
            raise IndexError("position outside the segment")
        out, live = np.zeros(len(at), np.uint32), np.arange(len(at))
        for level, (chunks, _, _) in enumerate(self.levels):
            out[live] |= chunks[at].astype(np.uint32) << np.uint32(8 * level)
            on = self._continued(level, at)
            live, at = live[on], at[on]
            if not len(at):
                break
            at = self._rank(level, at)
        return out

    def ranges(self, cuts: np.ndarray) -> Iterator[np.ndarray]:
        """Ids between neighbouring `cuts`, ascending positions: each range is read by the ranks of its two ends.

        On every level a range is where the ranks of its ends on the level above say; no range needs another.
        """
        places = [np.asarray(cuts, np.int64)]
        for level, (chunks, _, _) in enumerate(self.levels[:-1]):
            inside = places[-1] < len(chunks)
            below = np.full(len(places[-1]), len(self.levels[level + 1][0]), np.int64)
            below[inside] = self._rank(level, places[-1][inside])
            places.append(below)
        more = [np.unpackbits(bitmap, count=len(chunks), bitorder="little").astype(bool) for chunks, bitmap, _ in self.levels]
        for i in range(len(places[0]) - 1):
            out = np.zeros(0, np.uint32)
            for (chunks, _, _), bits, at in zip(reversed(self.levels), reversed(more), reversed(places)):
                here = chunks[at[i] : at[i + 1]].astype(np.uint32)
                here[bits[at[i] : at[i + 1]]] |= out << np.uint32(8)
                out = here
            yield out

    def all_tokens(self) -> np.ndarray:
        """Every id, level by level without ranks: the k-th set bit continues at entry k."""
        out = np.zeros(0, np.uint32)
        for chunks, bitmap, _ in reversed(self.levels):
            more = np.unpackbits(bitmap, count=len(chunks), bitorder="little").astype(bool)
            here = chunks.astype(np.uint32)
            here[more] |= out << np.uint32(8)
            out = here
        return out


def encode(docs: DataFrame, path: str, end_id: int = 2, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Segments (SEGMENT_SCHEMA) of all documents in ascending id order; (part, seq) is their order.

    Null text counts as empty, so every document has at least its end id.  A null id
    sorts first, rows that repeat an id follow each other in order of their text, other
    columns are not used, an empty table gives no segment.  Texts are range-partitioned
    by id once and encoded where they land.  A segment closes at the first document end
    after SEGMENT_TOKENS ids, so it is bounded by that and one document.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = bpe.encoder(path), end_id.to_bytes(4, "little")
        part, seq = TaskContext.get().partitionId(), 0
        keys, counts, pieces, held = [], [], [], 0
        for batch in small_batches(batches):
            texts = pc.cast(batch.column(1), pa.binary())
            for key, raw in zip(batch.column(0).to_pylist(), texts):
                ids = encoder.encode(raw.as_py() or b"") + end
                keys.append(key)
                counts.append(len(ids) // 4)
                pieces.append(ids)
                held += counts[-1]
                if held >= SEGMENT_TOKENS:
                    yield _segment(part, seq, keys, counts, pieces)
                    seq, keys, counts, pieces, held = seq + 1, [], [], [], 0
        if keys:
            yield _segment(part, seq, keys, counts, pieces)

    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    placed = rows.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", "text")
    return placed.mapInArrow(run, SEGMENT_SCHEMA)


def _segment(part: int, seq: int, keys: list, counts: list[int], pieces: list[bytes]) -> pa.RecordBatch:
    payload = encode_segment(keys, counts, np.frombuffer(b"".join(pieces), "<u4"))
    row = {"part": part, "seq": seq, "n_docs": len(keys), "n_tokens": sum(counts), "first_doc": keys[0], "last_doc": keys[-1], "payload": payload}
    kinds = [pa.int32(), pa.int32(), *[pa.int64()] * 4, pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row.values(), kinds)], names=list(row))


def write(docs: DataFrame, folder: str, path: str, **options) -> None:
    """Write the segments of `docs` to `folder`."""
    encode(docs, path, **options).write.parquet(folder)


def segment_starts(segments: DataFrame) -> DataFrame:
    """(part, seq, seg_start): ids before each segment.

    Parts get their running total from a table with one row per part, segments theirs
    inside their part.
    """
    sizes = segments.select("part", "seq", "n_tokens")
    before = lambda w: F.sum("n_tokens").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n_tokens")
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("n_tokens"))
    above = parts.select("part", before(Window.orderBy("part")).alias("above"))
    inner = sizes.select("part", "seq", before(Window.partitionBy("part").orderBy("seq")).alias("inner"))
    return inner.join(above, "part").select("part", "seq", (F.col("above") + F.col("inner")).alias("seg_start"))


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """(part, seq, doc_id, local, n_tokens, ids) of every document in the segments of `folder`.

    `local` is the document's first token inside its segment, `ids` are little-endian
    u32.  Each document is addressed by the rank directories, in the task that reads its segment.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, seq, payload in zip(*batch.columns):
                segment = Segment(payload.as_py())
                starts = segment.starts
                n = len(starts) - 1
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part.as_py()] * n, pa.int32()),
                        pa.array([seq.as_py()] * n, pa.int32()),
                        pa.array(segment.doc_ids, pa.int64()),
                        pa.array(starts[:-1]),
                        pa.array(np.diff(starts)),
                        pa.array([ids.astype("<u4").tobytes() for ids in segment.ranges(starts)], pa.binary()),
                    ],
                    names=["part", "seq", "doc_id", "local", "n_tokens", "ids"],
                )

    schema = "part int, seq int, doc_id bigint, local bigint, n_tokens bigint, ids binary"
    return spark.read.parquet(folder).select("part", "seq", "payload").mapInArrow(run, schema)


def with_start(documents: DataFrame, folder: str) -> DataFrame:
    """Replace (part, seq, local) by `start`, the ids of all documents before."""
    starts = segment_starts(documents.sparkSession.read.parquet(folder))
    return documents.join(starts, ["part", "seq"]).withColumn("start", F.col("seg_start") + F.col("local")).drop("part", "seq", "seg_start", "local")


def read_tokens(spark: SparkSession, folder: str, positions: DataFrame, position: str = "position") -> DataFrame:
    """(position, token) for any global positions: one random access each, whole segments are not decoded.

    A position meets its segment by range: starts are spread over cells of
    SEGMENT_TOKENS ids, and a position looks in its own cell.  Positions outside the
    stored range, and nulls, give no row.
    """
    segments = spark.read.parquet(folder)
    spans = segment_starts(segments).join(segments.select("part", "seq", "n_tokens"), ["part", "seq"])
    last = F.col("seg_start") + F.col("n_tokens") - 1
    cells = F.sequence(F.floor(F.col("seg_start") / SEGMENT_TOKENS), F.floor(last / SEGMENT_TOKENS))
    spread = spans.select("part", "seq", "seg_start", last.alias("seg_last"), F.explode(cells).alias("cell"))
    asked = positions.select(F.col(position).cast("bigint").alias("position")).withColumn("cell", F.floor(F.col("position") / SEGMENT_TOKENS))
    found = asked.join(spread, "cell").where(F.col("position").between(F.col("seg_start"), F.col("seg_last")))
    probes = found.select("part", "seq", "position", (F.col("position") - F.col("seg_start")).alias("local"))
    # the positions of a segment travel together, in lists of bounded length, and meet its payload once per list
    lists = probes.withColumn("batch", F.pmod(F.xxhash64("position"), F.lit(PROBE_LISTS))).groupBy("part", "seq", "batch")
    lists = lists.agg(F.collect_list(F.struct("position", "local")).alias("probes"))
    with_payload = segments.select("part", "seq", "payload").join(lists, ["part", "seq"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            for payload, asked in zip(*batch.columns):
                position, local = asked.values.flatten()
                tokens = Segment(payload.as_py()).tokens_at(local.to_numpy())
                yield pa.RecordBatch.from_arrays([position, pa.array(tokens, pa.int64())], names=["position", "token"])

    return with_payload.select("payload", "probes").mapInArrow(run, "position bigint, token bigint")
