"""Packing by minimum bin slack.

A document is its token ids and an end mark.  Whole windows of it become
sequences of their own; what remains of it joins a pool of remainders.  To fill
a window, the longest remainder is its anchor and a subset-sum dynamic programme
over the counts of remaining lengths, kept as a bitset of reachable sums, picks
the multiset that comes closest to capacity; walking back through the recorded
bitsets gives how many of each length it takes.  The multiset is used for as many
windows as the counts allow.  If it leaves slack, one more remainder is cut to
fill it.  The last window of a task, for which no remainder is left, is cut at
the binary digits of its length, since sequences of such lengths are not padded.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm import bpe
from corpusloom.llm.common import small_batches

WIDTH = 4               # bytes of an id
SCHEMA = "doc_id bigint, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids binary"


@dataclass(frozen=True)
class Packing:
    """Production parameters.  `pool_tokens` bounds a task's memory: 4 bytes each, and one document."""

    path: str
    capacity: int = 2048
    end_id: int = 1
    pool_tokens: int = 1 << 21


@dataclass(slots=True)
class Piece:
    doc_id: int | None
    start: int
    doc_tokens: int
    ids: bytes

    def cut(self, tokens: int) -> tuple[Piece, Piece]:
        at = tokens * WIDTH
        return (
            Piece(self.doc_id, self.start, self.doc_tokens, self.ids[:at]),
            Piece(self.doc_id, self.start + tokens, self.doc_tokens, self.ids[at:]),
        )


def closest_fill(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """The multiset of lengths, drawn from `counts`, with the largest sum up to `capacity`.

    Bit s of `reach` says that sum s can be made.  A length with count c enters as
    bundles of 1, 2, 4, ... copies, so each bitset step is a shift; the bitset before
    each step is kept for the way back.
    """
    window = (1 << (capacity + 1)) - 1
    reach, steps = 1, []
    for length in sorted((n for n in counts if n <= capacity and counts[n]), reverse=True):
        left, bundle = min(counts[length], capacity // length), 1
        while left and not reach >> capacity:
            bundle = min(bundle, left)
            steps.append((reach, length, bundle))
            reach |= (reach << length * bundle) & window
            left -= bundle
            bundle *= 2
        if reach >> capacity:
            break
    total, picked = reach.bit_length() - 1, defaultdict(int)
    for before, length, bundle in reversed(steps):
        if not before >> total & 1:
            total -= length * bundle
            picked[length] += bundle
    return dict(picked)


class Pool:
    """Remainders by length, and the windows made of them."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.by_length: dict[int, list[Piece]] = defaultdict(list)
        self.tokens = 0

    def add(self, piece: Piece) -> None:
        n = len(piece.ids) // WIDTH
        self.by_length[n].append(piece)
        self.tokens += n

    def _take(self, length: int) -> Piece:
        pieces = self.by_length[length]
        piece = pieces.pop()
        if not pieces:
            del self.by_length[length]
        self.tokens -= length
        return piece

    def full_windows(self, floor: int) -> Iterator[list[Piece]]:
        """Windows that hold exactly `capacity` tokens, while more than `floor` tokens are pooled."""
        while self.tokens > max(floor, self.capacity - 1):
            counts = {n: len(pieces) for n, pieces in self.by_length.items()}
            anchor = max(counts)
            counts[anchor] -= 1
            picked = closest_fill(counts, self.capacity - anchor)
            counts[anchor] += 1
            picked[anchor] = picked.get(anchor, 0) + 1
            slack = self.capacity - sum(n * k for n, k in picked.items())
            if slack:
                window = [self._take(n) for n, k in picked.items() for _ in range(k)]
                # every remainder still pooled is longer than the slack, or it would have been picked
                front, back = self._take(min(self.by_length)).cut(slack)
                self.add(back)
                yield [*window, front]
            else:
                for _ in range(min(counts[n] // k for n, k in picked.items())):
                    yield [self._take(n) for n, k in picked.items() for _ in range(k)]

    def last_windows(self) -> Iterator[list[Piece]]:
        """What is left, under one window, cut at the binary digits of its length."""
        rest = [self._take(n) for n in sorted(self.by_length, reverse=True) for _ in range(len(self.by_length[n]))]
        left = sum(len(p.ids) for p in rest) // WIDTH
        while left:
            size = room = 1 << (left.bit_length() - 1)
            window = []
            while room:
                piece = rest.pop()
                n = len(piece.ids) // WIDTH
                if n > room:
                    piece, back = piece.cut(room)
                    rest.append(back)
                    n = room
                window.append(piece)
                room -= n
            left -= size
            yield window


def windows(docs: Iterable[tuple[int | None, bytes]], packing: Packing) -> Iterator[list[Piece]]:
    """Sequences of one task from (doc_id, ids of the document with its end mark)."""
    pool, full = Pool(packing.capacity), packing.capacity * WIDTH
    for doc_id, ids in docs:
        n = len(ids) // WIDTH
        whole = len(ids) - len(ids) % full
        for at in range(0, whole, full):
            yield [Piece(doc_id, at // WIDTH, n, ids[at : at + full])]
        if whole < len(ids):
            pool.add(Piece(doc_id, whole // WIDTH, n, ids[whole:]))
        if pool.tokens > packing.pool_tokens:
            yield from pool.full_windows(packing.pool_tokens // 2)
    yield from pool.full_windows(0)
    yield from pool.last_windows()


def pack(docs: DataFrame, packing: Packing, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece (SCHEMA), `ids` little-endian unsigned 32-bit.

    Each id of every document is in exactly one piece; a sequence's pieces lie
    gapless from offset 0.  Every sequence holds `capacity` ids or a power of two, so
    none is padded.  Null text is an empty document: its end mark alone.  Repeated
    rows and ids are documents of their own, a null id stays null, other columns are
    not used, an empty table gives no rows.  A task packs the rows it reads, in
    order, without a shuffle; sequence ids are unique over tasks, and a task that is
    run again makes the same rows.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = bpe.encoder(packing.path), packing.end_id.to_bytes(WIDTH, "little")

        def encoded() -> Iterator[tuple[int | None, bytes]]:
            for batch in small_batches(batches):
                texts = pc.cast(batch.column(1), pa.binary())
                for key, raw in zip(batch.column(0).to_pylist(), texts):
                    yield key, encoder.encode(raw.as_py() or b"") + end

        first = TaskContext.get().partitionId() << 33
        columns: list[list] = [[] for _ in range(7)]
        held = 0
        for number, window in enumerate(windows(encoded(), packing)):
            offset = 0
            for piece in window:
                n = len(piece.ids) // WIDTH
                row = (piece.doc_id, piece.start, n, piece.doc_tokens, first + number, offset, piece.ids)
                for column, value in zip(columns, row):
                    column.append(value)
                offset += n
            held += offset
            if held > packing.pool_tokens // 2:
                yield _batch(columns)
                columns, held = [[] for _ in range(7)], 0
        if held:
            yield _batch(columns)

    return docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, SCHEMA)


def _batch(columns: list[list]) -> pa.RecordBatch:
    arrays = [pa.array(c, pa.int64()) for c in columns[:-1]] + [pa.array(columns[-1], pa.binary())]
    return pa.RecordBatch.from_arrays(arrays, names=[x.split()[0] for x in SCHEMA.split(", ")])
