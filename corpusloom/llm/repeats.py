"""Repeated byte strings by the common-prefix interval trees of anchored suffix arrays.

Every window of `least` bytes has an anchor: of the `gram`-byte strings in it the one with the smallest hash, the first
of equal ones.  It depends on the window's bytes only, so equal windows have equal anchors at equal places.
Neighbouring windows mostly share an anchor; what they span together is a segment, and all windows that can equal
one of its own lie in segments of the same anchor string.  That string is the key by which segments meet.

In a key's group the suffixes that begin at the anchor are sorted and their common prefixes are scanned with a
stack into the tree of prefix intervals: each is a set of suffixes with a common prefix that no larger set has.
For every interval the bytes left of the anchors are compared: the set falls into subsets that agree up to some
byte and differ beyond it.  A subset that also lies in more than one child of the interval can be extended neither
way, so it is a maximal repeat, and the subset is all of its occurrences, however far apart in the order.  Repeats are
seen as far as their segments go; longer ones are reported once per anchor and united afterwards.

Equal texts, and equal segments, are one row with a count before anything of them moves.  A key whose segments have too
many different contexts for one task is opened: its windows are placed one by one, by their own hashes.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import cache
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import blank, small_batches
from corpusloom.session import bucketed, materialize

BLOCK = 1 << 19         # bytes whose windows are hashed at once
_SPOT = np.uint64((1 << 20) - 1)
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
TEXT = ["t1", "t2"]     # 128-bit identity of a text
SEGMENT = ["key", "seg"]


@dataclass(frozen=True)
class Repeats:
    """Parameters: the least length of a repeat, the bytes of an anchor string, and how many different segments of a key one task compares."""

    least: int = 200
    gram: int = 32
    together: int = 1 << 16     # 20 MB

    def __post_init__(self) -> None:
        if not 0 < self.gram <= self.least <= BLOCK:
            raise ValueError("an anchor string lies in a window, and a window in a block")


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _M1
    x = (x ^ (x >> np.uint64(29))) * _M2
    return x ^ (x >> np.uint64(32))


@cache
def _powers() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A code per byte value, and the powers of an odd base and of its inverse modulo 2^64."""
    base = 0xD6E8FEB86659FD93
    size = 2 * BLOCK + 1
    up, down = np.full(size, base, np.uint64), np.full(size, pow(base, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return _mix(np.arange(1, 257, dtype=np.uint64)), np.cumprod(up), np.cumprod(down)


class Hashes:
    """Hashes of all substrings of a buffer, by prefix sums of a polynomial modulo 2^64."""

    def __init__(self, buffer: np.ndarray):
        codes, up, self._down = _powers()
        self._sums = np.zeros(len(buffer) + 1, np.uint64)
        np.cumsum(codes[buffer] * up[: len(buffer)], out=self._sums[1:])

    def of(self, at: np.ndarray, size: np.ndarray | int) -> np.ndarray:
        return _mix((self._sums[at + size] - self._sums[at]) * self._down[at] + np.uint64(1))

    def every(self, size: int) -> np.ndarray:
        n = len(self._sums) - size
        return _mix((self._sums[size:] - self._sums[:n]) * self._down[:n])


def _least_of_each(values: np.ndarray, span: int) -> np.ndarray:
    """Minimum of every `span` consecutive values."""
    width = 1
    while 2 * width <= span:
        values = np.minimum(values[:-width], values[width:])
        width *= 2
    rest = span - width
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


@dataclass
class Segments:
    """Runs of windows with one anchor in a buffer: hash of the anchor string and of the segment, first byte, anchor's place, bytes."""

    key: np.ndarray
    seg: np.ndarray
    lo: np.ndarray
    left: np.ndarray
    size: np.ndarray


def segments(buffer: np.ndarray, ends: np.ndarray, rules: Repeats) -> Segments:
    """Segments of a buffer of texts that end at `ends`; no window crosses an end."""
    n = len(buffer) - rules.least + 1
    if n <= 0:
        none = np.zeros(0, np.int64)
        return Segments(none.view(np.uint64), none.view(np.uint64), none, none, none)
    hashes = Hashes(buffer)
    grams = hashes.every(rules.gram)
    ranked = (grams & ~_SPOT) | np.arange(len(grams), dtype=np.uint64)
    anchor = (_least_of_each(ranked, rules.least - rules.gram + 1) & _SPOT).astype(np.int64)
    # a window that begins less than `least` bytes before an end is none
    broken = np.zeros(len(buffer) + 2, np.int64)
    inner = ends[ends < len(buffer)]
    np.add.at(broken, np.maximum(inner - rules.least + 1, 0), 1)
    np.add.at(broken, inner, -1)
    good = np.cumsum(broken)[:n] == 0
    change = np.ones(n + 1, bool)
    change[1:n] = (anchor[1:] != anchor[:-1]) | (good[1:] != good[:-1])
    edges = np.flatnonzero(change)
    first, after = edges[:-1], edges[1:]
    first, after = first[good[first]], after[good[first]]
    at = anchor[first]
    size = after - 1 - first + rules.least
    return Segments(grams[at], hashes.of(first, size), first, at - first, size)


OCCURRENCE = "key bigint, seg bigint, t1 bigint, t2 bigint, copies bigint, lo bigint, left int, size int, times int"


def _blocks(offsets: np.ndarray, least: int, block: int) -> Iterator[tuple[int, int, int]]:
    """(first row, first byte, last byte + 1): rows of up to `block` bytes together, longer ones in overlapping parts."""
    row, rows = 0, len(offsets) - 1
    while row < rows:
        at, end = int(offsets[row]), int(offsets[row + 1])
        if end - at > block:
            for part in range(at, end - least + 1, block):
                yield row, part, min(part + block + least - 1, end)
            row += 1
        else:
            after = int(np.searchsorted(offsets, at + block, side="right")) - 1
            yield row, at, int(offsets[after])
            row = max(after, row + 1)


def occurrences(texts: DataFrame, rules: Repeats) -> DataFrame:
    """OCCURRENCE rows of (t1, t2, copies, raw): every segment; equal ones that follow each other are one row with `times`."""
    block = BLOCK

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            raw = batch.column(3)
            offsets = np.frombuffer(raw.buffers()[1], np.int32)[raw.offset : raw.offset + len(raw) + 1].astype(np.int64)
            if offsets[0] == offsets[-1]:
                continue
            data = np.frombuffer(raw.buffers()[2], np.uint8)
            ids = [batch.column(k).to_numpy() for k in range(3)]
            for row, at, end in _blocks(offsets, rules.least, block):
                found = segments(data[at:end], offsets[row + 1 :] - at if offsets[row + 1] <= end else np.array([end - at]), rules)
                if not len(found.lo):
                    continue
                place = found.lo + at
                rows = np.searchsorted(offsets, place, side="right") - 1
                stride = found.size - rules.least + 1
                again = (found.seg[1:] == found.seg[:-1]) & (found.lo[1:] == found.lo[:-1] + stride[:-1]) & (rows[1:] == rows[:-1])
                first = np.flatnonzero(np.concatenate([[True], ~again]))
                times = np.diff(np.append(first, len(found.lo)))
                keep = rows[first]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(found.key[first].view(np.int64)),
                        pa.array(found.seg[first].view(np.int64)),
                        *[pa.array(x[keep]) for x in ids],
                        pa.array(place[first] - offsets[keep]),
                        *[pa.array(x.astype(np.int32)) for x in (found.left[first], found.size[first], times)],
                    ],
                    names=["key", "seg", "t1", "t2", "copies", "lo", "left", "size", "times"],
                )

    return texts.select(*TEXT, "copies", "raw").mapInArrow(run, OCCURRENCE)


def common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    apart = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (apart.bit_length() + 7) // 8


def prefix_intervals(shared: Sequence[int]) -> Iterator[tuple[int, int, int]]:
    """(length, first, last) of the intervals of a sorted list; `shared[i]` is what items i and i + 1 have in common.

    Children come before their parents.
    """
    stack: list[tuple[int, int]] = []
    for i, length in enumerate([*shared, -1]):
        first = i
        while stack and stack[-1][0] > length:
            value, first = stack.pop()
            yield value, first, i
        if not stack or stack[-1][0] < length:
            stack.append((length, first))


@dataclass
class Member:
    """A segment of a key's group: its bytes left of the anchor, backwards; those from the anchor on; how often it occurs."""

    left: bytes
    right: bytes
    n: int


def maximal_repeats(group: list[Member], least: int) -> Iterator[tuple[int, int, list[int]]]:
    """(bytes left of the anchor, bytes from it on, members) of each maximal repeat of `least` bytes and more."""
    order = sorted(range(len(group)), key=lambda k: group[k].right)
    shared = [common(group[a].right, group[b].right) for a, b in zip(order, order[1:])]
    longest = max(len(m.left) for m in group)
    inside: set[int] = set()                # members that others hold as a whole: their repeats have those as well
    for right, first, last in prefix_intervals(shared):
        if right + longest < least:
            continue
        child, number = {}, 0
        for spot in range(first, last + 1):
            number += spot > first and shared[spot - 1] == right
            child[order[spot]] = number
        backward = sorted(child, key=lambda k: group[k].left)
        agree = [common(group[a].left, group[b].left) for a, b in zip(backward, backward[1:])]
        for left, one, two in prefix_intervals(agree):
            members = backward[one : two + 1]
            if left + right >= least and any(child[k] != child[members[0]] for k in members):
                inside.update(k for k in members if (len(group[k].left), len(group[k].right)) == (left, right))
                yield left, right, members
    for k, member in enumerate(group):
        if member.n > 1 and k not in inside:
            yield len(member.left), len(member.right), [k]


def united(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs (first, last + 1) that the spans cover."""
    out: list[tuple[int, int]] = []
    for first, end in sorted(spans):
        if out and first <= out[-1][1]:
            if end > out[-1][1]:
                out[-1] = (out[-1][0], end)
        else:
            out.append((first, end))
    return out


_SPANS = "spans array<struct<first:int,end:int>>"
_GROUPS = "repeats array<struct<no:bigint,first:int,length:int>>"
REPEATED = f"key bigint, seg bigint, {_SPANS}, {_GROUPS}"
PIECE = "key bigint, seg bigint, n bigint, left int, open boolean, piece binary"


def _pieces(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """PIECE rows: the bytes of the segments of `wanted`, each cut from the text that stands for it."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            for raw, cuts in zip(batch.column(0), batch.column(1)):
                text, cuts = raw.as_py(), cuts.values
                for part in small_batches([pa.RecordBatch.from_struct_array(cuts)], 1 << 16):
                    key, seg, n, lo, left, size, is_open = part.columns
                    pieces = [text[a : a + b] for a, b in zip(lo.to_pylist(), size.to_pylist())]
                    yield pa.RecordBatch.from_arrays([key, seg, n, left, is_open, pa.array(pieces, pa.binary())], names=["key", "seg", "n", "left", "open", "piece"])

    lists = wanted.groupBy(*TEXT).agg(F.collect_list(F.struct("key", "seg", "n", "lo", "left", "size", "open")).alias("cuts"))
    return texts.join(lists.hint("shuffle_hash"), TEXT).select("raw", "cuts").mapInArrow(run, PIECE)


def _compared(pieces: DataFrame, rules: Repeats) -> DataFrame:
    """REPEATED rows of the segments of each key, by its prefix intervals."""

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(column.to_pylist() for column in batch.columns))

    def emit(out: list[tuple]) -> pa.RecordBatch:
        spans = pa.array([x[2] for x in out], pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())])))
        groups = pa.array([x[3] for x in out], pa.list_(pa.struct([("no", pa.int64()), ("first", pa.int32()), ("length", pa.int32())])))
        return pa.RecordBatch.from_arrays(
            [pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64()), spans, groups], names=["key", "seg", "spans", "repeats"]
        )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for key, held in groupby(rows(batches), key=lambda row: row[0]):
            held = list(held)
            group = [Member(piece[:left][::-1], piece[left:], n) for _, _, n, left, piece in held]
            found = defaultdict(list)
            for no, (left, right, members) in enumerate(maximal_repeats(group, rules.least)):
                for k in members:
                    found[k].append((no, len(group[k].left) - left, left + right))
            for k, repeats in found.items():
                out.append((key, held[k][1], united((a, a + b) for _, a, b in repeats), repeats))
            if len(out) > 2000:
                yield emit(out)
                out = []
        if out:
            yield emit(out)

    dealt = pieces.select("key", "seg", "n", "left", "piece").repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(run, REPEATED)


def _opened(pieces: DataFrame, rules: Repeats) -> DataFrame:
    """REPEATED rows of segments whose key has too many for one task: each window meets its equals by two hashes of it."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in small_batches(batches, 1 << 16):
            for key, seg, n, piece in zip(*(column.to_pylist() for column in batch.columns)):
                one = Hashes(np.frombuffer(piece, np.uint8)).every(rules.least).view(np.int64)
                two = np.array([xxhash.xxh3_64_intdigest(piece[i : i + rules.least]) for i in range(len(one))], np.uint64).view(np.int64)
                same = [pa.array(np.full(len(one), x)) for x in (key, seg, n)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(one), pa.array(two), *same, pa.array(np.arange(len(one), dtype=np.int32))], names=["w1", "w2", "key", "seg", "n", "at"]
                )

    windows = materialize(pieces.select("key", "seg", "n", "piece").mapInArrow(run, "w1 bigint, w2 bigint, key bigint, seg bigint, n bigint, at int"), "open-windows")
    again = windows.groupBy("w1", "w2").agg(F.sum("n").alias("n")).where("n > 1").drop("n")
    found = windows.join(again, ["w1", "w2"], "left_semi")
    size = F.lit(rules.least)
    spans = F.collect_list(F.struct(F.col("at").alias("first"), (F.col("at") + size).alias("end")))
    groups = F.collect_list(F.struct(F.col("w1").alias("no"), F.col("at").alias("first"), size.alias("length")))
    return found.groupBy(*SEGMENT).agg(spans.alias("spans"), groups.alias("repeats"))


def _keyed(docs: DataFrame, text: str) -> DataFrame:
    raw = blank(text).cast("binary")
    return docs.withColumns({"t1": F.xxhash64(raw), "t2": F.xxhash64(F.lit(1), raw), "raw": raw})


@dataclass(frozen=True)
class Found:
    """Distinct texts (t1, t2, copies, raw), their segments of repeated keys, and REPEATED."""

    texts: DataFrame
    segments: DataFrame
    repeated: DataFrame


def find(docs: DataFrame, rules: Repeats = Repeats(), text: str = "text") -> Found:
    rows = _keyed(docs.select(text), text)
    texts = bucketed(rows.groupBy(*TEXT).agg(F.count(F.lit(1)).alias("copies"), F.first("raw").alias("raw")), "distinct-texts", *TEXT)
    every = materialize(occurrences(texts, rules), "segments")
    weight = F.sum(F.col("copies") * F.col("times")).alias("n")
    keys = every.groupBy("key").agg(weight).where("n > 1").select("key")
    again = materialize(every.join(keys, "key", "left_semi"), "repeated-segments")
    kinds = again.groupBy(*SEGMENT).agg(weight, F.min(F.struct(*TEXT, "lo", "left", "size")).alias("rep"))
    kinds = materialize(kinds, "segment-kinds")
    per_key = kinds.groupBy("key").agg(F.count(F.lit(1)).alias("kinds"))
    placed = kinds.join(per_key, "key").select(*SEGMENT, "n", "rep.*", "kinds")

    # one segment only: it repeats as a whole
    spans = F.array(F.struct(F.lit(0).alias("first"), F.col("size").alias("end")))
    groups = F.array(F.struct(F.lit(0).cast("bigint").alias("no"), F.lit(0).alias("first"), F.col("size").alias("length")))
    alone = placed.where("kinds = 1").select(*SEGMENT, spans.alias("spans"), groups.alias("repeats"))
    wanted = placed.where("kinds > 1").withColumn("open", F.col("kinds") > rules.together)
    pieces = materialize(_pieces(texts, wanted), "segment-texts")
    compared, opened = _compared(pieces.where("NOT open"), rules), _opened(pieces.where("open"), rules)
    return Found(texts, again, materialize(alone.unionByName(compared).unionByName(opened), "repeats"))


def repeat_groups(docs: DataFrame, rules: Repeats = Repeats(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, no, length, doc_id, start): all occurrences of each repeat (key, no), its bytes and where they start.

    A repeat that leaves its segments on a side is reported once per anchor, in overlapping parts.  Rows that share an
    id or a text are occurrences of their own.  Null texts count as empty.
    """
    found = find(docs, rules, text)
    each = found.segments.join(found.repeated.select(*SEGMENT, "repeats"), SEGMENT)
    each = each.withColumn("time", F.explode(F.sequence(F.lit(0), F.col("times") - 1)))
    start = F.col("lo") + F.col("time") * (F.col("size") - rules.least + 1)
    each = each.select("key", *TEXT, start.alias("at"), F.inline("repeats"))
    each = each.select("key", "no", "length", *TEXT, (F.col("at") + F.col("first")).alias("start"))
    ids = _keyed(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), "text").select("doc_id", *TEXT)
    return each.join(ids, TEXT).select("key", "no", "length", "doc_id", "start")


def _cut(found: Found, rules: Repeats) -> DataFrame:
    """(t1, t2, n_bytes, n_removed, n_spans, kept) per distinct text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            rows = []
            for copies, raw, spans in zip(*(batch.column(k) for k in (2, 3, 4))):
                text = raw.as_py()
                if copies.as_py() > 1:          # every window is in the copy too
                    runs = [(0, len(text))] if len(text) >= rules.least else []
                else:
                    runs = united((x["first"], x["end"]) for x in spans.as_py() or ())
                edges = [0, *(edge for run in runs for edge in run), len(text)]
                kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))
                rows.append((len(text), len(text) - len(kept), len(runs), kept))
            n, gone, runs, kept = zip(*rows)
            counts = [pa.array(x, pa.int64()) for x in (n, gone, runs)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *counts, pa.array(kept, pa.binary())], names=["t1", "t2", "n_bytes", "n_removed", "n_spans", "kept"]
            )

    # a text with copies goes as a whole, so only single ones ask for spans
    each = found.segments.where("copies = 1").join(found.repeated.select(*SEGMENT, "spans"), SEGMENT)
    further = (F.col("times") - 1) * (F.col("size") - rules.least + 1)
    each = each.select(*TEXT, "lo", further.alias("further"), F.inline("spans"))
    span = F.struct((F.col("lo") + F.col("first")).alias("first"), (F.col("lo") + F.col("further") + F.col("end")).alias("end"))
    spans = each.groupBy(*TEXT).agg(F.collect_list(span).alias("spans"))
    joined = found.texts.join(spans.hint("shuffle_hash"), TEXT, "left").select(*TEXT, "copies", "raw", "spans")
    return joined.mapInArrow(run, "t1 bigint, t2 bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")


def without_repeats(docs: DataFrame, rules: Repeats = Repeats(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept) per row of `docs`: its bytes without those of any repeat.

    A byte goes if a string of `least` bytes over it also starts anywhere else, be it in the same text, in an equal one,
    or overlapping; all of them are judged on the input.  `kept` need not be valid UTF-8.  Matches never cross texts.  A
    null text counts as empty; rows that share an id stay rows, copies of each other are repeats; an empty table gives no
    rows.  Other columns are not used.
    """
    cut = materialize(_cut(find(docs, rules, text), rules), "cut-texts")
    ids = _keyed(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), "text").select("doc_id", *TEXT)
    return ids.join(cut, TEXT).drop(*TEXT)


def repeat_report(docs: DataFrame, rules: Repeats = Repeats(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`without_repeats` with the SHA-256 of what is kept in its place, so that no text moves twice."""
    cut = _cut(find(docs, rules, text), rules).withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")
    ids = _keyed(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), "text").select("doc_id", *TEXT)
    return ids.join(materialize(cut, "cut-texts"), TEXT).drop(*TEXT)
