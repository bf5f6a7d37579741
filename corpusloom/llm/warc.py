"""WARC archives of pages, and their index by external merge.

Every page becomes a record, a gzip member of its own, of an archive.  Of records
with equal payloads the one with the largest page id is the response, the others
are revisits that name it and carry no payload.  Each archive yields a capture run:
its records' index lines, sorted by URL key and timestamp.  The runs are merged to
one index in global order: Spark range-partitions the lines by key and time, and
inside a range a loser tree merges the slices of the runs, with one comparison per
level for each line.

Archives are the rows of a Parquet table (`content` is a whole .warc.gz), so Spark's
committer publishes all of them or none, and a lost executor leaves nothing behind.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterable, Iterator, Sequence
from datetime import datetime, timezone
from urllib.parse import urlsplit

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.common import blank, small_batches
from corpusloom.session import materialize

ARCHIVE_BYTES = 8 << 20         # an archive closes at the first record end after so many bytes
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"       # fixed value of the format
ID = "urn:x-page:"
MEMBER_STEP = 16 << 10


def payload_digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def url_key(url: str) -> str:
    """Sort-friendly form of a URL: host labels reversed, then path and query, lower case, no fragment."""
    try:
        parts = urlsplit(url.strip().lower())
        host, port = parts.hostname or "", parts.port
    except ValueError:
        return url.strip().lower()
    host = re.sub(r"^www\d*\.", "", host)
    query = f"?{parts.query}" if parts.query else ""
    place = f":{port}" if port and port not in (80, 443) else ""
    return ",".join(reversed(host.split("."))) + place + ")" + (parts.path or "/") + query


def record(page_id: int | None, url: str, captured: str, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record; a revisit keeps the HTTP head, whose length field is that of the full payload."""
    name = "" if page_id is None else str(page_id)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{ID}{name}>",
        "WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"),
        f"WARC-Date: {captured}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        head[3:3] = [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{ID}{refers_to}>"]
    return ("\r\n".join(head) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    """Fields of a record; the digest of a response is computed from its payload and must be the one it states."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    stated = int(re.search(rb"(?im)^Content-Length: (\d+)", http)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    revisit = fields["WARC-Type"] == "revisit"
    if not revisit and (len(payload) != stated or payload_digest(payload) != digest):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    name = fields["WARC-Record-ID"][1 + len(ID) : -1]
    return {
        "page_id": int(name) if name else None,
        "payload_bytes": stated,
        "payload_digest": digest,
        "record_type": fields["WARC-Type"],
        "refers_to": int(fields["WARC-Refers-To"][1 + len(ID) : -1]) if revisit else None,
        "url": fields["WARC-Target-URI"],
        "captured": fields["WARC-Date"],
    }


def members(content: bytes) -> Iterator[tuple[int, int, bytes]]:
    """(offset, length, record) of every gzip member of an archive, without an index.

    The archive is fed in steps, as what follows a member is copied with it.
    """
    at, view = 0, memoryview(content)
    while at < len(view):
        unpack, end, parts = zlib.decompressobj(wbits=31), at, []
        while not unpack.eof:
            step = view[end : end + MEMBER_STEP]
            if not step:
                raise ValueError(f"archive ends inside the record at {at}")
            parts.append(unpack.decompress(step))
            end += len(step)
        end -= len(unpack.unused_data)
        yield at, end - at, b"".join(parts)
        at = end


def member(content: memoryview, offset: int, length: int) -> bytes:
    """The record that the index places at `offset`; it must fill `length` bytes."""
    unpack = zlib.decompressobj(wbits=31)
    raw = unpack.decompress(content[offset : offset + length])
    if not unpack.eof or unpack.unused_data:
        raise ValueError(f"no record of {length} bytes at {offset}")
    return raw


def revisits(pages: DataFrame, least_bytes: int) -> DataFrame:
    """(page_id, sha, refers_to) of the pages that revisit: equal payloads, not the largest id.

    Narrow: the html does not move.  Largest ids combine before the shuffle, and only
    payloads with several ids are joined back.
    """
    raw = blank("html").cast("binary")
    marks = materialize(pages.select("page_id", F.unhex(F.sha1(raw)).alias("sha"), F.octet_length(raw).alias("bytes")), "payload-marks")
    marks = marks.where((F.col("bytes") >= least_bytes)).drop("bytes")
    groups = marks.groupBy("sha").agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")).where("n > 1 AND refers_to IS NOT NULL")
    # written, so that the join can be split where a third of all pages share a payload
    groups = materialize(groups.drop("n"), "payload-groups")
    return marks.join(groups, "sha").where(~F.col("page_id").eqNullSafe(F.col("refers_to"))).distinct()


def archives(pages: DataFrame, captured: Column, least_bytes: int = 0, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Archives of all rows of `pages`, each with its sorted capture run.

    Null html is an empty payload, a null url an empty one, a null page id an empty
    record name; rows that repeat the largest id of a payload are all responses.  An
    empty table gives no archive; other columns are not used.
    """
    rows = pages.select(
        F.col(page_id).cast("bigint").alias("page_id"),
        F.coalesce(F.col(url), F.lit("")).alias("url"),
        F.coalesce(F.col(html), F.lit("")).alias("html"),
        F.date_format(captured, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("captured"),
    )
    again = materialize(revisits(rows, least_bytes), "revisits")
    sha = F.unhex(F.sha1(F.col("html").cast("binary")))
    again = again.select(F.col("page_id").alias("_page"), F.col("sha").alias("_sha"), "refers_to")
    placed = rows.withColumn("sha", sha).join(again, F.col("page_id").eqNullSafe(F.col("_page")) & (F.col("sha") == F.col("_sha")), "left")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        parts: list[bytes] = []
        lines: list[dict] = []
        size = 0

        def closed() -> pa.RecordBatch:
            name = f"part-{part:06d}-{number:05d}.warc.gz"
            lines.sort(key=lambda x: (x["urlkey"], x["captured"], x["offset"]))
            run = [line | {"archive": name} for line in lines]
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([b"".join(parts)]), pa.array([run], _RUN)], names=["archive", "content", "run"])

        for batch in small_batches(batches):
            raw = pc.cast(batch.column(2), pa.binary())
            for page, address, payload, when, refers in zip(*[c.to_pylist() for c in (batch.column(0), batch.column(1), raw, batch.column(3), batch.column(4))]):
                packer = zlib.compressobj(6, wbits=31)
                packed = packer.compress(record(page, address, when or "", payload, payload_digest(payload), refers)) + packer.flush()
                lines.append({"urlkey": url_key(address), "captured": when or "", "offset": size, "length": len(packed)})
                parts.append(packed)
                size += len(packed)
                if size >= ARCHIVE_BYTES:
                    yield closed()
                    parts, lines, size, number = [], [], 0, number + 1
        if parts:
            yield closed()

    return placed.select("page_id", "url", "html", "captured", "refers_to").mapInArrow(run, _ARCHIVE)


_FIELDS = [("urlkey", pa.string()), ("captured", pa.string()), ("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64())]
_RUN = pa.list_(pa.struct([pa.field(n, k) for n, k in _FIELDS]))
_ENTRY = "urlkey: string, captured: string, archive: string, offset: bigint, length: bigint"
_ARCHIVE = f"archive string, content binary, run array<struct<{_ENTRY}>>"


class LoserTree:
    """Merges sorted runs: each inner node keeps the loser of its match, the winner moves up.

    Taking the smallest line costs one match per level.  An exhausted run loses
    against every other; equal lines come out in order of their runs.
    """

    def __init__(self, runs: Sequence[Iterator[tuple]]):
        self.runs = list(runs)
        self.k = max(1, len(self.runs))
        self.heads: list[tuple | None] = [next(run, None) for run in self.runs] or [None]
        self.losers = [-1] * self.k
        for leaf in range(self.k):
            self._climb(leaf, building=True)

    def _beats(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        if x is None or y is None:
            return x is not None or (y is None and a < b)
        return (x, a) < (y, b)

    def _climb(self, run: int, building: bool = False) -> None:
        node = (run + self.k) // 2
        while node:
            other = self.losers[node]
            if building and other < 0:
                self.losers[node] = run         # the first to arrive waits for its opponent
                return
            if self._beats(other, run):
                self.losers[node], run = run, other
            node //= 2
        self.losers[0] = run

    def __iter__(self) -> Iterator[tuple[int, tuple]]:
        """(run, line) in order."""
        while (head := self.heads[run := self.losers[0]]) is not None:
            yield run, head
            self.heads[run] = next(self.runs[run], None)
            self._climb(run)


_INDEX = "part int, seq bigint, urlkey string, captured string, archive string, offset bigint, length bigint"


def merged_index(stored: DataFrame) -> DataFrame:
    """(part, seq, urlkey, captured, archive, offset, length) of all runs, in global order of (part, seq).

    A hot URL key is cut by its timestamps and archives, so no range outgrows the rest.
    """
    lines = stored.select(F.explode("run").alias("line")).select("line.*")
    order = ["urlkey", "captured", "archive", "offset"]
    ranged = lines.repartitionByRange(*order).sortWithinPartitions("archive", "urlkey", "captured", "offset")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        lines = pa.Table.from_batches(held)
        names = lines.column("archive").combine_chunks().dictionary_encode()
        codes = names.indices.to_numpy()
        cuts = [0, *(i for i in range(1, len(codes)) if codes[i] != codes[i - 1]), len(codes)]

        def sliced(a: int, b: int) -> Iterator[tuple]:
            for at in range(a, b, 4096):
                part = lines.slice(at, min(4096, b - at))
                yield from zip(*[part.column(n).to_pylist() for n in ("urlkey", "captured", "archive", "offset", "length")])

        part, seq, out = TaskContext.get().partitionId(), 0, []
        for _, line in LoserTree([sliced(a, b) for a, b in zip(cuts, cuts[1:])]):
            out.append((part, seq, *line))
            seq += 1
            if len(out) == 4096:
                yield _index_batch(out)
                out = []
        if out:
            yield _index_batch(out)

    return ranged.mapInArrow(run, _INDEX)


def _index_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int64(), *[k for _, k in _FIELDS]]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["part", "seq", *[n for n, _ in _FIELDS]])


def read_records(stored: DataFrame) -> DataFrame:
    """Every record of the archives: (archive, offset, page_id, payload_bytes, payload_digest, record_type, refers_to, url, captured).

    Each is cut out by its line of the capture run, in order of offsets.
    """
    kinds = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "refers_to": pa.int64()}
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "captured"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            for archive, content, lines in zip(*batch.columns):
                view = memoryview(content.as_py())
                places = sorted((line["offset"], line["length"]) for line in lines.as_py())
                if sum(length for _, length in places) != len(view):
                    raise ValueError(f"the index of {archive} leaves out a part of it")
                found = [(at, parse_record(member(view, at, length))) for at, length in places]
                columns = [pa.array([f[n] for _, f in found], kinds.get(n, pa.string())) for n in names]
                where = [pa.array([archive.as_py()] * len(found)), pa.array([at for at, _ in found], pa.int64())]
                yield pa.RecordBatch.from_arrays([*where, *columns], names=["archive", "offset", *names])

    schema = ", ".join(f"{n} {'bigint' if n in kinds else 'string'}" for n in names)
    return stored.select("archive", "content", "run").mapInArrow(run, f"archive string, offset bigint, {schema}")


def capture_histories(spark: SparkSession, pages: DataFrame, folder: str, captured: Column, least_bytes: int = 0) -> DataFrame:
    """Write archives and merged index under `folder`, then read every record the index lists.

    One row per page: what its record says, its URL key, and its place (part, seq) in the
    global order of captures.
    """
    archives(pages, captured, least_bytes).write.parquet(f"{folder}/archives")
    stored = spark.read.parquet(f"{folder}/archives")
    merged_index(stored).write.parquet(f"{folder}/index")
    index = spark.read.parquet(f"{folder}/index").select("archive", "offset", "urlkey", "part", "seq")
    return read_records(stored).join(index, ["archive", "offset"])
