"""Quality rules with compression bands.

Zstandard shrinks repetitive text far more than prose and random characters far
less, and both depend on length, since a short text has little to repeat.  So a
document's ratio (raw bytes / compressed bytes) must lie inside the limits of its
length band, and the same is asked of its fixed-size chunks, the shorter last one
included, which finds a repetitive or incompressible stretch inside a long document.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.common import small_batches

WHITE = b" \t\n\x0b\x0c\r"
CONTINUED = bytes(range(0x80, 0xC0))        # bytes that continue a code point
SYMBOLS = b"#*$%&|<>"                       # fixed value of the rule

SCHEMA = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("word_chars", T.LongType()),
        T.StructField("n_symbols", T.LongType()),
        T.StructField("n_dup_lines", T.LongType()),
        T.StructField("n_repeat_words", T.LongType()),
        T.StructField("base_failed", T.BooleanType()),
        T.StructField("ratio", T.DoubleType()),
        T.StructField("n_chunks", T.LongType()),
        T.StructField("n_bad_chunks", T.LongType()),
        T.StructField("kept", T.BooleanType()),
    ]
)


@dataclass(frozen=True)
class Band:
    """Limits of the ratio for texts under `below` bytes."""

    below: float
    least: float
    most: float


@dataclass(frozen=True)
class Rules:
    """Production parameters, see README.

    The lower limits lie between noise and prose of a band's lengths.  Words of random
    letters and digits (5.95 bits a letter) reach 1.13, 1.22, 1.30, 1.33, 1.34, 1.36, 1.37 and
    1.38 from the first band on, words of random lower-case letters (4.7 bits) 1.65 under 2 KB and 1.70
    at any length.  Prose of 50 words goes down to 1.24 under 512 bytes, 1.43, 1.64,
    1.69, 1.83, 2.0 and 2.2.  So under 1,536 bytes random lower-case words are not told
    from prose by their ratio.
    """

    bands: tuple[Band, ...] = (
        Band(256, 1.15, 3.5),
        Band(512, 1.23, 3.5),
        Band(1024, 1.36, 4.0),
        Band(1536, 1.5, 4.0),
        Band(2048, 1.66, 4.0),
        Band(4096, 1.75, 4.5),
        Band(8192, 1.8, 4.5),
        Band(65536, 1.85, 5.0),
        Band(float("inf"), 1.85, 6.0),
    )
    chunk_bytes: int = 4096
    least_tail: int = 512           # a shorter last chunk says little, it takes bytes of the one before
    bad_share: float = 0.2          # a document goes when more than this share of its chunks is outside
    level: int = 3
    min_words: int = 50
    most_repeated: int = 50         # percent of the words

    def band(self, size: int) -> Band:
        return next(b for b in self.bands if size < b.below)


RULES = Rules()


def repeated_words(words: list[bytes]) -> int:
    """Words inside three-word windows that occur twice or more."""
    n = len(words)
    if n < 4:
        return 0
    number: defaultdict[bytes, int] = defaultdict(count().__next__)
    ids = np.fromiter(map(number.__getitem__, words), np.int64, n)
    m = len(number)
    if m < 1 << 21:
        keys = (ids[:-2] * m + ids[1:-1]) * m + ids[2:]
    else:
        pairs = np.unique(ids[:-1] * m + ids[1:], return_inverse=True)[1]
        keys = pairs[:-1] * m + ids[2:]
    ordered = np.sort(keys)
    again = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(again):
        return 0
    at = np.flatnonzero(np.isin(keys, again))
    hit = np.zeros(n, bool)
    hit[at] = hit[at + 1] = hit[at + 2] = True
    return int(hit.sum())


def spans(size: int, rules: Rules) -> Iterator[tuple[int, int]]:
    """(first, end) of the chunks of a text of `size` bytes, which cover all of it.

    The last one is what remains after the whole chunks, reaching back so that it has
    `least_tail` bytes, or the text where that is shorter.
    """
    for at in range(0, size, rules.chunk_bytes):
        end = min(size, at + rules.chunk_bytes)
        yield max(0, min(at, end - rules.least_tail)), end


def assess(raw: bytes, rules: Rules, packer: zstandard.ZstdCompressor) -> tuple:
    """One row of SCHEMA for the UTF-8 bytes of a text."""
    words = raw.split()
    n = len(words)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    repeats = repeated_words(words)
    failed = n < rules.min_words or 100 * repeats > rules.most_repeated * n
    ratio, chunks, bad = None, 0, 0
    if raw:
        ratio = len(raw) / len(packer.compress(raw))
        for first, end in spans(len(raw), rules):
            part = ratio if end - first == len(raw) else (end - first) / len(packer.compress(raw[first:end]))
            band = rules.band(end - first)
            chunks += 1
            bad += not band.least <= part <= band.most
    whole = rules.band(len(raw))
    kept = not failed and whole.least <= ratio <= whole.most and bad <= rules.bad_share * chunks
    return (
        n,
        len(raw.translate(None, WHITE + CONTINUED)),
        len(raw) - len(raw.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeats,
        failed,
        ratio,
        chunks,
        bad,
        kept,
    )


def with_quality(docs: DataFrame, text: str = "text", out: str = "quality", rules: Rules = RULES) -> DataFrame:
    """`docs` with a struct column `out` of SCHEMA; one row out per row in, all other columns as they are.

    Null text counts as empty: no words, so it fails the base rule, with a null
    ratio.  A column already named `out` is replaced.  Repeated rows are judged alike;
    an empty table stays empty.  Work is per row: no shuffle, no state between rows.
    """
    rest = docs.drop(out)
    schema = T.StructType([*rest.schema.fields, T.StructField(out, SCHEMA)])

    def judge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=rules.level)
        kind = pa.struct(
            [pa.field(f.name, {"bigint": pa.int64(), "double": pa.float64(), "boolean": pa.bool_()}[f.dataType.simpleString()]) for f in SCHEMA]
        )
        for batch in small_batches(batches):
            texts = pc.cast(batch.column(batch.schema.get_field_index(text)), pa.binary())
            rows = [assess(x.as_py() or b"", rules, packer) for x in texts]
            columns = [pa.array(c, kind.field(i).type) for i, c in enumerate(zip(*rows))]
            made = pa.StructArray.from_arrays(columns, fields=list(kind))
            yield pa.RecordBatch.from_arrays([*batch.columns, made], names=[*batch.schema.names, out])

    return rest.mapInArrow(judge, schema)


def keep_good(docs: DataFrame, text: str = "text", rules: Rules = RULES) -> DataFrame:
    """The rows of `docs` that pass all rules, with the columns of `docs`."""
    mark = "_quality"
    return with_quality(docs, text, mark, rules).where(F.col(mark)["kept"]).drop(mark)
