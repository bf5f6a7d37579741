"""Token arrays: bytes, words, end marks, padding, byte decoding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.schemas import BYTE_EOS

# Fixed value: words are letter runs, digit runs, or one other visible character.
WORD_PATTERN = r"\p{L}+|\p{N}+|[^\s\x0B\p{L}\p{N}]"


def byte_tokens(text: Column) -> Column:
    """UTF-8 bytes of `text` as ARRAY<INT>.

    Reading the bytes back as Latin-1 gives one character per byte, so the
    split and `ascii` stay linear in the text.
    """
    return raw_tokens(F.encode(text, "UTF-8"))


def raw_tokens(raw: Column) -> Column:
    """Bytes of a binary value as ARRAY<INT>."""
    chars = F.split(F.decode(raw, "ISO-8859-1"), "")
    return F.when(F.octet_length(raw) > 0, F.transform(chars, lambda c: F.ascii(c))).otherwise(F.array().cast("array<int>"))


def first_byte_tokens(text: Column, length: int) -> Column:
    """The first `length` of `byte_tokens`; what is cut off is never expanded."""
    return raw_tokens(F.substring(F.encode(text, "UTF-8"), 1, length))


def byte_count(text: Column) -> Column:
    """Length of `byte_tokens` without building the array."""
    return F.octet_length(text)


def word_tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD_PATTERN), F.lit(0))


def append_eos(ids: Column, eos: int | None = BYTE_EOS) -> Column:
    """End mark after each document; a tokenizer without one leaves ids alone."""
    return ids if eos is None else F.concat(ids, F.array(F.lit(eos)))


def _padding(ids: Column, length: int, fill: int) -> Column:
    return F.array_repeat(F.lit(fill), F.greatest(F.lit(0), F.lit(length) - F.size(ids)))


def pad_right(ids: Column, length: int, pad: int) -> Column:
    return F.concat(F.slice(ids, 1, length), _padding(ids, length, pad))


def pad_left(ids: Column, length: int, pad: int) -> Column:
    return F.concat(_padding(ids, length, pad), F.slice(ids, 1, length))


def mask_right(ids: Column, length: int) -> Column:
    return F.concat(F.array_repeat(F.lit(1), F.least(F.size(ids), F.lit(length))), _padding(ids, length, 0))


def mask_left(ids: Column, length: int) -> Column:
    return F.concat(_padding(ids, length, 0), F.array_repeat(F.lit(1), F.least(F.size(ids), F.lit(length))))


def byte_repr(ids: Column, eos: int = BYTE_EOS) -> Column:
    """Printable form: ASCII as is, the end mark named, other bytes as \\xNN."""
    return F.array_join(
        F.transform(
            ids,
            lambda x: F.when(x == eos, "<eos>")
            .when(x.between(32, 126), F.chr(x.cast("bigint")))
            .otherwise(F.concat(F.lit("\\x"), F.lpad(F.hex(x.cast("bigint")), 2, "0"))),
        ),
        "",
    )


def decode_bytes(ids: Column) -> Column:
    """Byte ids back to text; ids past a byte are skipped, broken UTF-8 is repaired."""
    kept = F.filter(ids, lambda x: x.between(0, 255))
    hexed = F.array_join(F.transform(kept, lambda x: F.lpad(F.hex(x.cast("bigint")), 2, "0")), "")
    return F.make_valid_utf8(F.unhex(hexed).cast("string"))


def next_token_pairs(ids: Column) -> Column:
    """ARRAY<STRUCT<prev, next>> of neighbouring tokens."""
    n = F.size(ids)
    prev = F.slice(ids, F.lit(1), F.greatest(n - 1, F.lit(0)))
    after = F.slice(ids, F.lit(2), F.greatest(n - 1, F.lit(0)))
    return F.arrays_zip(prev.alias("prev"), after.alias("next"))


def joined(ids: Column, sep: str = " ") -> Column:
    """Array as text, for display and comparison."""
    return F.array_join(ids.cast("array<string>"), sep)
