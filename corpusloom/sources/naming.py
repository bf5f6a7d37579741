"""Slice arguments and stored names: checks on a handful of values."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping

Slice = float | tuple[float, float] | None


def parse_slice(value: str | float | int | list | tuple | None) -> tuple[float, float] | None:
    """`"a-b"`, a pair, or one number p (read as 0..p) -> (start, end)."""
    if value is None:
        return None
    if isinstance(value, str):
        value = [float(part) for part in value.split("-")]
    if isinstance(value, (int, float)):
        return (0.0, float(value))
    if len(value) != 2:
        raise ValueError(f"a slice is one number or two, got {value!r}")
    start, end = float(value[0]), float(value[1])
    if not 0.0 <= start < end <= 1.0:
        raise ValueError(f"slice must satisfy 0 <= start < end <= 1, got {value!r}")
    return (start, end)


def stored_name(dataset: str, config: str | None, split: str) -> str:
    """Readable part of a storage key; the digest beside it tells slices apart."""
    return f"{dataset}_{config or 'default'}_{split}"


def tokenizer_id(name: str | None) -> str:
    return (name or "unknown_tokenizer").replace("/", "__")


def storage_key(dataset: str, config: str | None, split: str, value: Slice, settings: Mapping[str, object]) -> str:
    """The readable name plus a digest of everything that changes the content.

    Block length, end mark, packing scope and the full-precision slice are all
    in the digest, so two different preparations never share a key.
    """
    payload = json.dumps({"slice": value, **settings}, sort_keys=True, default=str)
    return f"{stored_name(dataset, config, split)}-{hashlib.sha256(payload.encode()).hexdigest()[:16]}"
