"""Token ids of whole texts from a public tokenizer file, with a word cache.

The tokenizer drops white space and never lets a token cross it, so a text's ids
are the ids of its white-space separated words in turn.  Real text repeats its
words; each is given to the library once and then looked up.
"""

from __future__ import annotations

import os
import re
import struct
import unicodedata
from collections.abc import Iterator

DEFAULT_FILE = "word_bpe_49k.json"

_GAP = re.compile(rb"[ \t\n\x0b\x0c\r]")
# Between a Latin letter and the ASCII punctuation that ends its word the tokenizer always cuts, and neither
# its normalisation nor its patterns look across that cut; a space there changes nothing.  U+0130 is left out:
# it lowers to a letter and a combining dot, which goes with the punctuation.
_TAIL = re.compile(
    r"[!-/:-@\[-`{-~](?<=[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f][!-/:-@\[-`{-~])[!-/:-@\[-`{-~]*(?=[ \t\n\x0b\x0c\r]|\Z)"
)
_SPECIAL = b"<|"        # opens the special tokens, which the library finds before it normalises
STRETCH = 1 << 20       # bytes of one text that are split into words at once


def tokenizer_path(name: str = DEFAULT_FILE) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class WordEncoder:
    """Encodes UTF-8 texts to little-endian unsigned 32-bit ids.

    The cache has two generations of at most `words` entries: when the younger is
    full it becomes the older, and what is still in use moves back.
    """

    def __init__(self, path: str, words: int = 500_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"          # a Spark task is one core
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._most = words
        self._young: dict[bytes, bytes] = {}
        self._older: dict[bytes, bytes] = {}

    def encode(self, raw: bytes) -> bytes:
        return b"".join(self._stretch(x) for x in _stretches(raw))

    def _stretch(self, raw: bytes) -> bytes:
        words = _separated(raw).split()
        if len(self._young) > self._most:
            self._older, self._young = self._young, {}
        found = list(map(self._young.get, words))
        if None in found:
            holes = [i for i, ids in enumerate(found) if ids is None]
            self._learn({words[i] for i in holes})
            for i in holes:
                found[i] = self._young[words[i]]
        return b"".join(found)

    def _learn(self, words: set[bytes]) -> None:
        new = []
        for word in words:
            ids = self._older.get(word)
            if ids is None:
                new.append(word)
            else:
                self._young[word] = ids
        if new:
            found = self._tokenizer.encode_batch_fast([x.decode("utf-8", "replace") for x in new], add_special_tokens=False)
            self._young.update(zip(new, [_packed(x.ids) for x in found]))


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def _stretches(raw: bytes) -> Iterator[bytes]:
    """`raw` cut at white space into stretches of about STRETCH bytes."""
    at = 0
    while at < len(raw):
        gap = _GAP.search(raw, at + STRETCH)
        end = gap.start() if gap else len(raw)
        yield raw[at:end]
        at = end


def _separated(raw: bytes) -> bytes:
    """`raw` with fewer different words and the same ids.

    Closing punctuation stands apart, and A-Z is lowered where that cannot change the
    ids: the tokenizer composes characters before it lowers them.
    """
    if _SPECIAL in raw:
        return raw
    text = raw.decode("utf-8", "replace")
    low = raw.lower()
    if not raw.isascii():
        plain = low.decode("utf-8", "replace")
        if unicodedata.is_normalized("NFC", text) and unicodedata.is_normalized("NFC", plain):
            text = plain
    else:
        text = low.decode("ascii")
    return _TAIL.sub(r" \g<0>", text).encode()


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """The process's encoder for `path`; a Python worker keeps it from task to task."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]
