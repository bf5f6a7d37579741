"""Chunks and limits of the compression bands, on noise beside clean text."""

from __future__ import annotations

import random
import string

import pytest
import zstandard

from corpusloom.llm import quality

ALNUM = string.ascii_letters + string.digits


def noise(size, letters=ALNUM, seed=0):
    r = random.Random(seed)
    return " ".join("".join(r.choices(letters, k=12)) for _ in range(size // 13 + 1)).encode()[:size]


def clean(spark, sf_dir):
    texts = [(r.text or "").encode() for r in spark.read.parquet(f"{sf_dir.replace('sf0.001', 'sf0.01')}/documents.parquet").select("text").collect()]
    return [t for t in texts if len(t.split()) >= 50 and 2 * quality.repeated_words(t.split()) <= len(t.split())]


def assess(raw):
    return quality.assess(raw, quality.RULES, zstandard.ZstdCompressor(level=3))


@pytest.mark.parametrize("size", [1, 511, 512, 4095, 4096, 4097, 5000, 8191, 8192, 8193])
def test_chunks_cover_the_text(size):
    spans = list(quality.spans(size, quality.RULES))
    assert len(spans) == -(-size // 4096) and spans[0][0] == 0 and spans[-1][1] == size
    assert all(a[1] >= b[0] for a, b in zip(spans, spans[1:]))
    assert all(end - first >= min(size, 512) for first, end in spans)


def test_a_bad_tail_counts_like_a_bad_head(spark, sf_dir):
    prose = max(clean(spark, sf_dir), key=len)[:4096]
    for bad in (2500, 4095):
        one, two = assess(prose + noise(bad)), assess(noise(4096) + prose[:bad])
        assert one[-3:-1] == two[-3:-1] == (2, 1) and one[-1] == two[-1]
    assert assess(prose[:3000])[-3:-1] == (1, 0) and assess(b"")[-3:-1] == (0, 0)


@pytest.mark.parametrize("letters, least", [(ALNUM, 256), (string.ascii_lowercase, 1536)])
def test_noise_of_every_band_fails(letters, least):
    for size in (256, 400, 511, 512, 700, 1023, 1024, 1300, 1535, 1536, 2000, 2047, 2048, 3000, 4095, 4096, 8191, 8192, 30_000, 65_535, 65_536, 200_000):
        for seed in range(3):
            ratio, band = assess(noise(size, letters, seed))[6], quality.RULES.band(size)
            assert size < least or ratio < band.least


def test_clean_text_of_every_band_stays(spark, sf_dir):
    texts = clean(spark, sf_dir)
    kept = [assess(t)[-1] for t in texts]
    assert sum(kept) > 0.99 * len(kept)


def test_half_noise_in_a_long_document_fails(spark, sf_dir):
    prose = b" ".join(t for t in clean(spark, sf_dir) if len(t) > 2048)[:52_000]
    assert len(prose) == 52_000 and assess(prose)[-1]
    assert not assess(prose + noise(48_000, string.ascii_lowercase))[-1]
    assert not assess(noise(700))[-1] and not assess(prose[:4096] + noise(600))[-1]
