"""The pipeline's stages, each against brute force on its own input."""

from __future__ import annotations

import zlib

import numpy as np
import zstandard
from tokenizers import Tokenizer

import corpus_pipeline
from corpusloom.llm import bpe, quality
from test_joins import contaminated
from test_near_stage import survivors


def test_stages(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    columns, packer = docs.columns, zstandard.ZstdCompressor(level=3)
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
        out = stage(spark, docs, sf_dir)
        out.write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
        if name == "packing":
            break
        assert docs.columns == columns
        kept = sorted(r.doc_id for r in docs.collect())
        if name == "quality rules":
            want = [d for d, t in before if quality.assess((t or "").encode(), quality.RULES, packer)[-1]]
        elif name == "n-gram Jaccard join":
            want = survivors(before)
        else:
            want = [r[0] for r in contaminated(before, items) if not r[-1]]
        assert kept == sorted(want) and kept
    pieces = {}
    for r in docs.collect():
        pieces.setdefault(r.doc_id, []).append((r.start, r.length, r.ids_crc32, r.doc_tokens))
    library = Tokenizer.from_file(bpe.tokenizer_path())
    assert set(pieces) == {d for d, _ in before}
    for d, t in before:
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for start, length, crc, whole in sorted(pieces[d]):
            assert (start, whole, crc) == (at, len(ids), zlib.crc32(ids[at : at + length].tobytes()))
            at += length
        assert at == len(ids)
