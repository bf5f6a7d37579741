"""The preparation lifecycle: prepare, open, order, export."""

from __future__ import annotations

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import tokens as tok
from corpusloom.operators.vocab import build_vocab, encode_words
from corpusloom.plans import prepare as prep
from corpusloom.schemas import EOS_ID
from corpusloom.session import materialize
from corpusloom.sources.corpora import CORPUS_CELLS, CORPUS_KEY, scan_corpora

CONFIG = {"documents": {"train_slice": [0.5, 1.0]}, "benchmark": {}}


def test_prepared_once_and_opened_by_stage(spark, sf_dir, tmp_path):
    root, rows = str(tmp_path / "store"), scan_corpora(spark, sf_dir)
    packing = prep.Packing(batch_rows=50)
    plan = prep.run_plan(spark, CONFIG, packing)
    with pytest.raises(RuntimeError, match="benchmark: train, validation; documents: train, validation"):
        prep.open_stage(spark, plan, root, "fit")
    assert prep.prepare(spark, rows, plan, root, packing) == 6
    assert prep.prepare(spark, rows, plan, root, packing) == 0
    fit, everything = prep.open_stage(spark, plan, root, "fit"), prep.open_stage(spark, plan, root, None)
    assert {r.split for r in fit.select("split").distinct().collect()} == {"train", "validation"}
    assert 0 < fit.count() < everything.count()
    manifest = {(r.dataset, r.split): r.n_blocks for r in prep.read_manifest(spark, root).collect()}
    assert len(manifest) == 6 and sum(manifest.values()) == everything.count()

    # another block length is another key: prepared beside the first, which stays
    shorter = replace(packing, block_length=64)
    other = prep.run_plan(spark, CONFIG, shorter)
    assert prep.prepare(spark, rows, other, root, shorter) == 6
    assert prep.open_stage(spark, plan, root, "fit").count() == fit.count()
    assert prep.open_stage(spark, other, root, "fit").where(F.size("input_ids") != 64).count() == 0


def test_interrupted_run_is_redone(spark, sf_dir, tmp_path):
    """Blocks that no log row names are never read, so they are not doubled by the next run."""
    root, rows = str(tmp_path / "store"), scan_corpora(spark, sf_dir)
    plan = prep.run_plan(spark, {"benchmark": {}})
    packing = prep.Packing()
    prep.prepare(spark, rows, plan, root, packing)
    before = prep.open_stage(spark, plan, root, None).count()
    copy = str(tmp_path / "again")
    spark.read.parquet(f"{root}/blocks").write.partitionBy("storage_key", "writer").parquet(f"{copy}/blocks")
    assert prep.prepare(spark, rows, plan, copy, packing) == 3
    assert prep.open_stage(spark, plan, copy, None).count() == before > 0


def test_two_runs_at_once_leave_one_copy(spark, sf_dir, tmp_path, monkeypatch):
    """A second run prepares the same splits while the first is packing; both commit, readers take one."""
    root, rows = str(tmp_path / "store"), scan_corpora(spark, sf_dir)
    plan = prep.run_plan(spark, {"benchmark": {}})
    plain, nested = prep.multi_slice, []

    def meanwhile(*args):
        if not nested:
            nested.append(None)
            nested.append(prep.prepare(spark, rows, plan, root))
        return plain(*args)

    monkeypatch.setattr(prep, "multi_slice", meanwhile)
    assert prep.prepare(spark, rows, plan, root) == 3 and nested[1] == 3
    blocks = prep.open_stage(spark, plan, root, None)
    assert spark.read.parquet(f"{root}/log").count() == 6 and prep.read_manifest(spark, root).count() == 3
    assert blocks.count() == sum(r.n_blocks for r in prep.read_manifest(spark, root).collect())
    assert blocks.count() == blocks.select("storage_key", "block_id").distinct().count()


def test_claims_leave_work_to_the_first(spark, tmp_path):
    root = str(tmp_path / "store")
    assert prep.claim(spark, root, ["x", "y"], "one", 60) == ["x", "y"]
    assert prep.claim(spark, root, ["y", "z"], "two", 60) == ["z"]
    assert prep.claim(spark, root, ["x"], "one", 60) == ["x"]
    assert prep.claim(spark, root, ["x", "y", "z"], "three", 0.001) == ["x", "y", "z"]       # all earlier claims are over


def test_word_tokenizer_plugs_in(spark, sf_dir, tmp_path):
    rows = scan_corpora(spark, sf_dir)
    vocab = build_vocab(rows.where("dataset = 'benchmark'"))
    key = ["dataset", "split", *CORPUS_KEY, *[c for level in CORPUS_CELLS for c in level]]

    def by_words(df, eos):
        encoded = materialize(encode_words(df, key, vocab), "encoded")
        ids = tok.append_eos(F.col("input_ids"), EOS_ID if eos else None)
        return encoded, ids, F.size("input_ids") + int(eos)

    packing = prep.Packing(tokenizer="words", block_length=16, tokenize=by_words)
    plan = prep.run_plan(spark, {"benchmark": {}}, packing)
    root = str(tmp_path / "store")
    assert prep.prepare(spark, rows, plan, root, packing) == 3
    blocks = prep.open_stage(spark, plan, root, None)
    ids = blocks.select(F.explode("input_ids").alias("i")).agg(F.min("i").alias("lo"), F.max("i").alias("hi")).first()
    assert ids.lo == EOS_ID and ids.hi <= vocab.count() + 3


def test_stage_without_blocks_opens_empty(spark, sf_dir, tmp_path):
    root, rows = str(tmp_path / "store"), scan_corpora(spark, sf_dir).where("key1 < 3")
    packing = prep.Packing(block_length=1_000_000)
    plan = prep.run_plan(spark, {"benchmark": {}}, packing)
    assert prep.prepare(spark, rows, plan, root, packing) == 3
    assert prep.open_stage(spark, plan, root, "test").count() == 0
    with pytest.raises(ValueError):
        prep.open_stage(spark, plan, root, "predict")


def test_every_rank_gets_the_same_number_of_slots(spark, sf_dir, tmp_path):
    root, rows = str(tmp_path / "store"), scan_corpora(spark, sf_dir)
    plan = prep.run_plan(spark, {"benchmark": {}})
    prep.prepare(spark, rows, plan, root)
    blocks = prep.open_stage(spark, plan, root, "fit")
    ordered = prep.order_for_epoch(blocks, 1, 1, 3, 2, 2)
    out = str(tmp_path / "epoch")
    prep.export(ordered, out)
    counts = spark.read.parquet(out).groupBy("split", "rank").count().collect()
    for split in ("train", "validation"):
        assert len({r["count"] for r in counts if r.split == split}) == 1


def test_without_end_marks(spark, sf_dir, tmp_path):
    root, rows = str(tmp_path / "store"), scan_corpora(spark, sf_dir)
    packing = prep.Packing(eos=False)
    plan = prep.run_plan(spark, {"benchmark": {}}, packing)
    prep.prepare(spark, rows, plan, root, packing)
    blocks = prep.open_stage(spark, plan, root, None)
    assert blocks.count() > 0 and blocks.where(F.array_contains("input_ids", 256)).count() == 0
    keys = {r.storage_key for r in plan.collect()}
    assert not keys & {r.storage_key for r in prep.run_plan(spark, {"benchmark": {}}).collect()}


def test_unknown_options_are_refused(spark):
    with pytest.raises(KeyError, match="train_slise"):
        prep.run_plan(spark, {"benchmark": {"train_slise": 0.5}})


def test_export_has_wide_arrays(spark, sf_dir, tmp_path):
    root, out = str(tmp_path / "store"), str(tmp_path / "epoch")
    plan = prep.run_plan(spark, {"benchmark": {}})
    prep.prepare(spark, scan_corpora(spark, sf_dir), plan, root)
    prep.export(prep.order_for_epoch(prep.open_stage(spark, plan, root, "fit"), 1, 1, 2, 2, 2), out)
    rows = spark.read.parquet(out)
    assert {c: k for c, k in rows.dtypes if k.startswith("array")} == dict.fromkeys(["input_ids", "labels", "attention_mask"], "array<bigint>")
    assert rows.where("labels != input_ids OR size(attention_mask) != size(input_ids) OR array_min(attention_mask) != 1").count() == 0
