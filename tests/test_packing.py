"""Packing against concatenate-and-cut in plain Python."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import tokens as tok
from corpusloom.operators.ordering import integer_levels
from corpusloom.operators.packing import batch_group, pack_blocks, pack_plan, pack_stats, text_bytes

EOS = 256


def brute(docs, length, batch_rows, shards):
    """docs: key -> text; blocks in order, with the batch they came from."""
    ids = [list(docs[k].encode()) + [EOS] for k in sorted(docs)]
    n, groups = len(ids), []
    used = min(n, shards) or 1
    start = 0
    for s in range(used):
        size = n // used + (1 if s < n % used else 0)
        shard = ids[start : start + size]
        start += size
        groups += [shard[i : i + batch_rows] for i in range(0, len(shard), batch_rows)]
    out = []
    for g, group in enumerate(groups):
        flat = [t for doc in group for t in doc]
        for i in range(len(flat) // length):
            out.append((g, flat[i * length : (i + 1) * length]))
    return out


def run(spark, docs, length, scope="batch", batch_rows=1000, shards=1):
    df = spark.createDataFrame([("train", k, t) for k, t in docs.items()], "split string, doc_id bigint, text string")
    n = tok.byte_count(F.col("text")) + 1
    plan = pack_plan(df, ["split"], ["doc_id"], integer_levels("doc_id"), n, length, scope, batch_rows, shards)
    ids = tok.append_eos(tok.byte_tokens(F.col("text")), EOS)
    return pack_blocks(df, plan, ["split"], ["doc_id"], ids, length), plan


def check(spark, docs, length, batch_rows=1000, shards=1, scope="batch"):
    blocks, _ = run(spark, docs, length, scope, batch_rows, shards)
    rows = sorted(blocks.collect(), key=lambda r: r.block_id)
    expected = brute(docs, length, len(docs) if scope == "split" else batch_rows, shards if scope == "batch" else 1)
    assert [r.block_id for r in rows] == list(range(len(expected)))
    assert [(r.pack_group, list(r.input_ids)) for r in rows] == expected
    assert all(r.labels == r.input_ids and r.attention_mask == [1] * length for r in rows)


def random_docs(seed, n):
    rng = random.Random(seed)
    alphabet = "ab é漢🙂\n"
    keys = rng.sample(range(5 * n), n)
    return {k: "".join(rng.choice(alphabet) for _ in range(rng.choice([0, 1, 3, 20, 90]))) for k in keys}


@pytest.mark.parametrize("seed,batch_rows,shards", [(1, 7, 1), (2, 5, 3), (3, 4, 4), (4, 100, 1)])
def test_batch_scope_equals_python(spark, seed, batch_rows, shards):
    check(spark, random_docs(seed, 41), 16, batch_rows, shards)


def test_split_scope_equals_python(spark):
    check(spark, random_docs(9, 60), 16, scope="split")


def test_one_document_longer_than_many_blocks(spark):
    check(spark, {1: "x", 2: "y" * 1000, 3: "z"}, 8, batch_rows=2)


def test_total_shorter_than_a_block_gives_none(spark):
    blocks, plan = run(spark, {1: "ab", 2: ""}, 128)
    assert blocks.count() == 0
    (stats,) = pack_stats(plan, ["split"], 128).collect()
    assert (stats.n_tokens, stats.n_blocks, stats.n_dropped) == (4, 0, 4)


def test_blank_document_is_a_lone_end_mark(spark):
    blocks, _ = run(spark, {1: "", 2: "", 3: "a", 4: ""}, 5)
    assert list(blocks.first().input_ids) == [EOS, EOS, 97, EOS, EOS]


def test_empty_split(spark):
    df = spark.createDataFrame([], "split string, doc_id bigint, text string")
    n = tok.byte_count(F.col("text")) + 1
    plan = pack_plan(df, ["split"], ["doc_id"], integer_levels("doc_id"), n, 8)
    assert pack_blocks(df, plan, ["split"], ["doc_id"], tok.byte_tokens(F.col("text")), 8).count() == 0


def test_more_shards_than_rows(spark):
    check(spark, {1: "abcdefgh", 2: "ijklmnop"}, 4, batch_rows=3, shards=5)


def test_unknown_scope(spark):
    with pytest.raises(ValueError):
        run(spark, {1: "a"}, 4, scope="shard")


@pytest.mark.parametrize("n,batch_rows,shards", [(10, 3, 1), (10, 2, 3), (7, 2, 4), (23, 4, 5), (3, 2, 8)])
def test_batch_numbers_are_dense(spark, n, batch_rows, shards):
    df = spark.range(n).select("id", batch_group(F.col("id"), F.lit(n).cast("bigint"), batch_rows, shards).alias("g"))
    found = [r.g for r in df.orderBy("id").collect()]
    expected, used, g = [], min(n, shards), 0
    for s in range(used):
        size = n // used + (1 if s < n % used else 0)
        for i in range(size):
            expected.append(g + i // batch_rows)
        g += -(-size // batch_rows)
    assert found == expected


def test_texts_stay_and_only_bytes_move(spark, sf_dir):
    """Texts meet their plan in their buckets, and fragments cross the exchange as bytes."""
    from corpusloom.plans.token_queries import packed_documents

    plan = packed_documents(spark, sf_dir)._jdf.queryExecution().executedPlan()
    seen, todo = [], [plan]
    while todo:
        node = todo.pop()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
        if node.nodeName() == "AdaptiveSparkPlan":
            todo.append(node.initialPlan())
        if "Exchange" in node.nodeName():
            seen.append(node.schema().simpleString())
    assert seen and not any("text:" in s or "array<int>" in s for s in seen)
    assert any("binary" in s for s in seen)        # lists of slices, combined before they move


def test_bytes_pack_as_arrays_do(spark):
    rows = [("s", i, t) for i, t in enumerate(["abc", "", "é" * 30, None, "x" * 100, "yz"])]
    df = spark.createDataFrame(rows, "split string, doc_id bigint, text string")
    for eos in (256, None):
        content = text_bytes("text", eos)
        plan = pack_plan(df, ["split"], ["doc_id"], integer_levels("doc_id"), content.count(), 7, "split")
        ids = tok.append_eos(tok.byte_tokens(F.coalesce("text", F.lit(""))), eos)
        one, two = (
            {r.block_id: (r.input_ids, r.labels, r.attention_mask) for r in pack_blocks(df, plan, ["split"], ["doc_id"], x, 7).collect()}
            for x in (content, ids)
        )
        assert one == two and len(one) > 20


def test_blocks_gathered_in_ranges_are_shuffled_once(spark, sf_dir):
    from corpusloom.plans.token_queries import packed_documents

    plain, ranged = packed_documents(spark, sf_dir), packed_documents(spark, sf_dir, in_ranges=True)
    assert sorted(map(str, plain.collect())) == sorted(map(str, ranged.collect()))
    plan = ranged._jdf.queryExecution().executedPlan().toString()
    gathered = plan.split("rangepartitioning")[0]
    assert "rangepartitioning" in plan and "hashpartitioning" not in gathered
