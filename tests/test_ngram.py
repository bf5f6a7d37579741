"""Bigrams on packed ids, and the nucleus cut, against plain Python."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import ngram
from corpusloom.operators.vocab import build_vocab
from corpusloom.session import materialize

TRAIN = ["the cat saw the dog", "the dog, the dog!", "", None, "a cat", "z" * 100 + " the cat", "odd one out"]
HELD = ["the cat saw a zebra", "a " + "z" * 100 + " yak", "new words only", "the the the dog"]


def words(text):
    return re.findall(r"[^\W\d_]+|\d+|\S", text or "")


def pairs(text):
    w = [*words(text), "<eos>"]
    return list(zip(w, w[1:]))


@pytest.fixture(scope="module")
def frames(spark):
    train = spark.createDataFrame(list(enumerate(TRAIN)), "doc_id bigint, text string")
    held = spark.createDataFrame([(i, t) for i, t in enumerate(HELD)] * 2, "doc_id bigint, text string").withColumn("copy", F.lit(1))
    vocab = build_vocab(train)
    ids = {r.token: r.id for r in vocab.collect()} | {"<eos>": 1}
    return train, held, vocab, ids


@pytest.mark.parametrize("head", [0, 2, 500_000])
def test_counts_and_losses_by_any_head(spark, frames, head):
    train, held, vocab, ids = frames
    counts = Counter((ids[a], ids[b]) for t in TRAIN for a, b in pairs(t))
    found = materialize(ngram.bigram_counts(train, vocab, max_rows=head), "bigrams")
    assert {(r.prev, r.next): r.n for r in found.collect()} == counts
    context = Counter()
    for (a, _), n in counts.items():
        context[a] += n
    size = ngram.vocab_size(vocab)

    def loss(pair):
        a, b = (ids.get(x, 0) for x in pair)
        return -math.log((counts[a, b] + 0.1) / (context[a] + 0.1 * size))

    scored = materialize(ngram.pair_types_scored(held, vocab, found, size, 0.1, max_rows=head), "scored")
    want = [loss(p) for t in HELD for p in pairs(t)]
    whole = ngram.overall_loss(scored).first()
    assert whole.n_pairs == 2 * len(want) and whole.loss == pytest.approx(sum(want) / len(want))
    for losses in (0, 1, 1 << 20):
        rows = ngram.document_losses(held, ["doc_id"], vocab, scored, max_rows=head, max_losses=losses).collect()
        got = {r.doc_id: (r.n_pairs, r.loss) for r in rows}
        assert got == {i: (2 * len(pairs(t)), pytest.approx(sum(map(loss, pairs(t))) / len(pairs(t)))) for i, t in enumerate(HELD)}


def test_what_is_shuffled_is_longs(spark, frames):
    train, _, vocab, _ = frames
    head, _ = ngram.head_and_tail(vocab)
    counted = ngram._coded(train, head, [], "text").groupBy("pair", "prev_open", "next_open").count()
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in plan
    pair = ngram.pair_of(F.lit(7), F.lit((1 << 31) - 1))
    row = spark.range(1).select(ngram.prev_of(pair).alias("p"), ngram.next_of(pair).alias("n")).first()
    assert (row.p, row.n) == (7, (1 << 31) - 1)


@pytest.mark.parametrize("bits", [14, 2])
def test_nucleus_with_many_equal_counts(spark, bits, monkeypatch):
    monkeypatch.setattr(ngram, "CLASS_CELL_BITS", bits)
    r = random.Random(bits)
    rows = [(c, n, r.choice([1, 1, 2, 2, 2, 3, 3, 50])) for c in range(4) for n in r.sample(range(3000), 300)] + [(9, 5, 1)]
    groups = defaultdict(list)
    for c, n, k in rows:
        groups[c].append((-k, n))
    for p in (0.3, 0.5, 0.95, 1.0):
        want = {}
        for c, members in groups.items():
            before, total = 0, -sum(k for k, _ in members)
            for k, n in sorted(members):
                if before < p * total:
                    want[c, n] = before / total
                before -= k
        got = ngram.top_p(spark.createDataFrame(rows, "prev int, next int, n bigint"), p).collect()
        assert {(x.prev, x.next): x.p_before for x in got} == pytest.approx(want)


def test_a_task_combines_its_pairs_and_contexts_are_no_keyed_lookup(spark, frames):
    """Pairs are counted in the parts a task reads, not as a row each; totals of frequent contexts are broadcast, whatever their keys hold."""
    train, _, vocab, _ = frames
    head, _ = ngram.head_and_tail(vocab)
    held = spark.sparkContext.broadcast(head.select("token", "id").toArrow())
    tokens = spark.createDataFrame([(["a"] * 5 + [""],), (["a", "a", ""],), (None,), ([""],)], "_tokens array<string>").coalesce(1)
    parts = tokens.mapInArrow(ngram._pair_counter(held), "pair bigint, prev_open string, next_open string, n bigint").collect()
    assert sum(r.n for r in parts) == 7 and len(parts) == 2
    totals = spark.createDataFrame([(0, 5), (3, 7), (9, 1)], "prev int, context_n bigint")
    rows = spark.createDataFrame([(0, 1), (3, 2), (3, 3), (9, 4), (10, 5), (None, 6)], "prev int, x int")
    for most in (0, 2, 500_000):
        found = {(r.prev, r.x, r.context_n) for r in ngram.by_context(rows, totals, most).collect()}
        assert found == {(0, 1, 5), (3, 2, 7), (3, 3, 7), (9, 4, 1), (10, 5, None), (None, 6, None)}
