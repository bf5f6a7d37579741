"""Word n-gram scoring against plain Python."""

from __future__ import annotations

import math
import random
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import queries, word_lm


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def brute(rows, target_ids):
    grams = lambda t: list(zip(["", *(w := (t or "").encode().lower().split())], [*w, ""]))
    back = Counter(g for _, t in rows for g in grams(t))
    target = Counter(g for i, t in rows for g in grams(t) if i in target_ids)
    scale = sum(target.values()) / sum(back.values())
    words = len({b for _, b in back})

    def loss(counts, a, b):
        one = lambda w: sum(n for (_, y), n in counts.items() if y == w)
        p1 = (one(b) + 1 / words) / (sum(counts.values()) + 1)
        return -math.log((counts[a, b] + 4 * p1) / (one(a) + 4))

    scaled = Counter({k: n * scale for k, n in back.items()})
    return [(i, len(grams(t)), sum(loss(target, *g) - loss(scaled, *g) for g in grams(t))) for i, t in rows]


def test_word_scores_match_plain_python(spark, monkeypatch):
    r = random.Random(3)
    rows = [(1, "a B b\tc"), (2, "b a"), (3, ""), (4, None), (None, "a b"), (None, None), (4, "zz  zz"), (5, "A b b c"), (5, "A b b c"), (6, "é É x\0y")]
    rows += [(10 + i, " ".join(r.choice("abcdefghij") for _ in range(r.randint(0, 30)))) for i in range(40)]
    good = [1, 1, 4, None, 99, 12, 15, 16]
    want = sorted(brute(rows, {1, 4, 12, 15, 16}), key=str)
    for size in (16 << 20, 40):                            # chunks of many texts and of few
        monkeypatch.setattr(word_lm, "CHUNK_BYTES", size)
        got = sorted(map(tuple, word_lm.score(frame(spark, rows), spark.createDataFrame([(g,) for g in good], "doc_id long")).collect()), key=str)
        assert [g[:2] for g in got] == [w[:2] for w in want]
        for g, w in zip(sorted(got, key=lambda x: (str(x[0]), x[2])), sorted(want, key=lambda x: (str(x[0]), x[2]))):
            assert g[2] == pytest.approx(w[2], abs=1e-9) and g[3] == pytest.approx(w[2] / w[1], abs=1e-9)


def test_word_scores_without_target_or_rows(spark):
    docs, ids = frame(spark, [(1, "a b"), (2, None)]), spark.createDataFrame([(7,)], "doc_id long")
    assert sorted(map(tuple, word_lm.score(docs, ids).collect())) == [(1, 3, None, None), (2, 1, None, None)]
    assert word_lm.score(docs.limit(0), ids).count() == 0


def test_query_tells_word_order_apart(spark, tmp_path):
    """The same words in another order, with the same byte trigrams but for the edges."""
    rows = [(i, " ".join(["axa aya aza", "axa aza aya"][i % 2].split() * 30)) for i in range(20)]
    frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 1 - i % 2) for i in range(10)], "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    got = {r.doc_id: r for r in queries.cross_entropy_difference(spark, str(tmp_path)).collect()}
    assert {i for i, x in got.items() if x.selected} == set(range(0, 20, 2))
    assert got[0].n_tokens == 91 and got[1].score - got[0].score > 1


def test_gathered_counts_grow_with_the_corpus(spark):
    """Byte trigrams stop growing; every new word and word pair has to add a row."""
    ids, rows = spark.createDataFrame([(0, 0)], "doc_id long, chunk int"), []
    for n in (1, 4):
        docs = [(i, " ".join(f"w{i}x{k}" for k in range(500)), 0) for i in range(n)]
        rows.append(word_lm.counted(spark.createDataFrame(docs, "doc_id long, text string, chunk int"), ids).where("first").count())
    assert rows == [1 + 500 + 501, 1 + 4 * (500 + 501)]


def test_word_scores_separate_held_out_documents(spark, sf_dir):
    sf_dir = sf_dir.replace("sf0.001", "sf0.01")
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    rows = word_lm.score(docs, labels.where("quality = 1 AND doc_id % 2 = 0")).join(labels.where("doc_id % 2 = 1"), "doc_id").collect()
    good, bad = ([r.score for r in rows if r.quality == q] for q in (1, 0))
    assert sum(a < b for a in good for b in bad) > 0.9 * len(good) * len(bad)


def test_packed_numbers_come_back():
    r = np.random.default_rng(1)
    columns = [r.integers(0, 2**64, 500, np.uint64), np.ones(500, np.int64), r.integers(0, 70_000, 500), np.zeros(500, np.uint64)]
    columns[0][:2] = 0, 2**64 - 1
    for size in (500, 2, 1, 0):
        back = word_lm.unpacked(word_lm.packed(*(c[:size] for c in columns)), size, 4)
        assert all((b == c[:size].astype(np.uint64)).all() and len(b) == size for b, c in zip(back, columns, strict=True))


def test_counts_of_chunks_and_ranges_match_plain_python(spark):
    r = random.Random(5)
    docs = [(i, " ".join(r.choice("abcdefg") for _ in range(r.randint(0, 20))), i % 3) for i in range(30)]
    ids = spark.createDataFrame([(4, 1), (9, 0), (29, 2), (99, 0)], "doc_id long, chunk int")
    keys = lambda t: [*(w := [*t.encode().split(), b""]), *zip([b"", *w], w)]
    back = Counter(k for _, t, _ in docs for k in keys(t))
    target = Counter(k for i, t, _ in docs if i in (4, 9, 29) for k in keys(t))
    spots = {k: {c for _, t, c in docs if k in keys(t)} for k in back}
    frame_ = spark.createDataFrame(docs, "doc_id long, text string, chunk int")
    for ranges in (1, 7, 1000):
        got = word_lm.counted(frame_, ids, ranges).collect()
        assert len({(x.chunk, x.key) for x in got}) == len(got)
        assert Counter((x.background, x.target) for x in got) == Counter((back[k], target[k]) for k in back for _ in spots[k])
        assert Counter((x.background, x.target) for x in got if x.first) == Counter((back[k], target[k]) for k in back)


def test_texts_travel_once_and_keys_as_packed_differences(spark):
    """Written and shuffled: the texts once, a row per chunk and range instead of one per chunk and key, no table of counts."""
    kept = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:")) / "corpusloom"
    before = set(kept.glob("*"))
    docs = frame(spark, [(i, " ".join(f"w{i}x{k}" for k in range(2000))) for i in range(40)])
    ids = spark.createDataFrame([(i,) for i in range(9)], "doc_id long")
    scored = word_lm.score(docs, ids)
    assert len(scored.collect()) == 40
    assert "ReusedExchange" in scored._jdf.queryExecution().executedPlan().toString()
    assert set(kept.glob("*")) == before
    none = ids.limit(0).withColumn("chunk", F.lit(0))
    for ranges in (1, 5):
        rows, keys, size = word_lm._sent(docs.withColumn("chunk", (F.col("doc_id") % 2).cast("int")), none, ranges).agg(
            F.count("*"), F.sum("size"), F.sum(F.octet_length("packed"))).head()
        assert (rows, keys) == (2 * ranges, 2 * (1 + 20 * 4001)) and size < 7.5 * keys
