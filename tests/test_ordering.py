from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from corpusloom.operators.ordering import integer_levels, ordered_index, ranked_table, running


def brute_index(rows, weight=None):
    """rows: (group, key..., weight)"""
    out, state = {}, {}
    for row in sorted(rows):
        group, key, w = row[0], row[1:-1], row[-1]
        n, total = state.get(group, (0, 0))
        out[(group, *key)] = (n, total)
        state[group] = (n + 1, total + w)
    return out, state


@pytest.mark.parametrize("wide", [False, True])
def test_index_over_sparse_and_negative_keys(spark, wide):
    rng = random.Random(7)
    keys = {rng.choice([rng.randrange(100), rng.randrange(-(2**40), 2**62), (1 << 20) * rng.randrange(50)]) for _ in range(400)}
    rows = [(rng.choice("aab"), k, rng.randrange(9)) for k in keys]
    df = spark.createDataFrame(rows, "g string, k bigint, w bigint")
    found = ordered_index(df, ["g"], ["k"], integer_levels("k", wide=wide), ["w"]).collect()
    expected, totals = brute_index(rows)
    assert len(found) == len(rows)
    for r in found:
        assert (r.idx, r.w_before) == expected[(r.g, r.k)]
        assert (r.n_rows, r.w_total) == totals[r.g]


def test_index_spreads_a_hot_leading_key(spark):
    """One lead value holds most rows; its second key crosses several cells."""
    rows = [("a", 5, i * 300_000, 1) for i in range(60)] + [("a", i, 0, 2) for i in range(20) if i != 5]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "g string, k bigint, t bigint, w bigint")
    levels = integer_levels("k", "t")
    found = ordered_index(df, ["g"], ["k", "t"], levels, ["w"])
    expected, _ = brute_index(rows)
    assert {(r.g, r.k, r.t): (r.idx, r.w_before) for r in found.collect()} == expected
    cells = df.select(*[F.expr(e) for level in levels for e in level]).distinct().count()
    assert cells > 30


def test_running_equals_python(spark):
    rng = random.Random(3)
    rows = [("r", i, rng.randrange(1000)) for i in range(500)]
    df = spark.createDataFrame(rows, "g string, pos bigint, v bigint")
    found = running(df, ["g"], "pos", "v", F.min, F.least, "best", cell_bits=4)
    best = None
    expected = {}
    for _, pos, v in rows:
        expected[pos] = best
        best = v if best is None else min(best, v)
    assert {r.pos: r.best for r in found.collect()} == expected


def test_ranked_table_is_dense_and_ordered(spark):
    rows = [(f"t{i:04d}", i % 7) for i in range(1000)]
    df = spark.createDataFrame(rows, "token string, n int").repartition(5)
    ranked = ranked_table(df, [F.col("n").desc(), F.col("token")], "id", 3, "test").collect()
    expected = {t: i + 3 for i, (t, _) in enumerate(sorted(rows, key=lambda r: (-r[1], r[0])))}
    assert {r.token: r.id for r in ranked} == expected


@pytest.mark.parametrize("tiers", [0, 1, 3])
def test_running_in_tiers(spark, tiers):
    """Cells, parents and their parents; no window over more than four rows below the last tier."""
    rng = random.Random(tiers)
    rows = [(g, i, rng.choice([None, rng.randrange(1000)])) for g in "ab" for i in range(300)]
    df = spark.createDataFrame(rows, "g string, pos bigint, v bigint")
    found = running(df, ["g"], "pos", "v", F.max, F.greatest, "best", include_current=True, cell_bits=2, tiers=tiers)
    expected, best = {}, {}
    for g, pos, v in rows:
        best[g] = max((x for x in (best.get(g), v) if x is not None), default=None)
        expected[g, pos] = best[g]
    assert {(r.g, r.pos): r.best for r in found.collect()} == expected


def test_cells_of_corpora_hold_random_ids(spark, tmp_path):
    """Ids over the whole 64-bit range: the parents of their cells are few enough to be scanned."""
    from corpusloom.sources import corpora

    rng = random.Random(9)
    ids = [rng.randrange(-(2**63), 2**63) for _ in range(500)]
    spark.createDataFrame([(i, "t") for i in ids], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = corpora.scan_corpora(spark, str(tmp_path), [corpora.Corpus("benchmark", "benchmark", ("item_id",))]).drop("text")
    got = ordered_index(rows, ["dataset", "split"], corpora.CORPUS_KEY, corpora.CORPUS_CELLS).collect()
    for split in ("train", "test", "validation"):
        mine = sorted((r.key1, r.idx) for r in got if r.split == split)
        assert [i for _, i in mine] == list(range(len(mine)))
    assert len(corpora.CORPUS_CELLS) == 3 and rows.select("cell00").distinct().count() <= 500
