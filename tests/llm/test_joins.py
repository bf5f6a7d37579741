"""Decontamination, the Jaccard join and components, against plain Python."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest

from corpusloom.llm import parity, winnow
from corpusloom.llm.graph import components

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words13(text):
    return WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def contaminated(docs, items):
    out = []
    for doc, text in docs:
        w, hit, ids = words13(text), set(), set()
        for item, said in items:
            v = words13(said)
            m = min(13, len(v))
            windows = {tuple(v[a : a + m]) for a in range(len(v) - m + 1)} if m else set()
            for a in range(len(w) - m + 1):
                if tuple(w[a : a + m]) in windows:
                    hit |= set(range(a, a + m))
                    ids.add("" if item is None else str(item))
        digest = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(ids), digest, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def exam():
    r = random.Random(3)
    say = lambda n: " ".join(r.choice("ab CD ef Gé hj kl".split()) for _ in range(n))
    items = [(i, say(r.choice([1, 2, 5, 12, 13, 14, 20]))) for i in range(30)] + [(100, None), (101, "..."), (None, say(15)), (7, say(13))]
    docs = [(i, say(r.choice([0, 3, 12, 13, 30, 60]))) for i in range(60)]
    docs += [(5, None), (6, ""), (None, items[3][1]), (70, items[0][1] + " zz" * 30), (70, items[0][1] + " zz" * 30), (71, "q-" * 20_000 + items[-1][1])]
    return docs, items


def frames(spark, docs, items):
    return (
        spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, k1 int, words string"),
        spark.createDataFrame([(i, t, 2) for i, t in items], "item_id long, text string, length int"),
    )


def test_winnowing_equals_brute_force(spark, exam):
    docs, items = frames(spark, *exam)
    got = sorted((tuple(r)[:6] for r in winnow.contamination(docs, items).collect()), key=str)
    assert got == contaminated(*exam)
    clean = winnow.keep_clean(docs, items)
    assert clean.columns == docs.columns and clean.count() == sum(not r[-1] for r in got)


def test_winnowing_without_short_items_and_without_rows(spark, exam):
    items = [x for x in exam[1] if len(words13(x[1])) >= 13]
    docs, long_items = frames(spark, exam[0], items)
    assert sorted((tuple(r)[:6] for r in winnow.contamination(docs, long_items).collect()), key=str) == contaminated(exam[0], items)
    assert winnow.contamination(docs, long_items.limit(0)).where("n_hit > 0 OR n_items > 0 OR contaminated").count() == 0
    assert winnow.contamination(docs.limit(0), long_items).count() == 0


# ---------------------------------------------------------------- Jaccard join


def shingle_set(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + 3]) for i in range(len(w) - 2)) if len(w) >= 3 else frozenset([tuple(w)] if w else [])


def grouped(docs, percent=90):
    sets, up = [shingle_set(t) for _, t in docs], list(range(len(docs)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b, both = sets[j], len(a & sets[j])
            same = docs[i][0] is not None and docs[i][0] == docs[j][0]
            if a and b and (same or 100 * both >= percent * (len(a) + len(b) - both)):
                up[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    return sorted(((d, len(s), least.get(root(i))) for i, ((d, _), s) in enumerate(zip(docs, sets))), key=str)


@pytest.fixture(scope="module")
def copies():
    r = random.Random(5)
    vocabulary = [f"w{i}" for i in range(3000)]
    base = [[r.choice(vocabulary) for _ in range(r.choice([2, 10, 25, 60, 150, 400]))] for _ in range(25)]
    docs = []
    for i in range(330):
        words = list(r.choice(base))
        for _ in range(r.choice([0, 0, 1, 1, 2, 3, 6])):
            words[r.randrange(len(words))] = r.choice(vocabulary)
        if r.random() < 0.3:
            words += [r.choice(vocabulary) for _ in range(r.randint(0, max(1, len(words) // 12)))]
        docs.append((i * 3, "  ".join(words)))
    docs += [(9001, None), (9002, ""), (9003, " \t"), (9004, "one two"), (9005, "One  TWO"), (9006, "one"), (None, docs[0][1]), (None, None)]
    return docs + [(9007, docs[1][1]), (9007, docs[40][1]), (9008, docs[2][1]), (9008, docs[2][1])]


def test_jaccard_join_equals_brute_force(spark, copies):
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in copies], "doc_id long, text string, rep int, component int")
    got = sorted((tuple(r) for r in parity.similar_groups(docs).collect()), key=str)
    assert got == grouped(copies)
    assert parity.similar_groups(docs.limit(0)).count() == 0


def survivors(docs, percent=90):
    """Rows that stay of (doc_id, text): rows are nodes, whatever their ids."""
    rows = list(enumerate(docs))
    groups = {i: c for i, _, c in grouped([(i, t) for i, (_, t) in rows], percent)}
    first = {}
    for i, (d, t) in rows:
        if shingle_set(t):
            first.setdefault(groups[i], []).append((d is None, d or 0, t, i))
    stay = {min(x)[1::2] for x in first.values()}
    return sorted([(d, t) for i, (d, t) in rows if not shingle_set(t)] + [(docs[i][0], docs[i][1]) for _, i in stay], key=str)


def test_one_row_of_each_group_stays(spark, copies):
    odd = [(1, "a b c d e f"), (1, "totally other words in this one"), (None, copies[3][1]), (None, "alone without any id at all"), (None, "alone without any id at all")]
    rows = copies + odd + [(5, "same id same text here"), (5, "same id same text here")]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, component int, name string")
    kept = parity.keep_one(docs)
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    assert kept.columns == docs.columns and len(got) == len(survivors(rows))
    # of near copies under one id any may stay, so only those told apart by id are compared by text
    ids = [d for d, _ in rows]
    assert [x for x in got if ids.count(x[0]) == 1] == [x for x in survivors(rows) if ids.count(x[0]) == 1]
    assert {(1, "a b c d e f"), (1, "totally other words in this one"), (None, "alone without any id at all")} <= set(got)
    assert parity.keep_one(docs.limit(0)).count() == 0


@pytest.mark.parametrize("percent", [80, 90])
def test_keys_grow_in_proportion_to_the_set(percent):
    r, join = np.random.default_rng(4), parity.Join(words=5, percent=percent)
    per_shingle = []
    for size in (1000, 20_000, 100_000):
        codes = np.unique(r.integers(0, 1 << 63, size, dtype=np.uint64) * np.uint64(2))
        per_shingle.append(sum(map(len, parity.postings(codes, join))) / len(codes))
    assert max(per_shingle) < 1 and max(per_shingle) < 3 * min(per_shingle)


def test_blocks_of_a_large_group_miss_no_pair(spark, copies, monkeypatch):
    monkeypatch.setattr(parity, "BLOCK", 8)
    docs = spark.createDataFrame(copies[:200], "doc_id long, text string")
    assert sorted((tuple(r) for r in parity.similar_groups(docs).collect()), key=str) == grouped(copies[:200])


def test_similar_sets_share_a_word_of_their_sketches():
    r = np.random.default_rng(1)
    for size, percent in [(s, p) for s in (4, 5, 6, 8, 10, 17, 40, 200, 1000) for p in (80, 90)]:
        join, share = parity.Join(percent=percent), (100 - percent) / 200
        for _ in range(60):
            a = r.integers(0, 1 << 63, size, dtype=np.uint64)
            b = np.concatenate([a[round(size * share) :], r.integers(0, 1 << 63, int(size * share * 0.8), dtype=np.uint64)])
            a, b = np.unique(a), np.unique(b)
            both = len(np.intersect1d(a, b))
            if not join.linked(both, len(a), len(b)) or both == len(a) == len(b):
                continue
            keys = [set(np.concatenate(parity.postings(x, join)).tolist()) for x in (a, b)]
            assert keys[0] & keys[1]
            apart = np.bitwise_count(parity.sketch(a, 32) ^ parity.sketch(b, 32)).sum()
            assert apart <= len(a) + len(b) - 2 * both


def test_components(spark):
    r = random.Random(8)
    edges = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 160)] + [(7, 7), (300, 200), (200, 300)]
    edges += [(r.randint(1000, 1060), r.randint(1000, 1060)) for _ in range(50)]
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = sorted((root(a), root(b)))
            up[y] = x
    got = {row.node: row.component for row in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: root(x) for x in list(up)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
