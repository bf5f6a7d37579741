"""Repeated byte strings against plain Python."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from corpusloom.llm import repeats
from corpusloom.llm.repeats import Member, Repeats, maximal_repeats, prefix_intervals, repeat_groups, repeat_report, segments, without_repeats


def brute(docs, least):
    """Sorted (doc_id, n_bytes, n_removed, n_spans, sha256 of the rest)."""
    raws = [(d, (t or "").encode()) for d, t in docs]
    seen = Counter(raw[i : i + least] for _, raw in raws for i in range(len(raw) - least + 1))
    out = []
    for doc, raw in raws:
        gone = bytearray(len(raw) + 1)
        for i in range(len(raw) - least + 1):
            if seen[raw[i : i + least]] > 1:
                gone[i : i + least] = b"\1" * least
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        runs = sum(gone[i] and not gone[i - 1] for i in range(len(raw)))
        out.append((doc, len(raw), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def corpus(r):
    say = lambda n: "".join(r.choices("abcdé \n", k=n))
    shared = [say(n) for n in (30, 45, 60, 200, 900)]
    line = say(19)
    docs = []
    for i in range(120):
        parts = [say(r.randint(0, 60))]
        for _ in range(r.randint(0, 4)):
            parts.append(r.choice([r.choice(shared), r.choice(shared)[5:40], line, say(30), "=" * r.randint(1, 90), "ab" * r.randint(1, 40)]))
            parts.append(say(r.randint(0, 12)))
        docs.append((i, "".join(parts)))
    docs += [(i, f"{say(25)}{line}{say(25)}") for i in range(200, 320)]      # one line in many contexts
    docs += [(400 + i, docs[3][1]) for i in range(20)] + [(5, None), (6, ""), (None, shared[2]), (7, "x" * 3000), (7, "x" * 3000), (8, "y" * 5000)]
    return docs + [(9, docs[10][1][:-3] + "!!!"), (10, "ü" * 40)]


@pytest.mark.parametrize("rules, block", [(Repeats(20, 8, 256), 1 << 19), (Repeats(20, 8, 3), 64), (Repeats(24, 24, 5), 1 << 10), (Repeats(21, 1, 2), 1 << 19)])
def test_report_equals_brute_force(spark, rules, block, monkeypatch):
    monkeypatch.setattr(repeats, "BLOCK", block)
    docs = corpus(random.Random(rules.least + block))
    frame = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, t1 int, raw string").repartition(7)
    got = [tuple(r) for r in repeat_report(frame, rules).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()]
    assert sorted(got, key=str) == brute(docs, rules.least)


def test_kept_bytes_and_empty_table(spark):
    docs = [(1, "a quite long sentence here"), (2, "not a quite long sentence here!"), (3, "other")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    kept = {r.doc_id: bytes(r.kept) for r in without_repeats(frame, Repeats(10, 4)).collect()}
    assert kept == {1: b"", 2: b"not !", 3: b"other"}
    assert repeat_report(frame.limit(0), Repeats(10, 4)).collect() == []


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = [tuple(r) for r in repeat_report(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()]
    assert sorted(got, key=str) == brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()], 200)


def test_groups_hold_all_occurrences(spark):
    docs = list(enumerate(t for _, t in corpus(random.Random(1)) if t and len(t) < 2000))       # ids of their own
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    raw = [(i, t.encode()) for i, t in docs]
    groups = {}
    for r in repeat_groups(frame, Repeats(20, 8, 8)).collect():
        groups.setdefault((r.key, r.no, r.length), set()).add((r.doc_id, r.start))
    assert len(groups) > 50
    texts = dict(raw)
    for (_, _, length), spots in groups.items():
        strings = {texts[i][a : a + length] for i, a in spots}
        assert len(strings) == 1 and length >= 20
        needle = strings.pop()
        everywhere = {(i, a) for i, t in raw for a in range(len(t) - length + 1) if t[a : a + length] == needle}
        assert len(everywhere) > 1 and spots == everywhere


def test_intervals():
    # prefixes of: a, ab, abab, b, ba
    assert list(prefix_intervals([1, 2, 0, 1])) == [(2, 1, 2), (1, 0, 2), (1, 3, 4), (0, 0, 4)]
    assert list(prefix_intervals([])) == []


def test_maximal_repeats_on_both_sides():
    group = [Member(l[::-1], r, 1) for l, r in [(b"xxab", b"cdee"), (b"yyab", b"cdff"), (b"zzzb", b"cdee")]]
    assert sorted((left, right, sorted(m)) for left, right, m in maximal_repeats(group, 3)) == [(1, 2, [0, 1, 2]), (1, 4, [0, 2]), (2, 2, [0, 1])]


def test_a_repeated_segment_inside_another_is_listed_once_with_all():
    group = [Member(b"ba", b"cd", 2), Member(b"bax", b"cdef", 1), Member(b"zz", b"cq", 3)]
    assert sorted(maximal_repeats(group, 4)) == [(2, 2, [0, 1]), (2, 2, [2])]


def test_equal_windows_have_equal_anchors():
    r = random.Random(2)
    shared = bytes(r.choices(b"abc", k=100))
    one, two = bytes(r.choices(b"abc", k=37)) + shared, shared + bytes(r.choices(b"abc", k=50))
    places = []
    for raw, shift in ((one, 37), (two, 0)):
        found = segments(np.frombuffer(raw, np.uint8), np.array([len(raw)]), Repeats(40, 7))
        windows = {w: lo + left - shift for lo, left, size in zip(found.lo, found.left, found.size) for w in range(lo - shift, lo - shift + size - 39)}
        places.append({w: a for w, a in windows.items() if 0 <= w <= 60})
    assert places[0] == places[1] and len(places[0]) == 61
