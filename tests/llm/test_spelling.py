"""Spelling variants against plain Python."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from corpusloom.llm import spelling
from corpusloom.llm.spelling import PositionIndex, Variants, members, spelling_variants


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(docs, rules=Variants()):
    counts = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % rules.noise == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= rules.least_letters and n >= rules.least_count}
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= rules.ratio * words[w] else None
    out = []
    for w, n in words.items():
        end = w
        while form[end] is not None:
            end = form[end]
        out.append((w, form[w], end, n, len(near[w]), form[w] and words[form[w]]))
    return sorted(out)


def rows(frame):
    return sorted(tuple(r) for r in frame.select("word", "form", "root", "n", "n_near", "form_n").collect())


def test_index_equals_one_edit():
    r = random.Random(5)
    words = sorted({"".join(r.choice("abé") for _ in range(r.randint(1, 7))) for _ in range(400)})
    index = PositionIndex(words)
    for word in words + ["", "aaaaaaaaaa"]:
        assert [words[k] for k in members(index.near(word))] == [w for w in words if one_edit(w, word)]


@pytest.mark.parametrize("block", [4096, 5])
def test_variants_equal_brute_force(spark, block, monkeypatch):
    r = random.Random(block)
    pool = ["".join(r.choice("abcÀÿ÷É") for _ in range(r.randint(3, 8))) for _ in range(60)]
    pool += [w[:-1] for w in pool] + [w + "a" for w in pool] + ["z" * 3000, "z" * 3001]
    weights = [2 ** r.randint(0, 9) for _ in pool]
    docs = [(i, " ".join(r.choices(pool, weights, k=60))) for i in range(120)]
    docs += [(None, None), (1, ""), (None, "Straße straße; STRASSE " * 4), (7, docs[7][1]), (7, docs[7][1]), (8, "z" * 3000 + " ")] * 3
    docs.append((200, "kettle " * 60 + "kittle " * 20 + "kittla " * 6 + "borned " * 5 + "bornee " * 6))
    frame = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, n int, word string")
    monkeypatch.setattr(spelling, "BLOCK", block)
    got = rows(spelling_variants(frame))
    assert got == brute(docs)
    assert any(form != root for _, form, root, _, _, _ in got if form) and any(form is None and near for _, form, _, _, near, _ in got)


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert rows(spelling_variants(docs)) == brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


def test_empty_table(spark):
    assert rows(spelling_variants(spark.createDataFrame([], "doc_id long, text string"))) == []


def test_chains_must_end():
    with pytest.raises(ValueError):
        Variants(ratio=1)
