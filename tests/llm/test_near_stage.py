"""The near-copy operator of the pipeline against brute force at five words and 0.8."""

from __future__ import annotations

import random

from corpusloom.llm import parity


def shingle_set(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def survivors(docs):
    sets, group = [shingle_set(t) for _, t in docs], list(range(len(docs)))
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= 80 * (len(a) + len(sets[j]) - both):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    least = {g: min(d for (d, _), h in zip(docs, group) if h == g) for g in group}
    return sorted(d for (d, _), g, s in zip(docs, group, sets) if not s or d == least[g])


def test_keep_one_at_five_words_and_eight_tenths(spark):
    r = random.Random(8)
    vocabulary = [f"w{i}" for i in range(4000)]
    word = lambda: r.choice(vocabulary)
    long = [word() for _ in range(1000)]
    run = long[:400] + [word() for _ in range(80)] + long[480:]         # one rewritten run
    scattered = list(long)
    for at in range(25, 1000, 50):                                      # 20 changed words
        scattered[at] = "changed"
    docs = [(0, " ".join(long)), (1, " ".join(run)), (2, " ".join(scattered)), (3, None), (4, ""), (5, "a b"), (6, "A  b")]
    for i in range(150):
        words = list(long[:r.choice([12, 40, 120, 300])]) if i % 3 else [word() for _ in range(60)]
        for _ in range(r.choice([0, 1, 1, 2, 3, 6, 9])):
            words[r.randrange(len(words))] = word()
        docs.append((10 + i, " ".join(words)))
    kept = parity.keep_one(spark.createDataFrame(docs, "doc_id long, text string"), parity.Join(words=5, percent=80))
    got = sorted(x.doc_id for x in kept.collect())
    assert got == survivors(docs) and not {1, 2, 6} & set(got) and {0, 3, 4, 5} <= set(got)
