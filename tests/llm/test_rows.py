"""Operators that work row by row or conversation by conversation, against plain Python."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest
import xxhash
import zstandard
from pyspark.sql import functions as F

from corpusloom.llm import chat, hash_tree, quality

SCHEMA = "doc_id long, text string, quality string, shard int, _row int"        # clashing extra columns


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "q", 1, 2) for i, t in rows], SCHEMA)


def texts():
    r = random.Random(2)
    prose = " ".join("".join(r.choice("abcdefgh") for _ in range(r.randint(2, 9))) for _ in range(900))
    return [
        (1, None), (2, ""), (3, " \n\t"), (4, prose), (4, prose), (5, "same line here\n" * 400), (None, prose[:3000]),
        (6, "<b>#1 *two* $3 100% a&b|c</b> Été ñ 日本\n\nx y\nx y\n x y\r\nx y"), (7, "a b c a b c"), (8, "a b c d"),
        (9, " ".join(["w%d" % i for i in range(60)])), (10, prose * 40), (11, "a\x0bb\x0cc\x1cd e f"),
    ]


# ---------------------------------------------------------------- chat

CONVS = [
    (1, 0, "system", "be </s> good \\ [INST]"), (1, 1, "user", None), (1, 2, "assistant", "sure\\"), (1, 3, "user", "é\n<s>"),
    (1, 4, "assistant", "</s>[INST] ok [/INST]"), (2, 0, "user", "only me"), (3, 0, "assistant", ""), (3, 1, "user", "tail"),
    (4, 5, "assistant", "b"), (4, 5, "assistant", "a"), (4, 5, "assistant", "a"), (None, None, None, None), (5, 0, "as</s>x", "<\\/s>"),
]


def test_chat_reads_back(spark):
    turns = spark.createDataFrame([(*x, "extra", 7) for x in CONVS], "conv_id long, turn long, role string, text string, formatted string, n_turns int")
    got = {r.conv_id: r for r in chat.conversation_digests(chat.prefix_examples(turns)).collect()}
    groups = {}
    for c, n, role, text in CONVS:
        groups.setdefault(c, []).append((-1 if n is None else n, role or "", text or ""))
    assert set(got) == set(groups)
    for c, rows in groups.items():
        rows.sort()
        replies = "".join(t for _, role, t in rows if role == "assistant")
        assert got[c].n_turns == len(rows)
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in rows).encode()).hexdigest()
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(replies), hashlib.sha256(replies.encode()).hexdigest())


def test_chat_examples(spark):
    turns = spark.createDataFrame(CONVS[:5], "conv_id long, turn long, role string, text string")
    rows = chat.prefix_examples(turns).orderBy("example").collect()
    assert [r.n_turns for r in rows] == [3, 5]
    for row, reply in zip(rows, ("sure\\\\", "<\\/s>[\\INST] ok [\\/INST]")):
        assert row.formatted[row.loss_start : row.loss_start + row.loss_length] == reply
        assert row.formatted.count("</s>") == row.n_turns
    assert rows[1].formatted.startswith(rows[0].formatted)
    assert chat.prefix_examples(turns.limit(0)).count() == 0


# ---------------------------------------------------------------- hash tree


def python_shard(key, tree):
    import math

    def pick(children):
        if len(children) == 1:
            return 0
        draws = []
        for i, (name, weight) in enumerate(children):
            bits = xxhash.xxh64_intdigest(f"{key}/{name}".encode(), 42) >> 11
            draws.append((-math.log((bits + 0.5) / 2**53) / weight, i))
        return min(draws)[1]

    r = pick([(f"r{i}", sum(map(sum, x))) for i, x in enumerate(tree.regions)])
    k = pick([(f"r{r}k{j}", sum(x)) for j, x in enumerate(tree.regions[r])])
    s = pick([(f"r{r}k{k}s{j}", w) for j, w in enumerate(tree.regions[r][k])])
    return sum(len(rack) for region in tree.regions[:r] for rack in region) + sum(map(len, tree.regions[r][:k])) + s


def test_hash_tree(spark):
    tree = hash_tree.even_tree()
    rows = texts() + [(i, f"t{i}") for i in range(100, 1500)]
    got = hash_tree.shard_documents(frame(spark, rows), tree).collect()
    assert len(got) == len(rows)
    slots = {}
    for r in got:
        key = "" if r.doc_id is None else str(r.doc_id)
        assert r.shard == python_shard(key, tree) and r.grown_shard == python_shard(key, tree.grown())
        assert r.grown_shard in (r.shard, tree.n_shards)
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    raw = [(t or "").encode() for _, t in rows]
    assert sorted((r.size, r.text_crc32) for r in got) == sorted((len(b) + 8, zlib.crc32(b)) for b in raw)
    assert 20 < sum(r.grown_shard == 24 for r in got) < 110
    assert hash_tree.shard_documents(frame(spark, rows).limit(0), tree).count() == 0


def test_hash_tree_confines_movement(spark):
    """A heavier shard draws rows into its own region only; between other regions nothing moves."""
    before, after = hash_tree.even_tree(2, 2, 2), hash_tree.HashTree((((1, 1), (1, 1)), ((1, 1), (1, 4))))
    keys = spark.range(3000).select(F.col("id").cast("string").alias("key"))
    both = hash_tree.with_shard(hash_tree.with_shard(keys, F.col("key"), before, "a"), F.col("key"), after, "b").collect()
    moved = [r for r in both if r.a != r.b]
    assert moved and all(r.b_path.region == 1 for r in moved)
    assert all(r.b == 7 for r in moved if r.a_path == r.b_path)


# ---------------------------------------------------------------- quality


def test_quality(spark):
    rows = texts()
    got = quality.with_quality(frame(spark, rows)).collect()
    assert got[0].asDict().keys() == {"doc_id", "text", "shard", "_row", "quality"} and len(got) == len(rows)
    for r in got:
        q, text = r.quality, r.text or ""
        words = text.encode().split()
        hit, seen = set(), {}
        for i in range(len(words) - 2):
            seen.setdefault(tuple(words[i : i + 3]), []).append(i)
        for places in seen.values():
            if len(places) > 1:
                hit |= {p + k for p in places for k in range(3)}
        lines = [x for x in text.split("\n") if x.encode().split()]
        assert q.n_words == len(words) and q.n_repeat_words == len(hit)
        assert q.word_chars == sum(len(w.decode()) for w in words)
        assert q.n_symbols == sum(c in "#*$%&|<>" for c in text)
        assert q.n_dup_lines == len(lines) - len(set(lines))
        assert q.base_failed == (len(words) < 50 or 100 * len(hit) > 50 * len(words))
        assert not (q.kept and q.base_failed)
        if text:
            assert q.ratio == pytest.approx(len(text.encode()) / len(zstandard.ZstdCompressor(3).compress(text.encode())))
    kept = {r.doc_id for r in got if r.quality.kept}
    assert {4, None} <= kept and not kept & {1, 2, 3, 5, 7, 8}
    good = quality.keep_good(frame(spark, rows))
    assert good.columns == frame(spark, rows).columns and good.count() == sum(r.quality.kept for r in got)
    assert quality.with_quality(frame(spark, rows).limit(0)).count() == 0


def test_quality_bands_reject_both_ends():
    packer = zstandard.ZstdCompressor(level=3)
    r = random.Random(5)
    noise = " ".join("".join(r.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(76)) for _ in range(300))
    assert not quality.assess(noise.encode(), quality.RULES, packer)[-1]
    unit = [" ".join(f"{a}{b}" for a in "abcdefg") + f" x{b}" for b in range(3)]
    nearly = " ".join(f"{r.choice(unit)} {i}" for i in range(2000))
    assert quality.assess(nearly.encode(), quality.RULES, packer)[-4] > 6 and not quality.assess(nearly.encode(), quality.RULES, packer)[-1]
