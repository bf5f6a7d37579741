"""Conversation repair against a search of all edits in order of (cost, audit)."""

from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib

import pytest

from corpusloom.llm import repair
from corpusloom.llm.repair import lightest, repair_damaged

GOOD = re.compile(r"(s?(ua)+)?")
SCHEMA = "conv_id long, turn long, role string, text string, times int, cost string"


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        c = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if c == 1:
            text = ""
        if c == 2:
            text = re.sub("[.!?]", "", text)
        if c == 4:
            role = "user"
        out += [] if c == 0 else [(turn, role, text)] * (2 if c == 3 else 1)
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))


def cheapest(rows):
    """Uniform-cost search over (rows done, roles written); nothing of the agenda's grammar states."""
    queue, seen = [(0, "", 0, "", ())], set()
    while queue:
        cost, audit, i, roles, lines = heapq.heappop(queue)
        key = (i, roles[-2:], len(roles) > 2 or roles[:1])
        if key in seen:
            continue
        seen.add(key)
        if i == len(rows) and GOOD.fullmatch(roles):
            return cost, audit, "\n".join(lines)
        options = [(2, "I", i, r[0], f"{r}:") for r in ("user", "assistant")]
        if i < len(rows):
            role, text, fault = rows[i]
            more = fault == "truncated"
            options.append((3, "D", i + 1, "", None))
            if fault not in ("blank", "duplicate"):
                options.append((more, "K", i + 1, role[:1] or "-", f"{role}:{text}"))
                options += [(2 + more, "R", i + 1, r[0], f"{r}:{text}") for r in ("user", "assistant")]
        for price, edit, j, initial, line in options:
            if initial in ("", "s", "u", "a") and any(GOOD.fullmatch(roles + initial + end) for end in ("", "a", "ua")):
                heapq.heappush(queue, (cost + price, audit + edit, j, roles + initial, lines + ((line,) if line is not None else ())))


def brute(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        kept = damage([r for r in rows if r[0] == conv])
        seen, marked = set(), []
        for turn, role, text in kept:
            body = text.strip(" \t\n\x0b\x0c\r")
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "" if body[-1] in ".!?" else "truncated"
            seen.add((role, text))
            marked.append((role, text, fault))
        turns = [t for t, _, _ in kept if t is not None]
        initials = [r[:1] for _, r, _ in kept]
        cost, audit, lines = cheapest(marked) if marked else (0, "", "")
        out[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            *(sum(f == x for _, _, f in marked) for x in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
            cost,
            audit,
            hashlib.sha256(lines.encode()).hexdigest(),
        )
    return out


def got(frame):
    return {r[0]: tuple(r)[1:] for r in frame.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256").collect()}


@pytest.fixture(scope="module")
def rows():
    r = random.Random(13)
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "u2"]
    texts = ["Yes.", "no", " ", "", None, "What?\n", "Fine!\t", "é", "a.b", "Yes."]
    out = []
    for conv in range(120):
        turn = r.randint(-2, 3)
        for _ in range(r.randint(1, 9)):
            turn += r.choice([0, 1, 1, 1, 2])
            out.append((conv, r.choice([turn] * 9 + [None]), r.choice(roles), r.choice(texts)))
    out += [(None, t, "user", "Hm.") for t in (1, 2, None, None)]
    out += [(500, t, r.choice(roles[:5]), f"said {r.randint(0, 30)}{r.choice(['.', ''])}") for t in range(70)]
    out += [(501, None, "user", "x" * 100_000)] + [(502, 1, "user", "again.")] * 40
    return out


@pytest.mark.parametrize("chunk", [512, 3])
def test_repair_equals_search(spark, rows, chunk, monkeypatch):
    monkeypatch.setattr(repair, "CHUNK", chunk)
    frame = spark.createDataFrame([(*x, 1, "x") for x in rows], SCHEMA).repartition(5)
    assert got(repair_damaged(frame)) == brute(rows)


def test_whole_table(spark, sf_dir):
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    assert got(repair_damaged(turns)) == brute([tuple(r) for r in turns.collect()])


def test_empty_table(spark):
    assert got(repair_damaged(spark.createDataFrame([], SCHEMA))) == {}


def test_agenda_settles_by_weight():
    axioms = {"a": (1, "x"), "b": (1, "y"), "free": (0, "")}
    rules = [("c", ("a", "b")), ("c", ("b", "a")), ("d", ("c", "free")), ("a", ("d",)), ("never", ("missing", "a"))]
    assert lightest(axioms, rules) == {"free": (0, ""), "a": (1, "x"), "b": (1, "y"), "c": (2, "xy"), "d": (2, "xy")}
