"""Conversation structure repair by lightest derivations.

A repaired conversation is empty, or pairs of a user and an assistant turn after at most
one system turn.  What an edit may do is written as weighted deductions: from the item
"the first i rows are settled and the grammar is in state q", and the item of an edit of
row i, follows an item of i+1 rows; from the former and an insertion follows one of i
rows in another state.  A weight is (cost, audit); a deduction adds costs and joins audits, so a
conclusion is never lighter than a premise and lighter premises give lighter conclusions.
Under such superior functions Knuth's agenda settles items in order of weight: the
lightest open item is final when it is popped, and a deduction fires once all its
premises are.

Rows are dealt by ranges of (conversation, turn), not by conversation, so one of any length
is worked on by many tasks, in chunks.  A chunk's derivations from each state it may begin in give a
small table (state before, state after) -> weight; the tables of a conversation are premises of the
same kind of deduction, which picks the cheapest way through, and each chunk
then replays its part of it.
"""

from __future__ import annotations

import hashlib
import heapq
from collections import defaultdict
from collections.abc import Callable, Hashable, Iterable, Iterator
from dataclasses import dataclass
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from corpusloom.llm.common import blank, small_batches
from corpusloom.session import materialize

Weight = tuple[int, str]
START, SYSTEM, USER, PAIRS = 0, 1, 2, 3             # what the repaired turns so far end in
STATES, ACCEPTED = (START, SYSTEM, USER, PAIRS), (START, PAIRS)
STEP = {("s", START): SYSTEM, ("u", START): USER, ("u", SYSTEM): USER, ("u", PAIRS): USER, ("a", USER): PAIRS}
NAMES = {"u": "user", "a": "assistant"}
LEGAL = {"su", "ua", "au"}                          # initials of adjacent roles
CHUNK, CHUNK_BYTES = 512, 4 << 20
GAPS = r"\x20\x09-\x0D"


@dataclass(frozen=True)
class Costs:
    """What an edit costs; a turn that stays although it is cut short costs `truncated` more."""

    delete: int = 3
    rerole: int = 2
    insert: int = 2
    truncated: int = 1


def lightest(axioms: dict[Hashable, Weight], deductions: Iterable[tuple[Hashable, tuple[Hashable, ...]]]) -> dict[Hashable, Weight]:
    """The lightest weight of every item that can be derived; deductions are (conclusion, premises)."""
    uses, open_premises, rules = defaultdict(list), [], list(deductions)
    for number, (_, premises) in enumerate(rules):
        open_premises.append(len(premises))
        for premise in premises:
            uses[premise].append(number)
    agenda = [(cost, audit, item) for item, (cost, audit) in axioms.items()]
    heapq.heapify(agenda)
    final: dict[Hashable, Weight] = {}
    while agenda:
        cost, audit, item = heapq.heappop(agenda)
        if item in final:
            continue
        final[item] = (cost, audit)
        for number in uses[item]:
            open_premises[number] -= 1
            if not open_premises[number] and rules[number][0] not in final:
                head, premises = rules[number]
                weights = [final[x] for x in premises]
                heapq.heappush(agenda, (sum(w[0] for w in weights), "".join(w[1] for w in weights), head))
    return final


@dataclass
class Turn:
    """A row; `text` is None where it must go (blank, or seen before)."""

    role: str
    text: str | None
    truncated: bool = False


def _reach(turns: list[Turn], begin: int, costs: Costs) -> dict[int, Weight]:
    """For each state that `turns` can end in from `begin`, the lightest weight."""
    axioms: dict[Hashable, Weight] = {("at", 0, begin): (0, ""), ("insert",): (costs.insert, "I")}
    deductions = []
    for i in range(len(turns) + 1):
        for letter, state in STEP:
            if letter in NAMES:
                deductions.append((("at", i, STEP[letter, state]), (("at", i, state), ("insert",))))
    for i, turn in enumerate(turns):
        extra = costs.truncated if turn.truncated else 0
        axioms["delete", i] = (costs.delete, "D")
        deductions.extend((("at", i + 1, state), (("at", i, state), ("delete", i))) for state in STATES)
        if turn.text is None:
            continue
        axioms["keep", i], axioms["rerole", i] = (extra, "K"), (costs.rerole + extra, "R")
        for (letter, state), then in STEP.items():
            if turn.role[:1] == letter:
                deductions.append((("at", i + 1, then), (("at", i, state), ("keep", i))))
            if letter in NAMES:
                deductions.append((("at", i + 1, then), (("at", i, state), ("rerole", i))))
    final = lightest(axioms, deductions)
    return {state: final["at", len(turns), state] for state in STATES if ("at", len(turns), state) in final}


def _replay(turns: list[Turn], begin: int, audit: str) -> Iterator[tuple[str, str | None, str | None]]:
    """(edit, role, text) per letter of `audit`; a deleted row has neither role nor text."""
    rows, state = iter(turns), begin
    for edit in audit:
        turn = None if edit == "I" else next(rows)
        if edit == "D":
            yield edit, None, None
            continue
        letter = turn.role[:1] if edit == "K" else "a" if state == USER else "u"
        yield edit, turn.role if edit == "K" else NAMES[letter], turn.text if turn else ""
        state = STEP[letter, state]


def damaged(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) with faults planted by the checksum of `conv_id:turn`; a null counts as one space.

    Modulo 20, 0 drops the row, 1 empties its text, 2 takes its sentence ends, 3 repeats it, 4 makes it the user's.
    """
    space = F.lit(" ")
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    rows = turns.select(
        "conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), (F.crc32(name.cast("binary")) % 20).alias("fault")
    ).where("fault != 0")
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("fault") == 4, "user").otherwise(F.col("role"))
    times = F.when(F.col("fault") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times).alias("_time")).drop("_time")


def marked(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, times, fresh, blank, truncated): equal rows as one, and its faults.

    `fresh` says that no earlier row of the conversation has this role and text; of `times` equal rows
    only the first can be.  Order is by (turn, role, text), nulls first.
    """
    rows = turns.select("conv_id", "turn", blank("role").alias("role"), blank("text").alias("text"))
    said = [F.xxhash64("role", "text").alias("said1"), F.xxhash64(F.lit(1), "text", "role").alias("said2")]
    rows = rows.groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("times")).select("*", *said)
    rows = materialize(rows, "turns")
    first = rows.groupBy(F.col("conv_id").alias("conv"), F.col("said1").alias("f1"), F.col("said2").alias("f2")).agg(F.min(F.struct("turn")).alias("first"))
    same = F.col("conv_id").eqNullSafe(F.col("conv")) & (F.col("said1") == F.col("f1")) & (F.col("said2") == F.col("f2"))
    joined = rows.join(first, same)
    return joined.select(
        "conv_id",
        "turn",
        "role",
        "text",
        "times",
        F.col("turn").eqNullSafe(F.col("first.turn")).alias("fresh"),
        (~F.col("text").rlike(f"[^{GAPS}]")).alias("blank"),
        (~F.col("text").rlike(rf"[.!?][{GAPS}]*\z")).alias("truncated"),
    )


def _each(rows: Iterable[tuple]) -> Iterator[Turn]:
    """Single turns of (conv, role, text, times, fresh, blank, truncated)."""
    for _, role, text, times, fresh, is_blank, truncated in rows:
        usable = fresh and not is_blank
        yield Turn(role, text if usable else None, truncated)
        for _ in range(times - 1):
            yield Turn(role, None)


def _chunks(turns: Iterator[Turn], most: int) -> Iterator[list[Turn]]:
    held, size = [], 0
    for turn in turns:
        held.append(turn)
        size += len(turn.text or "")
        if len(held) == most or size > CHUNK_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in small_batches(batches):
        yield from zip(*(column.to_pylist() for column in batch.columns))


def _map(rows: DataFrame, make: Callable[[Iterator[tuple]], Iterator[tuple]], schema: str) -> DataFrame:
    """`make` over the rows of each task, its tuples as rows of `schema`."""
    layout = to_arrow_schema(T.StructType.fromDDL(schema))

    def batch(held: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), layout)], schema=layout)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for row in make(_rows(batches)):
            held.append(row)
            size += sum(len(x) for x in row if isinstance(x, str))
            if len(held) == 256 or size > CHUNK_BYTES:
                yield batch(held)
                held, size = [], 0
        if held:
            yield batch(held)

    return rows.mapInArrow(run, schema)


def _conv(frame: DataFrame) -> str:
    return f"conv_id {frame.schema['conv_id'].dataType.simpleString()}"


def chunk_tables(rows: DataFrame, costs: Costs) -> DataFrame:
    """A row per chunk of a conversation, in order of (part, no): its turns, its table, the initials at its ends."""
    turn = "struct<role:string,text:string,truncated:boolean>"
    way = "struct<before:int,after:int,cost:bigint,audit:string>"
    most = CHUNK

    def make(rows: Iterator[tuple]) -> Iterator[tuple]:
        part, no = TaskContext.get().partitionId(), 0
        for conv, held in groupby(rows, key=lambda row: row[0]):
            begins = STATES if part and not no else (START,)        # an earlier task may hold the beginning
            for turns in _chunks(_each(held), most):
                ways = [(q, r, *weight) for q in begins for r, weight in _reach(turns, q, costs).items()]
                initials = [t.role[:1] for t in turns]
                illegal = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))
                pieces = [{"role": t.role, "text": t.text, "truncated": t.truncated} for t in turns]
                table = [dict(zip(("before", "after", "cost", "audit"), way)) for way in ways]
                yield conv, part, no, pieces, table, initials[0], initials[-1], illegal
                no, begins = no + 1, STATES

    order = ["conv_id", "turn", "role", "text"]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    schema = f"{_conv(rows)}, part int, no bigint, turns array<{turn}>, ways array<{way}>, first string, last string, illegal bigint"
    return _map(dealt.select("conv_id", "role", "text", "times", "fresh", "blank", "truncated"), make, schema)


def best_ways(chunks: DataFrame) -> DataFrame:
    """(conv_id, part, no, before, audit, cost, illegal): how each chunk is repaired, and what it adds to the counts.

    A conversation's tables pass one task in order; what is held of them is the weight of each state, and
    per chunk where each state came from.
    """

    def make(rows: Iterator[tuple]) -> Iterator[tuple]:
        for conv, held in groupby(rows, key=lambda row: row[0]):
            now: dict[int, Weight] = {START: (0, "")}
            steps, last = [], None
            for _, part, no, ways, first, end, illegal in held:
                axioms: dict[Hashable, Weight] = {("before", q): weight for q, weight in now.items()}
                axioms |= {("way", w["before"], w["after"]): (w["cost"], w["audit"]) for w in ways}
                rules = [(("after", w["after"]), (("before", w["before"]), ("way", w["before"], w["after"]))) for w in ways]
                final = lightest(axioms, rules)
                came = {}
                for (q, r), way in (((w["before"], w["after"]), (w["cost"], w["audit"])) for w in ways):
                    if q in now and (now[q][0] + way[0], now[q][1] + way[1]) == final["after", r]:
                        came[r] = (q, way[0], len(way[1]))
                now = {r: final["after", r] for r in came}
                steps.append((part, no, came, illegal + (last is not None and last + first not in LEGAL)))
                last = end
            state = min((q for q in ACCEPTED if q in now), key=now.get)
            audit, at, out = now[state][1], len(now[state][1]), []
            for part, no, came, illegal in reversed(steps):
                state, cost, size = came[state]
                out.append((conv, part, no, state, audit[at - size : at], cost, illegal))
                at -= size
            yield from reversed(out)

    rows = chunks.select("conv_id", "part", "no", "ways", "first", "last", "illegal")
    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", "part", "no")
    return _map(dealt, make, f"{_conv(chunks)}, part int, no bigint, before int, audit string, cost bigint, illegal bigint")


def repaired_turns(chunks: DataFrame, ways: DataFrame) -> DataFrame:
    """(conv_id, part, no, at, edit, role, text): every edit in order; deleted rows without role and text."""

    def make(rows: Iterator[tuple]) -> Iterator[tuple]:
        for conv, part, no, turns, before, audit in rows:
            for at, edit in enumerate(_replay([Turn(**t) for t in turns], before, audit)):
                yield conv, part, no, at, *edit

    both = chunks.select("conv_id", "part", "no", "turns").join(ways.select("part", "no", "before", "audit"), ["part", "no"])
    rows = both.select("conv_id", "part", "no", "turns", "before", "audit")
    return _map(rows, make, f"{_conv(chunks)}, part int, no bigint, at int, edit string, role string, text string")


def _digests(edits: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of `role:text` lines; the rows of a conversation pass in order, none is held."""

    def make(rows: Iterator[tuple]) -> Iterator[tuple]:
        for conv, held in groupby(rows, key=lambda row: row[0]):
            state, between = hashlib.sha256(), ""
            for _, role, text in held:
                state.update(f"{between}{role}:{text}".encode())
                between = "\n"
            yield conv, state.hexdigest()

    rows = edits.where("edit != 'D'").select("conv_id", "role", "text", "part", "no", "at")
    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", "part", "no", "at").select("conv_id", "role", "text")
    return _map(dealt, make, f"{_conv(edits)}, repaired_sha256 string")


@dataclass(frozen=True)
class Repair:
    """What `repair` returns: the edits as rows, and a report per conversation."""

    edits: DataFrame
    report: DataFrame


def repair(turns: DataFrame, costs: Costs = Costs()) -> Repair:
    """Repair (conv_id, turn, role, text) conversations.

    Rows are taken by turn, nulls first; ties by role, then text.  `report` has per conversation: gaps in its
    turns, its blank, duplicate and truncated rows (the first fault of each counts), illegal neighbours,
    cost and audit of the cheapest repair (of equal ones the audit that is least in ASCII), and the digest of
    the repaired lines.  A null role or text counts as empty, a null conv_id is a conversation, all-null turns
    have no gaps; a conversation without usable rows is repaired to nothing; an empty table gives no rows.  Other
    columns are not used.
    """
    rows = materialize(marked(turns), "marked-turns")
    chunks = materialize(chunk_tables(rows, costs), "repair-chunks")
    ways = materialize(best_ways(chunks), "repair-ways")
    edits = materialize(repaired_turns(chunks, ways), "repaired-turns")

    whole, one = F.col("times"), F.col("fresh").cast("bigint")
    none = F.lit(0).cast("bigint")
    faults = {
        "blank": F.when(F.col("blank"), whole).otherwise(none),
        "duplicate": F.when(F.col("blank"), none).otherwise(whole - one),
        "truncated": F.when(F.col("blank") | ~F.col("truncated"), none).otherwise(one),
    }
    counted = rows.groupBy("conv_id").agg(*[F.sum(count).alias(name) for name, count in faults.items()])
    spots = rows.select("conv_id", "turn").distinct().groupBy("conv_id")
    gaps = spots.agg(F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("bigint").alias("gaps"))
    pieces = F.array_sort(F.collect_list(F.struct("part", "no", "audit")))
    audit = F.array_join(F.transform(pieces, lambda x: x.audit), "")
    audits = ways.groupBy("conv_id").agg(F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"), audit.alias("audit"))
    parts = counted.unionByName(gaps, allowMissingColumns=True)
    parts = parts.unionByName(audits, allowMissingColumns=True).unionByName(_digests(edits), allowMissingColumns=True)
    columns = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    merged = parts.groupBy("conv_id").agg(*[F.max(c).alias(c) for c in columns])
    return Repair(edits, whole_report(merged))


def whole_report(report: DataFrame) -> DataFrame:
    """`report` with the values of a conversation of which nothing is left."""
    counts = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return report.select("conv_id", *counts, blank("audit").alias("audit"), F.coalesce("repaired_sha256", nothing).alias("repaired_sha256"))


def repair_damaged(turns: DataFrame, costs: Costs = Costs()) -> DataFrame:
    """The report of `repair` on what `damaged` leaves of `turns`, for every conversation of `turns`."""
    report = repair(damaged(turns), costs).report
    everyone = turns.select("conv_id").distinct().unionByName(report, allowMissingColumns=True)
    return whole_report(everyone.groupBy("conv_id").agg(*[F.max(c).alias(c) for c in report.columns[1:]]))
