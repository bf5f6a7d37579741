"""Spelling variants by a bit-sliced position index.

Words are counted over all documents.  Two words that differ by one edit agree on the
first or on the last half of the shorter one, so a word is placed under its halves: a
few rows per word, and near words meet at exactly one of them.  What meets is cut into
blocks; a block's index holds, for each (position, letter), the set of its words with
that letter there, as one bit per word.  A word runs through the index letter by
letter and keeps four sets at once: no error yet, and one error with the block's words
running level, one letter ahead or one letter behind.  One step is a handful of bit
operations for all words of the block together.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import groupby

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import small_batches
from corpusloom.session import materialize

RUN = re.compile(rb"(?:[A-Za-z]|\xc3[\x80-\xbf])+")     # [A-Za-zÀ-ÿ]+ in UTF-8
BLOCK = 4096            # words of one index
HELD = 200_000          # different words a task counts before it hands them on


@dataclass(frozen=True)
class Variants:
    """Parameters: the shortest word, its least count, and how much more frequent a form must be."""

    least_letters: int = 5
    least_count: int = 3
    ratio: int = 2
    noise: int = 97         # a run whose checksum this divides loses a letter; 0 for none

    def __post_init__(self) -> None:
        if self.least_letters < 2 or self.ratio < 2:
            raise ValueError("words need two letters and forms twice the count, or halves are empty and chains may circle")


def _damaged(run: bytes, check: int) -> bytes:
    letters = run.decode("utf-8")
    at = check % len(letters)
    return (letters[:at] + letters[at + 1 :]).encode()


def word_counts(docs: DataFrame, rules: Variants = Variants(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n): how often each word of `least_letters` and more occurs, if `least_count` times at least.

    A word is a run of Latin letters, A-Z lowered.  Where `noise` divides the checksum of
    `<doc_id>:<run>`, all of the document's occurrences of the run lose one letter.  A null id
    counts as empty there; a null text has no words.
    """

    def flush(counts: Counter) -> pa.RecordBatch:
        words = [w for w in counts if len(w) >= rules.least_letters and len(w.decode("utf-8")) >= rules.least_letters]
        columns = [pa.array([w.decode("utf-8") for w in words], pa.string()), pa.array([counts[w] for w in words], pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=["word", "n"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in small_batches(batches):
            for name, raw in zip(batch.column(0).to_pylist(), pc.cast(batch.column(1), pa.binary())):
                prefix = zlib.crc32(f"{'' if name is None else name}:".encode())
                for word, n in Counter(RUN.findall((raw.as_py() or b"").lower())).items():
                    if rules.noise:
                        check = zlib.crc32(word, prefix)
                        if check % rules.noise == 0:
                            word = _damaged(word, check)
                    counts[word] += n
                if len(counts) > HELD:
                    yield flush(counts)
                    counts.clear()
        yield flush(counts)

    rows = docs.select(F.col(doc_id).cast("string").alias("doc_id"), F.col(text).alias("text"))
    counted = rows.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= rules.least_count)


class PositionIndex:
    """Bit sets over `words`: of each (position, letter), and of each length."""

    def __init__(self, words: list[str]):
        self.words = words
        self.letters: dict[tuple[int, str], int] = {}
        self.lengths: dict[int, int] = {}
        for k, word in enumerate(words):
            bit = 1 << k
            self.lengths[len(word)] = self.lengths.get(len(word), 0) | bit
            for spot in enumerate(word):
                self.letters[spot] = self.letters.get(spot, 0) | bit
        self.all = (1 << len(words)) - 1

    def near(self, word: str) -> int:
        """The set of words that differ from `word` by exactly one edit."""
        has = self.letters.get
        exact, level, ahead, behind = self.all, 0, self.all, 0     # `ahead`: the index word has had one letter more
        for i, letter in enumerate(word):
            here = has((i, letter), 0)
            behind = (behind & has((i - 1, letter), 0)) | exact
            level = (level & here) | (exact & ~here)
            exact &= here
            ahead = (ahead & has((i + 1, letter), 0)) | exact
            if not (level | ahead | behind):
                return 0
        size, of = len(word), self.lengths.get
        return (level & of(size, 0)) | (ahead & of(size + 1, 0)) | (behind & of(size - 1, 0))


def members(bits: int) -> Iterator[int]:
    """Numbers of the bits set, lowest first."""
    while bits:
        low = bits & -bits
        yield low.bit_length() - 1
        bits ^= low


def _here(word: str, other: str, h: int, side: str) -> bool:
    """Whether the near words `word` and `other` are to be found under this half, and not under another."""
    return min(len(word), len(other)) // 2 == h and (side == "P" or word[:h] != other[:h])


FOUND = "word string, n_near bigint, fewer bigint, form string"
UNIT = ["h", "side", "half", "i", "k"]


def _units(words: DataFrame) -> DataFrame:
    """Rows (UNIT, word, n, asks, listed): each word wherever it looks for near ones or can be found.

    The half's length is half of the pair's shorter word, which may be this word or one a letter
    shorter.  A half of more than BLOCK words is dealt to blocks: unit (i, k) is asked by
    block i and lists block k, so it holds about 2 BLOCK words at most.
    """
    size = F.char_length("word")
    lengths = F.array_distinct(F.array(F.floor(size / 2).cast("int"), F.floor((size - 1) / 2).cast("int")))
    sides = F.array(
        F.struct(F.lit("P").alias("side"), F.expr("substring(word, 1, h)").alias("half")),
        F.struct(F.lit("S").alias("side"), F.expr("right(word, h)").alias("half")),
    )
    rows = words.select("word", "n", F.explode(lengths).alias("h")).select("word", "n", "h", F.inline(sides))
    sizes = rows.groupBy("h", "side", "half").agg(F.count(F.lit(1)).alias("g")).where("g > 1")
    dealt = rows.join(sizes, ["h", "side", "half"]).withColumn("blocks", F.ceil(F.col("g") / BLOCK).cast("int"))
    dealt = dealt.withColumn("mine", F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int"))
    met = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    own = F.col("mine") == F.col("other")
    asking = F.struct(F.col("mine").alias("i"), F.col("other").alias("k"), F.lit(True).alias("asks"), own.alias("listed"))
    listed = F.struct(F.col("other").alias("i"), F.col("mine").alias("k"), F.lit(False).alias("asks"), F.lit(True).alias("listed"))
    both = F.when(own, F.array(asking)).otherwise(F.array(asking, listed))
    return met.select("h", "side", "half", "word", "n", F.inline(both))


def _meet(unit: tuple, rows: list[tuple]) -> Iterator[tuple[str, int, int, str]]:
    """FOUND rows of one unit; `rows` are (word, n, asks, listed)."""
    h, side = unit[0], unit[1]
    listed = [(word, n) for word, n, _, is_listed in rows if is_listed]
    index = PositionIndex([word for word, _ in listed])
    for word, _, asks, _ in rows:
        if asks:
            found = [listed[k] for k in members(index.near(word)) if _here(word, listed[k][0], h, side)]
            if found:
                fewer, form = min((-n, other) for other, n in found)
                yield word, len(found), fewer, form


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, form, form_n) for each of `words` (word, n) that has near ones.

    `form` is the most frequent near word; ties go to the first in code-point order.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*(column.to_pylist() for column in batch.columns))

        out: list[tuple] = []
        for unit, held in groupby(rows(), key=lambda row: row[:5]):
            out.extend(_meet(unit, [row[5:] for row in held]))
            if len(out) >= 10_000:
                yield _batch(out)
                out = []
        yield _batch(out)

    units = _units(words).select(*UNIT, "word", "n", "asks", "listed")
    found = units.repartition(*UNIT).sortWithinPartitions(*UNIT).mapInArrow(run, FOUND)
    best = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct("fewer", "form")).alias("best"))
    return best.select("word", "n_near", "best.form", (-F.col("best.fewer")).alias("form_n"))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    word, n_near, fewer, form = zip(*rows) if rows else ((), (), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(word, pa.string()), pa.array(n_near, pa.int64()), pa.array(fewer, pa.int64()), pa.array(form, pa.string())],
        names=["word", "n_near", "fewer", "form"],
    )


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for each word of `forms` (word, form): the end of its chain of forms.

    Every round doubles the stretch a word has followed.  A form is at least `ratio` times as
    frequent as its word, so chains end, after 63 steps at most for a ratio of 2.
    """
    now = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        step = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        if now.join(step, "root", "left_semi").isEmpty():
            return now
        further = now.join(step, "root", "left")
        now = materialize(further.select("word", F.coalesce("further", "root").alias("root")), "roots")


def spelling_variants(docs: DataFrame, rules: Variants = Variants(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, form, root, n, n_near, form_n) per word of `docs` that is long and frequent enough.

    `n_near` counts the words one edit away; `form` is the most frequent of them if it occurs `ratio`
    times as often at least, otherwise null; `root` ends the chain of forms and is the word itself
    where it has none.  Null texts have no words; an empty table gives no rows; rows that share an id, or
    are equal, all count.  Other columns are not used.
    """
    words = materialize(word_counts(docs, rules, doc_id, text), "words")
    near = materialize(words.join(near_words(words), "word", "left"), "near-words")
    formed = near.withColumn("form", F.when(F.col("form_n") >= rules.ratio * F.col("n"), F.col("form")))
    ends = roots(formed.where("form IS NOT NULL"))
    return formed.join(ends, "word", "left").select(
        "word",
        "form",
        F.coalesce("root", "word").alias("root"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(F.col("form").isNotNull(), F.col("form_n")).alias("form_n"),
    )
