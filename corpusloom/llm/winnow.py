"""Benchmark decontamination by winnowing, in DataFrame functions only.

Both sides hash every run of K words and keep the smallest hash of every
WINDOW - K + 1 neighbouring runs.  A shared window of WINDOW words contains the
same neighbours on both sides, hence the same kept hash: no shared span of that
length is missed.  Kept hashes join; around every hit the windows that contain it
are compared word for word, which drops hash coincidences and gives the exact
span.  An item shorter than WINDOW words has one window, itself, so documents also
hash their runs of each such length that the benchmark really has.

Work is keyed by the text (two 64-bit hashes), not by the document, so a group of
copies is checked once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import ascii_lower, blank
from corpusloom.session import materialize

WINDOW = 13             # fixed by the contamination rule
K = 6
NOT_A_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
KEY = ["k1", "k2"]


def words(text: Column) -> Column:
    """Lower-cased (A-Z) words: digits, a-z and everything outside ASCII."""
    return F.array_remove(F.split(ascii_lower(text), NOT_A_WORD), "")


def text_key(text: Column) -> list[Column]:
    """Two independent hashes of the text (a leading constant changes the seed)."""
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2")]


def _runs(hashes: str, length: int, n: Column, seed: int = 0) -> Column:
    """Hash of every run of `length` neighbours in the array column `hashes`; empty when there is none."""
    at = F.sequence(F.lit(0), n - length)
    return F.when(
        n >= length, F.transform(at, lambda i: F.xxhash64(F.lit(seed), *[F.get(F.col(hashes), i + j) for j in range(length)]))
    ).otherwise(F.array().cast("array<bigint>"))


def _minima(runs: str, n: Column) -> Column:
    """Distinct smallest hashes of WINDOW - K + 1 neighbouring runs."""
    at = F.sequence(F.lit(0), n - WINDOW)
    least = F.transform(at, lambda i: F.least(*[F.get(F.col(runs), i + j) for j in range(WINDOW - K + 1)]))
    return F.when(n >= WINDOW, F.array_distinct(least)).otherwise(F.array().cast("array<bigint>"))


def with_words(df: DataFrame, text: str) -> DataFrame:
    return df.withColumn("words", words(blank(text))).withColumn("n_words", F.size("words"))


def with_hashes(df: DataFrame) -> DataFrame:
    return df.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w))).withColumn(
        "runs", _runs("hashes", K, F.col("n_words"))
    )


def benchmark_windows(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(item_id string, length, win): every window of every item with a word, as a written table.

    A null item id counts as the empty id; items that share an id count as one.
    """
    n = F.col("n_words")
    length = F.least(n, F.lit(WINDOW))
    starts = F.sequence(F.lit(1), n - length + 1)
    named = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item_id"), F.col(text).alias("text"))
    rows = with_words(named, "text").where(n > 0).select(
        "item_id", length.alias("length"), F.explode(F.transform(starts, lambda i: F.array_join(F.slice("words", i, length), " "))).alias("win")
    )
    return materialize(rows.distinct(), "benchmark-windows")


def benchmark_prints(items: DataFrame, text: str = "text") -> DataFrame:
    """Distinct (print, length) of the items: kept hashes, and the whole of short items."""
    rows = with_hashes(with_words(items.select(F.col(text).alias("text")), "text").where("n_words > 0"))
    n = F.col("n_words")
    kept = rows.select(F.explode(_minima("runs", n)).alias("print"), F.lit(WINDOW).alias("length"))
    for length in range(1, WINDOW):         # a short item is hashed like a run of its length
        short = rows.where(n == length).select(F.explode(_runs("hashes", length, n, length)).alias("print"), F.lit(length).alias("length"))
        kept = kept.unionByName(short)
    return materialize(kept.distinct(), "benchmark-prints")


def overlaps(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """What documents share with the benchmark.

    Returns (rows, found): `rows` has (doc_id, k1, k2, n_words) for every row of
    `docs`; `found` has per text key the item ids and the hit word positions
    of its windows, `items` sorted as strings and `n_hit`.
    """
    windows, prints = benchmark_windows(items, item_id, item_text), benchmark_prints(items, item_text)
    lengths = sorted(r.length for r in prints.select("length").distinct().collect())      # at most WINDOW values
    n = F.col("n_words")
    pairs = docs.select(F.col(doc_id).alias("doc_id"), blank(text).alias("text"))
    hashed = with_hashes(with_words(pairs.select("doc_id", *text_key(F.col("text")), "text"), "text"))
    own = [F.array_distinct(_runs("hashes", m, n, m)) if m < WINDOW else _minima("runs", n) for m in lengths]
    kept = F.concat(*own) if own else F.array().cast("array<bigint>")
    profiles = materialize(hashed.select("doc_id", *KEY, "n_words", kept.alias("prints")), "document-prints")
    hits = (
        profiles.select(*KEY, F.explode("prints").alias("print"))
        .join(prints, "print")
        .groupBy(*KEY)
        .agg(F.collect_set("print").alias("prints"))
    )
    suspects = materialize(hits, "suspect-texts")
    # of copies, the row with the smallest id stands for the text: chosen without it, so that the others' texts stay
    first = profiles.join(suspects.select(*KEY), KEY, "left_semi").groupBy(*KEY).agg(F.min("doc_id").alias("first"))
    chosen = materialize(suspects.join(first, KEY), "chosen-texts").withColumnsRenamed({k: f"_{k}" for k in KEY})
    keyed = pairs.select("doc_id", "text", *text_key(F.col("text")))
    same_row = F.col("doc_id").eqNullSafe(F.col("first"))
    for k in KEY:
        same_row = same_row & (F.col(k) == F.col(f"_{k}"))
    picked = keyed.join(chosen, same_row).select(*KEY, "text", "prints").dropDuplicates(KEY)
    again = with_hashes(with_words(picked, "text"))
    marked = again.withColumns({f"at{m}": _starts(m) for m in lengths})
    parts = [_windows_at(f"at{m}", m) for m in lengths]
    if not parts:
        return profiles.drop("prints"), suspects.select(*KEY, F.array().cast("array<string>").alias("items"), F.lit(0).alias("n_hit"))
    spans = marked.select(*KEY, F.explode(F.concat(*parts)).alias("s")).select(*KEY, "s.*")
    same = spans.join(windows, ["length", "win"])
    covered = F.array_distinct(F.flatten(F.transform("spans", lambda s: F.sequence(s["start"], s["start"] + s["length"] - 1))))
    found = same.groupBy(*KEY).agg(
        F.collect_set("item_id").alias("items"), F.collect_set(F.struct("start", "length")).alias("spans")
    )
    found = found.select(*KEY, F.sort_array("items").alias("items"), F.size(covered).alias("n_hit"))
    # written, so that its join to the rows can be split where a third of them are copies
    return profiles.drop("prints"), materialize(found, "contaminated-texts")


def _windows_at(starts: str, length: int) -> Column:
    def window(at: Column) -> Column:
        text = F.array_join(F.slice("words", at + 1, length), " ")
        return F.struct(at.alias("start"), F.lit(length).alias("length"), text.alias("win"))

    return F.transform(starts, window)


def _starts(length: int) -> Column:
    """Starts of the windows to compare: those of a short length that hit, or the WINDOW-word ones around a hit run."""
    n = F.col("n_words")
    if length < WINDOW:
        runs = _runs("hashes", length, n, length)
        return F.filter(F.transform(runs, lambda h, i: F.when(F.array_contains("prints", h), i)), lambda i: i.isNotNull())
    at = F.filter(F.transform("runs", lambda h, i: F.when(F.array_contains("prints", h), i)), lambda i: i.isNotNull())
    around = F.flatten(F.transform(at, lambda i: F.sequence(F.greatest(i - (WINDOW - K), F.lit(0)), F.least(i, n - WINDOW))))
    return F.when(n >= WINDOW, F.array_distinct(around)).otherwise(F.array().cast("array<int>"))


def contamination(docs: DataFrame, items: DataFrame, share: int = 20, **names: str) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated, items) per row of `docs`.

    A document is contaminated when it has a hit word and hit words are at least
    1/`share` of its words.  Null text has no words, empty and null benchmark texts no
    window; repeated rows get equal results; a null doc id stays null; an
    empty benchmark contaminates nothing; other columns are not used.
    """
    rows, found = overlaps(docs, items, **names)
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("bigint")
    named = F.coalesce("items", F.array().cast("array<string>"))
    return rows.join(found, KEY, "left").select(
        "doc_id",
        F.col("n_words").cast("bigint").alias("n_words"),
        n_hit.alias("n_hit"),
        F.size(named).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(named, ","), 256).alias("items_sha256"),
        ((n_hit > 0) & (share * n_hit >= F.col("n_words"))).alias("contaminated"),
        named.alias("items"),
        *KEY,
    )


def keep_clean(docs: DataFrame, items: DataFrame, share: int = 20, text: str = "text") -> DataFrame:
    """The rows of `docs` that are not contaminated, with the columns of `docs`."""
    rows, found = overlaps(docs.select(F.lit(None).alias("doc_id"), F.col(text).alias("text")), items)
    dirty = (
        rows.join(found, KEY)
        .where((F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words")))
        .select(F.col("k1").alias("_k1"), F.col("k2").alias("_k2"))
        .distinct()
    )
    k1, k2 = text_key(blank(text))
    marked = docs.withColumns({"_key1": k1, "_key2": k2})
    clean = marked.join(dirty, (F.col("_key1") == F.col("_k1")) & (F.col("_key2") == F.col("_k2")), "left_anti")
    return clean.drop("_key1", "_key2")
